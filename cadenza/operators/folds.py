"""Folds whose state is a row: a row is reached if it follows from the row that was reached last.

Acceptance near the last accepted row and a best value that moves only by more than a margin are such folds.
They don't shrink to a window, but each row has one successor, so a batch needs no state per row: successors
within a few rows are found for all rows of the batch at once, and then only reached rows are visited. A
successor further off is searched for from a reached row alone, in blocks that double, so that all searches
of a clip together pass its rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: (earlier, later) arrays [..., columns] to booleans [...]
Follows = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: How far successors are looked for in all rows at once, and in how many rows first from a single one.
AHEAD, BLOCK = 32, 64


def successors(v: np.ndarray, usable: np.ndarray, end: np.ndarray, follows: Follows) -> np.ndarray:
    """Of each row the next one that follows from it, its run's end if there is none, -1 if that isn't known ``AHEAD`` rows on."""
    found = np.full(len(v), -1, np.int64)
    left = np.flatnonzero(usable)
    for d in range(1, AHEAD + 1):
        over = left + d >= end[left]
        found[left[over]] = end[left[over]]
        left = left[~over]
        if not len(left):
            break
        met = usable[left + d] & follows(v[left], v[left + d])
        found[left[met]] = left[met] + d
        left = left[~met]
    return found


def first_where(test: Callable[[slice], np.ndarray], low: int, high: int) -> int:
    """The first place in [low, high) where ``test`` of its slice holds, ``high`` if there is none."""
    width = BLOCK
    while low < high:
        hits = np.flatnonzero(test(slice(low, min(high, low + width))))
        if len(hits):
            return low + int(hits[0])
        low, width = low + width, 2 * width
    return high


def leaps(
    df: DataFrame, clip: str, order: str, columns: list[str], starts: Callable[[np.ndarray], np.ndarray], follows: Follows,
    fields: list[StructField], shown: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[pa.Array]],
) -> DataFrame:
    """``df`` with ``fields`` made by ``shown(usable, reached, last, since)`` of each batch.

    The first row where ``starts`` holds is reached, then always the next that follows from the last one; rows
    with a null among ``columns`` never are (``usable`` tells). ``last`` holds the values of the row reached last,
    NaN if there is none, ``since`` the rows of the clip after it. Clips are partitioned and sorted by Spark and
    stream through in Arrow batches: memory is a batch and one row, however long a clip is; other columns pass as they are.
    """
    none = np.full(len(columns), np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, any_key, carried, behind = None, False, none, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])
            usable = ~np.isnan(v).any(axis=1)
            code = pc.dictionary_encode(batch.column(clip), null_encoding="encode").indices.to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1], [True]]))
            end = np.repeat(edges[1:], np.diff(edges))
            next_row = successors(v, usable, end, follows)
            reached, last, since = np.zeros(n, bool), np.empty_like(v), np.empty(n, np.int64)
            if not any_key or batch.column(clip)[0].as_py() != key:
                carried, behind = none, 0
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if low:
                    carried, behind = none, 0
                if np.isnan(carried).any():
                    at = first_where(lambda s: usable[s] & starts(v[s]), low, high)
                else:
                    at = first_where(lambda s, c=carried: usable[s] & follows(c, v[s]), low, high)
                hits = []
                while at < high:
                    hits.append(at)
                    there = int(next_row[at])
                    at = there if there >= 0 else first_where(lambda s, c=v[at]: usable[s] & follows(c, v[s]), at + 1, high)
                rows = np.arange(low, high)
                reached[hits] = True
                # the place of the row reached last, low - 1 where that lies before this run of the batch
                upto = np.maximum.accumulate(np.where(reached[low:high], rows, low - 1))
                before = upto < low
                last[low:high] = np.where(before[:, None], carried, v[np.maximum(upto, low)])
                since[low:high] = np.where(before, rows - low + 1 + behind, rows - upto)
                carried, behind = last[high - 1].copy(), int(since[high - 1])
            key, any_key = batch.column(clip)[n - 1].as_py(), True
            yield pa.record_batch([*batch.columns, *shown(usable, reached, last, since)], names=[*batch.schema.names, *(f.name for f in fields)])

    ordered = df.repartition(clip).sortWithinPartitions(clip, order)
    return ordered.mapInArrow(run, StructType([*df.schema.fields, *fields]))
