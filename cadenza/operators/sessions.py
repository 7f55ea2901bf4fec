"""Features of a clip's audio by sessions: chunks that carry the tail of the chunk before them.

A first chunk of FIRST blocks is followed by chunks of STEP. An encoder sees a chunk between context
blocks: before it the last blocks of its predecessor (silence, where there are fewer), behind it silence. A
block finds its chunk by arithmetic, and the last CONTEXT blocks of a chunk are listed once more as the tail
of the next, so the work is one grouping of small groups, whatever the length of a clip.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of context on either side, of the first chunk, of the others; rows of a window.
CONTEXT, FIRST, STEP, WINDOW = 10, 20, 50, 20

#: Makes one row of features for every block of samples, in order: n x samples to n x features.
Encoder = Callable[[np.ndarray], np.ndarray]


def chunk_of(block: Column, first: int = FIRST, step: int = STEP) -> Column:
    return F.when(block < first, F.lit(0)).otherwise(F.floor((block - first) / step) + 1).cast("long")


def _chunks(blocks: DataFrame, clip: str, block: str, samples: str) -> DataFrame:
    """Every block as part of its chunk and, if it is among the last of a chunk, of the next one's tail."""
    own = chunk_of(F.col(block))
    size = F.when(own == 0, FIRST).otherwise(STEP)
    local = F.col(block) - F.when(own == 0, 0).otherwise((own - 1) * STEP + FIRST)
    parts = F.array(own, F.when(local >= size - CONTEXT, own + 1))
    listed = blocks.select(clip, F.col(block).cast("long").alias("__block"), F.col(samples).alias("__samples"), F.explode(F.array_compact(parts)).alias("chunk"))
    return listed.withColumn("__own", chunk_of(F.col("__block")) == F.col("chunk"))


def _encoded(table: pa.Table, encode: Encoder) -> tuple[int, int, np.ndarray] | None:
    """(first block, blocks, features) of a chunk: the features begin CONTEXT rows before its first block. None for a tail alone."""
    order = np.argsort(table.column("__block").to_numpy())
    own = np.asarray(table.column("__own"))[order]
    if not own.any():
        return None  # the last chunk's tail: no chunk follows
    place = table.column("__block").to_numpy()[order]
    samples = np.array(table.column("__samples").take(pa.array(order)).to_pylist(), np.float32)
    tail, now, start = samples[~own], samples[own], int(place[own][0])
    lead = 0 if start == 0 else CONTEXT
    whole = np.zeros((lead + len(now) + 2 * CONTEXT, samples.shape[1]), np.float32)
    begin = lead + CONTEXT
    whole[begin - len(tail) : begin], whole[begin : begin + len(now)] = tail, now
    found = np.asarray(encode(whole), np.float32)[lead : lead + len(now) + WINDOW - 1]
    if len(found) != len(now) + WINDOW - 1:
        raise ValueError(f"the encoder gave {len(found)} of {len(now) + WINDOW - 1} rows for the chunk at block {start}")
    return start, len(now), found


def _run(blocks: DataFrame, clip: str, block: str, samples: str, encode: Encoder, made: Callable[[int, int, np.ndarray], tuple[np.ndarray, list]], name: str, kind: str) -> DataFrame:
    clip_kind = blocks.schema[clip].dataType.simpleString()

    def chunk(table: pa.Table) -> pa.Table:
        found = _encoded(table, encode)
        places, values = made(*found) if found else (np.zeros(0, np.int64), [])
        own = table.column(clip).take(pa.array(np.zeros(len(places), np.int64)))
        return pa.table([own, pa.array(places, pa.int64()), pa.array(values, pa.list_(pa.float32()))], names=[clip, block, name])

    return _chunks(blocks, clip, block, samples).groupBy(clip, "chunk").applyInArrow(chunk, f"`{clip}` {clip_kind}, `{block}` long, `{name}` {kind}")


def session_features(blocks: DataFrame, clip: str, block: str, samples: str, encode: Encoder) -> DataFrame:
    """(clip, block, features): the chunks' rows for their own blocks, one after the other: a row for every block of a clip."""
    return _run(blocks, clip, block, samples, encode, lambda start, n, found: (start + np.arange(n), list(found[CONTEXT : CONTEXT + n])), "features", "array<float>")


def session_windows(blocks: DataFrame, clip: str, block: str, samples: str, encode: Encoder) -> DataFrame:
    """(clip, block, window): for every block the WINDOW rows of its chunk that begin a row before it (at the first row for a chunk's first block), back to back."""

    def windows(start: int, n: int, found: np.ndarray) -> tuple[np.ndarray, list]:
        rows = np.minimum(np.maximum(np.arange(n) - 1, 0), max(0, len(found) - WINDOW))
        return start + np.arange(n), [found[r : r + WINDOW].reshape(-1) for r in rows]

    return _run(blocks, clip, block, samples, encode, windows, "window", "array<float>")
