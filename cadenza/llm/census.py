"""Corpus-wide counts of hashes, answered to the blocks that ask.

Rows are grouped into blocks of bounded size. A block sends each of its distinct hashes once, with
its own count, to the range of hashes that it falls into; the range adds the counts of all blocks up
and answers. However common a hash is, it crosses the network at most once per block, and a block
sends nothing to ranges in which it has no hash.

With B blocks and R ranges that is at most B x R messages. R is chosen by the size of a range, apart
from B. Beyond ``messages`` of them, relays stand between: a relay serves about sqrt(B) blocks and
sqrt(R) neighbouring ranges, adds up what its blocks send and sends each range one message. Then
there are at most B sqrt(R) + R sqrt(B) messages each way (for 12,500 blocks of 8 MB, which are
100 GB, 2.8 million instead of 156 million); hashes cross the network twice, those that blocks of a
relay share once less.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import planes, released, unplanes, written

MESSAGE = "to int, sender int, hashes binary, counts binary"
ANSWER = "to int, part int, totals binary"
MESSAGES = 20_000_000

#: (distinct sorted hashes, count of each, whatever ``finish`` wants to see again)
Ask = Callable[[pa.Table], tuple[np.ndarray, np.ndarray, object]]
#: (rows of the block, what ``ask`` kept, corpus count of each hash) -> rows
Finish = Callable[[pa.Table, object, np.ndarray, np.ndarray], pa.Table]


class Route:
    """Which range a hash belongs to, and whether and which relay stands before it."""

    def __init__(self, blocks: int, ranges: int, messages: int = MESSAGES) -> None:
        self.blocks, self.ranges = blocks, ranges
        self.relayed = blocks * ranges > messages
        #: ranges in a group, groups of ranges, groups of blocks
        self.span = math.isqrt(ranges - 1) + 1 if self.relayed else 1
        self.groups = -(-ranges // self.span)
        self.homes = math.isqrt(blocks - 1) + 1 if self.relayed else 1

    def range_of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)).astype(np.int64)

    def cuts(self, hashes: np.ndarray, low: int, high: int, step: int) -> list[tuple[int, int, int]]:
        """(range, first, last) of sorted hashes for every ``step`` ranges from low to high that hold any."""
        starts = np.arange(low, high, step)
        edges = np.searchsorted(self.range_of(hashes), np.append(starts, high))
        return [(int(r), int(a), int(b)) for r, a, b in zip(starts, edges[:-1], edges[1:], strict=True) if b > a]

    def sent(self, hashes: np.ndarray, block: int) -> list[tuple[int, int, int]]:
        """(addressee, first, last) of a block's sorted hashes."""
        return [(r // self.span * self.homes + block % self.homes, a, b) for r, a, b in self.cuts(hashes, 0, self.ranges, self.span)]

    def forwarded(self, hashes: np.ndarray, relay: int) -> list[tuple[int, int, int]]:
        low = relay // self.homes * self.span
        return self.cuts(hashes, low, min(low + self.span, self.ranges), 1)


def without_relays(blocks: int, most: float = 8, messages: int = MESSAGES) -> float:
    """Of how many blocks a range holds the hashes: one, or as many up to ``most`` as make relays needless."""
    return min(most, max(1, blocks * blocks / messages))


def census(rows: DataFrame, blocks: int, ask: Ask, finish: Finish, schema: str, width: int = 8, per_range: float = 1, messages: int = MESSAGES, staged: bool = False) -> DataFrame:
    """``rows`` has a column ``block``; ``ask`` runs twice per block, the second time beside the answers.

    If ``staged``, answers are written and the messages given back before rows meet their answers. Rows then
    cross the network twice, but never lie on disk beside the messages and the result.

    A range holds as many hashes as ``per_range`` blocks. Only the first ``width`` bytes of a hash are
    sent and compared. With fewer than 8 some counts may be too high, which a caller that only prunes
    with them can afford.
    """
    drop = np.uint64(64 - 8 * width)
    route = Route(blocks, max(1, math.ceil(blocks / per_range)), messages)

    def letters(sender: int, cuts: list[tuple[int, int, int]], hashes: np.ndarray, counts: np.ndarray) -> pa.Table:
        return pa.table(
            [
                pa.array([to for to, _, _ in cuts], pa.int32()), pa.array([sender] * len(cuts), pa.int32()),
                pa.array([planes(hashes[a:b] >> drop, width) for _, a, b in cuts], pa.binary()), pa.array([planes(counts[a:b]) for _, a, b in cuts], pa.binary()),
            ],
            names=["to", "sender", "hashes", "counts"],
        )

    def added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(distinct hashes, their counts, place of every hash among them, hashes per message)."""
        hashes = [unplanes(x, np.uint64, width) for x in table.column("hashes").to_pylist()]
        counts = np.concatenate([unplanes(x, np.uint32) for x in table.column("counts").to_pylist()])
        unique, place = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.minimum(np.bincount(place, weights=counts, minlength=len(unique)), 2**32 - 1).astype(np.uint32)
        return unique << drop, totals, place, [len(h) for h in hashes]

    def answers(part: int, table: pa.Table, totals: np.ndarray, sizes: list[int]) -> pa.Table:
        ends = np.cumsum(sizes)
        shared = pa.array([planes(totals[b - n : b]) for n, b in zip(sizes, ends, strict=True)], pa.binary())
        return pa.table([table.column("sender"), pa.array([part] * len(sizes), pa.int32()), shared], names=["to", "part", "totals"])

    def joined(table: pa.Table) -> np.ndarray:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("totals").to_pylist(), strict=True))
        return np.concatenate([np.zeros(0, np.uint32), *(unplanes(t, np.uint32) for _, t in parts)])

    def send(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts, _ = ask(table)
        pa.default_memory_pool().release_unused()
        block = key[0].as_py()
        return letters(block, route.sent(hashes, block), hashes, counts.astype(np.uint32))

    def forward(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts, _, _ = added(table)
        return letters(key[0].as_py(), route.forwarded(hashes, key[0].as_py()), hashes, counts)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        _, totals, place, sizes = added(table)
        return answers(key[0].as_py(), table, totals[place], sizes)

    def back(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        _, _, place, sizes = added(table)
        return answers(key[0].as_py(), table, joined(found)[place], sizes)

    def end(table: pa.Table, found: pa.Table) -> pa.Table:
        hashes, _, kept = ask(table)
        return finish(table, kept, hashes, joined(found))

    sent = rows.groupBy("block").applyInArrow(send, MESSAGE)
    if route.relayed:
        ranged = sent.groupBy("to").applyInArrow(forward, MESSAGE).groupBy("to").applyInArrow(add, ANSWER)
        found = sent.groupBy("to").cogroup(ranged.groupBy("to")).applyInArrow(back, ANSWER)
    else:
        found = sent.groupBy("to").applyInArrow(add, ANSWER)
    if staged:
        found = written(found, "answers")
        released(rows.sparkSession)
    return rows.groupBy("block").cogroup(found.groupBy("to")).applyInArrow(end, schema)
