"""Suffix-array dedup: bytes under any SPAN-byte string that also starts elsewhere are removed.

Sorting every suffix of the corpus is not needed. Winnowing picks anchors: the last smallest hash of
KGRAM bytes in each run of SPAN bytes. Equal runs pick equal anchors, so two equal strings always
meet at an anchor with the same LEFT (before it) and SPAN (after it) bytes or parts of them.

1. A census counts anchors' k-grams and whole contexts over all documents. Where a whole context
   repeats, all of it goes. Where all contexts of a k-gram are equal or it does not repeat, that is all.
2. Of the other anchors (near the ends of repeated passages), suffixes with their left contexts are
   range-partitioned by their leading k-gram with sampled splitters. Equal k-grams stay in one
   range, so no run of equal suffixes crosses a boundary, and a k-gram's run is at most HOT long. Each
   range sorts its suffixes by multikey quicksort, a machine word at a time, and the reversed left
   contexts likewise. Common-prefix
   lengths of neighbours then tell for each distance d which anchors agree on the d bytes before
   and the SPAN - d bytes after.
3. A k-gram in more than HOT anchors is not gathered, as one task would have to hold them all:
   windows of its contexts are counted by a second census, which sends each distinct window once per
   block. Both ways give the same spans.

Defined results: a null or empty text has no bytes and keeps none; rows without doc_id are left
out; of rows with equal doc_id the smallest text counts; a very long text is cut into strides for its
anchors; an empty table gives an empty table; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .census import census
from .common import block_count, keyed_docs, mixed, one_per_id, string_bytes, written

SPAN, KGRAM, BLOCK_MB, HOT = 200, 50, 8, 20_000
LEFT = SPAN - KGRAM
WIDTH = LEFT + SPAN
STRIDE = 2_000_000
BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, pow(BASE, -1, 2**64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: block minima from both sides."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(position, row, left, right, k-gram hash, context hash) of every anchor that lies in some SPAN bytes of its row."""
    found: list[tuple[np.ndarray, ...]] = []
    up, down = _powers(min(len(data), STRIDE) + LEFT + 2 * SPAN + 1) if len(data) else (None, None)
    for start in range(0, len(data), STRIDE):
        a = max(0, start - LEFT)
        own = data[a : start + STRIDE + 2 * SPAN]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[own] * up[: len(own)], dtype=np.uint64)])
        first, last = start - a, min(start - a + STRIDE + SPAN - 1, len(own))
        if last - first < SPAN:
            break
        grams = mixed((sums[first + KGRAM : last + 1] - sums[first : last + 1 - KGRAM]) * down[first : last + 1 - KGRAM])
        # equal hashes: the later position is less
        place = np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64)
        least = sliding_least((grams >> np.uint64(32) << np.uint64(32)) | place, SPAN - KGRAM + 1)
        at = (np.uint64(0xFFFFFFFF) - (least[np.concatenate([[True], least[1:] != least[:-1]])] & np.uint64(0xFFFFFFFF))).astype(np.int64)
        at = np.unique(at)
        position = at + start
        row = np.searchsorted(offsets, position, "right") - 1
        left = np.minimum(LEFT, position - offsets[row])
        right = np.minimum(SPAN, offsets[row + 1] - position)
        fits = (right >= KGRAM) & (left + right >= SPAN)
        at, position, row, left, right = at[fits], position[fits], row[fits], left[fits], right[fits]
        low = position - left - a
        context = mixed((sums[low + left + right] - sums[low]) * down[low]) ^ mixed((left * 1024 + right).astype(np.uint64))
        found.append((position, row, left, right, grams[at], mixed(context)))
    if not found:
        return tuple(np.zeros(0, np.uint64 if i > 3 else np.int64) for i in range(6))
    merged = [np.concatenate(x) for x in zip(*found, strict=True)]
    _, once = np.unique(merged[0], return_index=True)
    return tuple(x[once] for x in merged)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs under spans sorted by start."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], reach[last]


#: A row holds either a document's known spans or one context.
FOUND = "doc_id long, spans array<long>, hot boolean, at long, left int, body binary, asks boolean"


def first_pass(blocked: DataFrame, blocks: int, hot: int = HOT) -> DataFrame:
    def ask(table: pa.Table):
        # windows across rows may add anchors, so rows need the same order on both visits
        table = table.sort_by("doc_id")
        data, offsets = string_bytes(table.column("text").combine_chunks())
        position, row, left, right, gram, context = anchors(data, offsets)
        both = np.concatenate([mixed(gram), mixed(~context)])
        distinct, place, counts = np.unique(both, return_inverse=True, return_counts=True)
        return distinct, counts, (table.column("doc_id").to_numpy(), data, offsets, position, row, left, right, gram, context, place)

    def finish(table: pa.Table, kept, distinct: np.ndarray, totals: np.ndarray) -> pa.Table:
        ids, data, offsets, position, row, left, right, gram, context, place = kept
        of_gram, of_context = totals[place[: len(gram)]].astype(np.int64), totals[place[len(gram) :]].astype(np.int64)
        whole = of_context >= 2
        starts, ends = merged_spans(position[whole] - left[whole], position[whole] + right[whole])
        # contexts end within their rows, but those of neighbouring rows may touch
        starts, ends = split_at(starts, ends, offsets)
        home = np.searchsorted(offsets, starts, "right") - 1
        pairs = np.stack([starts - offsets[home], ends - offsets[home]], axis=1) if len(starts) else np.zeros((0, 2), np.int64)
        at = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]])) if len(home) else np.zeros(0, np.int64)
        spans = [p.reshape(-1) for p in np.split(pairs, at[1:])] if len(home) else []
        ship = np.flatnonzero((of_gram >= 2) & (of_gram > of_context))
        _, once = np.unique(context[ship], return_index=True)
        ship = ship[np.sort(once)]
        bodies = [data[p - a : p + b].tobytes() for p, a, b in zip(position[ship], left[ship], right[ship], strict=True)]
        n, m = len(spans), len(ship)
        return pa.table(
            [
                pa.array(np.concatenate([ids[home[at]], ids[row[ship]]])), pa.array(spans + [None] * m, pa.list_(pa.int64())), pa.array([None] * n + (of_gram[ship] > hot).tolist(), pa.bool_()),
                pa.array([None] * n + (position[ship] - offsets[row[ship]]).tolist(), pa.int64()), pa.array([None] * n + left[ship].tolist(), pa.int32()),
                pa.array([None] * n + bodies, pa.binary()), pa.array([None] * n + (~whole[ship]).tolist(), pa.bool_()),
            ],
            names=[x.split()[0] for x in FOUND.split(", ")],
        )

    return census(blocked, blocks, ask, finish, FOUND, per_range=4)  # anchors are few beside bytes


def split_at(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans cut wherever a row ends inside them."""
    low, high = np.searchsorted(offsets, starts, "right"), np.searchsorted(offsets, ends, "left")
    inner = np.concatenate([offsets[a:b] for a, b in zip(low, high, strict=True)] or [np.zeros(0, np.int64)])
    return np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))


def multikey_order(group: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Order of rows by group and then text: multikey quicksort, a word of 8 bytes at a time.

    All open runs are split at once: rows less than, equal to and greater than their run's pivot word.
    Equal ones go on with the next word, the others with the same one; runs of one row are done.
    """
    words = np.ascontiguousarray(text).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    start = np.ones(len(order), bool)
    start[1:] = group[order][1:] != group[order][:-1]
    places, depth = np.arange(len(order)), np.zeros(len(order), np.int64)
    while len(places):
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(places)))
        open_ = np.repeat((size > 1) & (depth[first] < words.shape[1]), size)
        places, depth, start = places[open_], depth[open_], start[open_]
        if not len(places):
            break
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(places)))
        rows = order[places]
        key = words[rows, depth]
        pivot = np.sort(np.stack([key[first], key[first + size // 2], key[first + size - 1]]), axis=0)[1]
        pivot = np.repeat(pivot, size)
        side = (key >= pivot).astype(np.int8) + (key > pivot)
        run = np.cumsum(start) - 1
        to = np.argsort(run * 3 + side, kind="stable")
        order[places], side = rows[to], side[to]
        depth = depth + (side == 1)
        start[1:] |= side[1:] != side[:-1]
    return order


def common_prefix(group: np.ndarray, text: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each row but the first in an order: how many leading bytes it shares with the row before; -1 in another group."""
    a, b = order[:-1], order[1:]
    differ = text[a] != text[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
    return np.where(group[a] == group[b], np.minimum(first, np.minimum(length[a], length[b])), -1)


def agreeing(bodies: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance d at which another context agrees on d bytes before and SPAN - d after; -1 if none."""
    n = len(bodies)
    size = np.array([len(b) for b in bodies])
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.cumsum(size) - size
    anchor = begin + left
    right = size - left

    def around(step: int, width: int, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        places = first[:, None] + step * np.arange(width)
        return np.where(np.arange(width) < length[:, None], flat[np.clip(places, 0, len(flat) - 1)], 0).astype(np.uint8)

    after = around(1, SPAN, right, anchor)
    before = around(-1, -(-LEFT // 8) * 8, left, anchor - 1)
    _, group = np.unique(np.ascontiguousarray(after[:, :KGRAM]).view(f"V{KGRAM}")[:, 0], return_inverse=True)
    by_after, by_before = multikey_order(group, after), multikey_order(group, before)
    lcp_after, lcp_before = common_prefix(group, after, right, by_after), common_prefix(group, before, left, by_before)
    least, most = np.full(n, -1), np.full(n, -1)
    rank_after, rank_before = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(LEFT + 1):
        rank_after[by_after] = np.concatenate([[0], np.cumsum(lcp_after < SPAN - d)])
        rank_before[by_before] = np.concatenate([[0], np.cumsum(lcp_before < d)])
        both = rank_after * n + rank_before
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        hit = np.zeros(n, bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        hit &= (left >= d) & (right >= SPAN - d)
        least[hit & (least < 0)] = d
        most[hit] = d
    return least, most


ANSWER = "doc_id long, spans array<long>"


def _answers(table, least: np.ndarray, most: np.ndarray) -> pa.Table:
    asks = np.array(table.column("asks").to_pylist(), bool)
    at = np.array(table.column("at").to_pylist(), np.int64)
    use = np.flatnonzero(asks & (most >= 0))
    return pa.table([table.column("doc_id").take(pa.array(use)), pa.array(list(np.stack([at - most, at - least + SPAN], axis=1)[use]), pa.list_(pa.int64()))], names=["doc_id", "spans"])


def sorted_spans(contexts: DataFrame, mb: float = BLOCK_MB) -> DataFrame:
    """Answers of contexts that are not hot, from sorted suffixes."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # a range: bounded by their number
        if parts and sum(p.num_rows for p in parts) > 1:
            table = pa.Table.from_batches(parts)
            found = agreeing(table.column("body").to_pylist(), np.array(table.column("left").to_pylist(), np.int64))
            yield from _answers(table, *found).combine_chunks().to_batches()

    size = contexts.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("b")).first()["b"]
    ranges = max(1, -(-size // int(mb * 1_000_000)))
    ranged = contexts.repartitionByRange(ranges, F.expr(f"substring(body, left + 1, {KGRAM})"))
    return ranged.mapInArrow(resolve, ANSWER)


def counted_spans(contexts: DataFrame, mb: float = BLOCK_MB) -> DataFrame:
    """Answers of contexts of very common k-grams, from counts of their windows."""

    def windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bodies = table.column("body").to_pylist()
        size = np.array([len(b) for b in bodies])
        count = size - SPAN + 1
        up, down = _powers(WIDTH + 1)
        flat = np.frombuffer(b"".join(bodies), np.uint8)
        begin = np.cumsum(size) - size
        place = np.arange(len(flat)) - np.repeat(begin, size)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[flat] * up[place], dtype=np.uint64)])
        of = np.repeat(np.arange(len(bodies)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        low = begin[of] + start
        # an anchor's distance tells apart the contexts of neighbouring anchors that hold one window
        distance = np.array(table.column("left").to_pylist(), np.int64)[of] - start
        return mixed(mixed((sums[low + SPAN] - sums[low]) * down[start]) + distance.astype(np.uint64)), of, start

    def ask(table: pa.Table):
        hashes, of, start = windows(table)
        distinct, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        return distinct, counts, (place, of, start)

    def finish(table: pa.Table, kept, distinct: np.ndarray, totals: np.ndarray) -> pa.Table:
        place, of, start = kept
        again = totals[place] >= 2
        left = np.array(table.column("left").to_pylist(), np.int64)
        d = left[of[again]] - start[again]
        most, least = np.full(len(left), -1), np.full(len(left), WIDTH)
        np.maximum.at(most, of[again], d)
        np.minimum.at(least, of[again], d)
        return _answers(table, least, most)

    rows = contexts.count()
    blocks = max(1, -(-rows * LEFT * 8 // int(8 * mb * 1_000_000)))
    blocked = contexts.withColumn("block", F.pmod(F.xxhash64("doc_id", "at"), F.lit(blocks)).cast("int"))
    return census(blocked, blocks, ask, finish, ANSWER)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeated_spans(docs: DataFrame, block_mb: float = BLOCK_MB, hot: int = HOT) -> DataFrame:
    """(doc_id, spans array<long>): starts and ends in bytes, of documents with any; they may overlap."""
    blocks = block_count(docs, block_mb)
    blocked = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    found = written(first_pass(blocked, blocks, hot), "anchors")
    contexts = found.where("body is not null")
    spans = found.where("spans is not null").select("doc_id", "spans")
    spans = spans.unionByName(sorted_spans(contexts.where("not hot"))).unionByName(counted_spans(contexts.where("hot")))
    return spans.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # bounded by the document's length


def removed(documents: DataFrame, block_mb: float = BLOCK_MB, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    docs = one_per_id(keyed_docs(documents))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                pairs = np.array(spans or [], np.int64).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                starts, ends = merged_spans(pairs[:, 0], pairs[:, 1])
                kept, at = hashlib.sha256(), 0
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                rows.append((doc_id, len(text), int((ends - starts).sum()), len(starts), kept.hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in REMOVED.split(", ")])

    spans = repeated_spans(docs, block_mb, hot)
    return docs.join(spans.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(cut, REMOVED)


#: DuckDB: every window hashed and counted.
ORACLE = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT doc_id, i, md5(hex(t[i:i + 199])) AS h FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 198)) AS i FROM d)),
c AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
m AS (SELECT doc_id, i AS a, i + 200 AS b FROM w SEMI JOIN c USING (h)),
g AS (SELECT *, coalesce(max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < a, true)::INT AS new FROM m),
s AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM g) GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b FROM s UNION ALL SELECT doc_id, octet_length(t) + 1, octet_length(t) + 1 FROM d),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 1) AS k0 FROM e),
q AS (SELECT doc_id, string_agg(hex(t[k0:a - 1]), '' ORDER BY a, b) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce((SELECT sum(b - a) FROM s WHERE s.doc_id = d.doc_id), 0)::BIGINT AS n_removed, (SELECT count(*) FROM s WHERE s.doc_id = d.doc_id) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN q USING (doc_id)
"""
