"""Ranked lexical search over a hierarchical max tree.

Documents are indexed in segments of bounded size: a row per (segment, term) lists the documents that
hold the term, with how often, and one row without term lists the segment's documents with their number
of terms. Corpus statistics are sums over that table. To search, the rows of terms that are asked for
meet, per segment and block of items, in one task. It weighs every posting and builds a tree over ranges
of documents: a node of a level covers FAN nodes of the level below, and holds for each of its terms the
maximum of the term's weighed postings in its range. A search descends from the root, best first: it
takes the open node with the highest sum of maxima over the item's terms, and opens it; a node with a
bound equal to a document's score is opened before that document comes out unless its range begins behind
it, so that ties come out in order of doc_id. Nodes whose bound is below the k-th score found so far are never opened. A segment answers with its k best of
each item; a rank over those gives the result.

All but the logarithm of a term's weight is whole-number arithmetic in 64 bits.

Defined results: a null or empty text has no terms, is never found and isn't counted; rows without doc_id
are left out; repeated rows count and are found as documents of their own; an item that is null, has a
null item_id or no known term has no rows; of repeated item_ids the smallest text counts; items
without hits give no rows; an empty table gives an empty table; a very long text is one document of a
segment of its own; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, keyed_docs, spread, string_bytes, words_of, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEST, FAN = 10, 16
#: A segment holds about this much text or this many documents; a task answers this many items at once.
SEGMENT_MB, SEGMENT_DOCS, ITEMS = 16, 65_536, 250

INDEX = "segment long, term string, docs array<int>, counts array<int>, ids array<long>"
HIT = "item_id long, doc_id long, score long"

#: Every byte that is part of a term as it counts, all others as a blank.
_FOLDED = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def folded(column: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased and every character between terms turned into a blank; bytes stay in place."""
    data, offsets = string_bytes(column)
    made = np.frombuffer(data.tobytes().translate(_FOLDED), np.uint8)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(made))


def segment_rows(batch: pa.RecordBatch, segment: int) -> pa.RecordBatch:
    """INDEX rows of one segment's documents."""
    terms, code, lengths = words_of(folded(batch.column("text")), lower=False)
    held = lengths > 0
    ids = batch.column("doc_id").to_numpy()[held]
    place = np.argsort(ids, kind="stable")  # documents in order of doc_id, so that ties are in order of place
    rank = np.empty(len(ids), np.int64)
    rank[place] = np.arange(len(ids))
    doc = np.repeat(rank, lengths[held])
    key, times = np.unique(code * max(1, len(ids)) + doc, return_counts=True)
    of_term, of_doc = key // max(1, len(ids)), key % max(1, len(ids))
    ends = np.searchsorted(of_term, np.arange(len(terms) + 1)).astype(np.int32)
    width = len(terms)
    lists = lambda values, cuts: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
    at = np.append(ends, ends[-1] + len(ids))
    docs = lists(pa.array(np.concatenate([of_doc, np.arange(len(ids))]), pa.int32()), at)
    counts = lists(pa.array(np.concatenate([times, lengths[held][place]]), pa.int32()), at)
    own = lists(pa.array(ids[place], pa.int64()), np.append(np.zeros(width + 1, np.int32), len(ids)))
    named = pa.concat_arrays([terms.cast(pa.string()), pa.nulls(1, pa.string())])
    return pa.record_batch([pa.array(np.full(width + 1, segment)), named, docs, counts, own], names=["segment", "term", "docs", "counts", "ids"])


def index(documents: DataFrame, segment_mb: float = SEGMENT_MB, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The inverted index, as a written table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in gathered(batches, int(segment_mb * 1_000_000)):
            for at in range(0, whole.num_rows, segment_docs):
                made = segment_rows(whole.slice(at, segment_docs), number)
                number += 1
                for first in range(0, made.num_rows, 4096):  # Arrow batches into the JVM stay small
                    yield made.slice(first, 4096)

    return written(spread(keyed_docs(documents)).mapInArrow(build, INDEX), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): the terms of each item, with repeats counted."""
    one = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return one.select("item_id", F.explode(found).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def weight(n: Column, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of a term in df of N documents."""
    double = lambda c: c.cast("double")
    return F.floor(1000 * F.ln((2 * double(n) + 2) / (2 * double(df) + 1))).cast("long")


def asked(items: DataFrame, rows: DataFrame, documents: int, per_block: int = ITEMS) -> DataFrame:
    """(block, term, weight, askers array<struct<item_id, times>>): at most ``per_block`` askers in a row."""
    terms = written(item_terms(items), "item-terms")
    count = terms.select("item_id").distinct().count()
    blocks = max(1, -(-count // per_block))
    # hash blocks are uneven, so there are twice as many as even ones would need
    block = F.pmod(F.xxhash64("item_id"), F.lit(2 * blocks if blocks > 1 else 1)).cast("int")
    known = rows.where("term is not null").join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weighed = known.select("term", weight(F.lit(documents), F.col("df")).alias("weight")).where("weight > 0")
    grouped = terms.groupBy(block.alias("block"), "term").agg(F.collect_list(F.struct("item_id", "times")).alias("askers"))  # a block's items at most
    return written(grouped.join(weighed, "term"), "asked-terms")


class MaxTree:
    """Levels of nodes; level 0 are the documents. A level has, node by node, its terms and their greatest values."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, documents: int, terms_all: int, fan: int = FAN) -> None:
        self.fan = fan
        order = np.lexsort((terms, docs))
        node, term, value = docs[order], terms[order], values[order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = max(1, documents)
        while True:
            self.levels.append((np.searchsorted(node, np.arange(count + 1)), term, value))
            if count == 1:
                break
            count = -(-count // fan)
            key = (node // fan) * terms_all + term
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            value = np.maximum.reduceat(value, first) if len(first) else value
            node, term = key[first] // terms_all, key[first] % terms_all

    def bounds(self, level: int, first: int, last: int, times: np.ndarray) -> np.ndarray:
        """Sums of times x maxima for the nodes first .. last - 1 of a level; ``times`` has a count for every term."""
        starts, term, value = self.levels[level]
        cuts = starts[first : last + 1]
        a, b = cuts[0], cuts[-1]
        sums = np.concatenate([[0], np.cumsum(times[term[a:b]] * value[a:b])])
        return sums[cuts[1:] - a] - sums[cuts[:-1] - a]

    def search(self, times: np.ndarray, best: int = BEST) -> list[tuple[int, int]]:
        """(document, score) of the ``best`` documents with a score above 0, by score and then by place."""
        top = len(self.levels) - 1
        root = int(self.bounds(top, 0, 1, times)[0])
        # of equal bounds the range that begins first, and of ranges with one beginning the wider: a tie that begins behind a document can wait
        heap = [(-root, 0, -top)] if root > 0 else []
        found: list[tuple[int, int]] = []
        kept: list[int] = []  # the best scores seen, smallest first
        while heap and len(found) < best:
            bound, begin, level = heapq.heappop(heap)
            if level == 0:
                found.append((begin, -bound))
                continue
            below = -level - 1
            width = self.fan**below
            first = begin // width
            last = min(first + self.fan, len(self.levels[below][0]) - 1)
            sums = self.bounds(below, first, last, times)
            least = max(1, kept[0] if len(kept) == best else 1)
            for i in np.flatnonzero(sums >= least).tolist():
                s = int(sums[i])
                heapq.heappush(heap, (-s, (first + i) * width, -below))
                if below == 0:
                    (heapq.heappushpop if len(kept) == best else heapq.heappush)(kept, s)
        return found


def search(documents: DataFrame, items: DataFrame, best: int = BEST, segment_mb: float = SEGMENT_MB, segment_docs: int = SEGMENT_DOCS, per_block: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item."""
    rows = index(documents, segment_mb, segment_docs)
    whole = rows.where("term is null").agg(F.coalesce(F.sum(F.size("docs")), F.lit(0)).alias("n"), F.coalesce(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("l")).first()
    total, length = int(whole["n"]), int(whole["l"])
    wanted = asked(items, rows, total, per_block)
    blocks = wanted.agg(F.collect_set("block").alias("blocks"))  # numbers of blocks, one for each 125 items or so
    numbers = F.array(*(F.lit(b) for b in sorted(blocks.first()["blocks"]))).cast("array<int>")
    postings = rows.join(wanted, "term").select("segment", "block", "docs", "counts", "ids", "weight", "askers")
    sizes = rows.where("term is null").select("segment", F.explode(numbers).alias("block"), "docs", "counts", "ids", F.lit(None).cast("long").alias("weight"), F.lit(None).cast("array<struct<item_id:bigint,times:bigint>>").alias("askers"))

    def answer(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_sizes = np.asarray(pc.is_null(table.column("weight")))
        own = table.filter(pa.array(is_sizes))
        ids, n = own.column("ids").combine_chunks().flatten().to_numpy(), own.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        terms = table.filter(pa.array(~is_sizes))
        out: list[tuple[int, int, int]] = []
        if terms.num_rows and len(ids):
            m = 25 + 75 * n * total // length
            docs = terms.column("docs").combine_chunks()
            width = pc.list_value_length(docs).to_numpy().astype(np.int64)
            term = np.repeat(np.arange(terms.num_rows), width)
            doc = docs.flatten().to_numpy().astype(np.int64)
            tf = terms.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
            values = np.repeat(terms.column("weight").to_numpy(), width) * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            tree = MaxTree(doc, term, values, len(ids), terms.num_rows)
            askers = terms.column("askers").combine_chunks()
            asker = np.repeat(np.arange(terms.num_rows), pc.list_value_length(askers).to_numpy())
            item, times = askers.flatten().field("item_id").to_numpy(), askers.flatten().field("times").to_numpy()
            order = np.argsort(item, kind="stable")
            item, times, asker = item[order], times[order], asker[order]
            cuts = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
            count = np.zeros(terms.num_rows, np.int64)
            for a, b in zip(cuts, np.append(cuts[1:], len(item)), strict=True):
                count[asker[a:b]] = times[a:b]
                out += [(int(item[a]), int(ids[d]), s) for d, s in tree.search(count, best)]
                count[asker[a:b]] = 0
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    hits = postings.unionByName(sizes).groupBy("segment", "block").applyInArrow(answer, HIT)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")


ORACLE = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), n AS MATERIALIZED (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
w AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM n),
t AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
i AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(min(text), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL GROUP BY item_id) GROUP BY item_id, term),
f AS MATERIALIZED (SELECT term, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight FROM t JOIN (SELECT DISTINCT term FROM i) USING (term), w GROUP BY term, big_n),
s AS (
  SELECT item_id, doc_id, row, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // l))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN t USING (term) JOIN n USING (row), w GROUP BY item_id, doc_id, row
), r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {BEST}
"""
