"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow
routes each pattern's words to the quotas of its sources; the k-th repetition of a pattern costs
k, so repetitions are spread before they are stacked. Everything is a DataFrame, whatever the
number of sources: their order and the level at which shares stop come from running sums over
ranges, and groups of sources that overlap are routed many to a task, never cut (a task holds totals
of patterns, not documents).

A pattern's words become whole documents: every document is taken floor(flow / size) times, and
those first in a seeded order once more until the rest is used up. The order is cut into bins
whose sizes are summed first, so that documents are only ranked within one bin.

Defined results: a null source is a source of its own, last in order; a null or empty text has
size 0 and is taken 0 words; repeated rows count as separate documents; rows without any source
are taken 0 times; equal ratios and hashes are ordered by source and row; very long texts are
only counted; an empty table gives an empty table; other columns are kept by ``mix_copies`` and
ignored by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, unpacked, written
from .components import components

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MAX_REPEATS, SEED, BINS_HEX = (5, 2, 1), 1.5, 2, "mix:", 3
#: Arcs between patterns and sources that a task routes at once, on average.
ARCS = 5_000


def flow(capacity: Sequence[float], members: Sequence[Sequence[int]], quota: Sequence[float], most: int = MAX_REPEATS) -> list[float]:
    """Min-cost flow from patterns to quotas: the words that each pattern gives.

    ``members`` lists each pattern's sources by their place in ``quota``. Only arcs out of the start
    cost anything, k for the k-th repetition, so cheapest paths first means: a maximum flow with every
    pattern once, then from there with every pattern twice, and so on. Each maximum is found by
    blocking flows over levels (breadth first, then depth first with a current arc per node).
    """
    n, m = len(capacity), len(quota)
    start, stop = n + m, n + m + 1
    to: list[int] = []
    room: list[float] = []
    arcs: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, size: float) -> None:
        for end, other, width in ((a, b, size), (b, a, 0.0)):
            arcs[end].append(len(to))
            to.append(other)
            room.append(width)

    for p in range(n):  # arc 2 p leads from the start to pattern p
        arc(start, p, 0.0)
    for p, own in enumerate(members):
        for s in own:
            arc(p, n + s, float("inf"))
    for s, words in enumerate(quota):
        arc(n + s, stop, float(words))
    tiny = 1e-6
    for _ in range(most):
        for p, size in enumerate(capacity):
            room[2 * p] += float(size)
        while True:
            level = [-1] * len(arcs)
            level[start], reached = 0, [start]
            for a in reached:
                for i in arcs[a]:
                    if room[i] > tiny and level[to[i]] < 0:
                        level[to[i]] = level[a] + 1
                        reached.append(to[i])
            if level[stop] < 0:
                break
            current, trail, at = [0] * len(arcs), [], start
            while True:
                if at == stop:
                    amount = min(room[i] for i in trail)
                    for i in trail:
                        room[i] -= amount
                        room[i ^ 1] += amount
                    full = next(k for k, i in enumerate(trail) if room[i] <= tiny)
                    at = to[trail[full] ^ 1]
                    del trail[full:]
                elif current[at] < len(arcs[at]):
                    i = arcs[at][current[at]]
                    if room[i] > tiny and level[to[i]] == level[at] + 1:
                        trail.append(i)
                        at = to[i]
                    else:
                        current[at] += 1
                elif trail:
                    at = to[trail.pop() ^ 1]
                    current[at] += 1
                else:
                    break
    return [room[2 * p + 1] for p in range(n)]


def running(rows: DataFrame, order: list[Column], sums: dict[str, str], name: str) -> DataFrame:
    """``rows`` with ``place`` (1, 2, ...) in an order without ties, and running sums before each row.

    Rows are range-partitioned by the order and written with their range, so each task adds up one
    range; a row per range gives what lies before it.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = ranged.groupBy("range").agg(F.count("*").alias("rows"), *(F.sum(c).alias(f"all_{out}") for out, c in sums.items()))
    ahead = whole.select("range", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"ahead_{out}") for out, c in [("place", "rows"), *((o, f"all_{o}") for o in sums)]))
    inside = Window.partitionBy("range").orderBy(*order)
    held = ranged.withColumns({"place": F.row_number().over(inside), **{out: F.coalesce(F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for out, c in sums.items()}})
    found = held.join(ahead, "range")
    return found.withColumns({out: F.col(out) + F.col(f"ahead_{out}") for out in ("place", *sums)}).drop("range", *(f"ahead_{out}" for out in ("place", *sums)))


def targets(sizes: DataFrame, total: float, weights: Sequence[float] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """From (source, source_size): (source, source_size, target, node), node being the source's place in order.

    ``total`` words are divided by weight; a share stops at ``most`` times its size and the
    excess is divided anew. In order of size / weight there is one level at which the rest stops.
    """
    null_last = [F.col("source").isNull(), F.col("source")]
    placed = running(sizes, null_last, {}, "mix-sources").withColumnRenamed("place", "node")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("node") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = placed.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    ordered = running(weighed.withColumn("ratio", F.col("most") / F.col("weight")), [F.col("ratio"), F.col("node")], {"used": "most", "lighter": "weight"}, "mix-ratios")
    all_weight = ordered.agg(F.coalesce(F.sum("weight"), F.lit(1.0)).alias("w")).first()["w"]
    level = (F.lit(float(total)) - F.col("used")) / (F.lit(all_weight) - F.col("lighter"))
    # the first source that its share does not fill, or the last one
    found = ordered.agg(F.min_by(level, F.when(level <= F.col("ratio"), F.col("place"))).alias("level"), F.max_by(level, "place").alias("last")).first()
    known = ordered.withColumn("level", F.lit(found["last"] if found["level"] is None else found["level"]).cast("double"))
    return known.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"), F.col("node").cast("long").alias("node"))


def routed(patterns: DataFrame, quotas: DataFrame, overlap: bool, arcs: int, most: int = MAX_REPEATS) -> DataFrame:
    """(pattern, flow): patterns (pattern, words, sources) routed to quotas (source, source_size, target, node).

    Groups of sources that overlap don't touch each other, so a task routes many groups in one flow: about
    ARCS of the ``arcs`` between patterns and sources, a group never cut. Without ``overlap`` every
    pattern has one source, which is its group.
    """
    named = quotas.select(F.col("source").alias("of_source"), "target", "node")
    found = patterns.select("pattern", "words", F.explode("sources").alias("source")).join(named, F.col("source").eqNullSafe(F.col("of_source"))).select("pattern", "words", "node", "target")
    if overlap:
        found = written(found, "mix-arcs")
        first = found.groupBy("pattern").agg(F.min("node").alias("first"))
        links = found.join(first, "pattern").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
        found = found.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        found = found.withColumn("label", F.col("node"))

    def route(arcs_of: pd.DataFrame) -> pd.DataFrame:
        arcs_of = arcs_of.sort_values(["pattern", "node"])
        names, first = arcs_of["pattern"].unique(), arcs_of.drop_duplicates("pattern")
        nodes = arcs_of.drop_duplicates("node")
        place = {node: i for i, node in enumerate(nodes["node"])}
        starts = arcs_of["pattern"].ne(arcs_of["pattern"].shift()).to_numpy().nonzero()[0]
        members = [[place[x] for x in own] for own in np.split(arcs_of["node"].to_numpy(), starts[1:])]
        return pd.DataFrame({"pattern": names, "flow": flow(first["words"].tolist(), members, nodes["target"].tolist(), most)})

    part = F.pmod(F.xxhash64("label"), F.lit(max(1, -(-arcs // ARCS))))
    return found.withColumn("part", part).groupBy("part").applyInPandas(route, "pattern string, flow double")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pattern_of(sources: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(sources)))


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """From (sources array<string>, size): per source (source, source_size, target), per pattern (pattern, words, flow)."""
    patterns = written(sized.groupBy(pattern_of(F.col("sources")).alias("pattern")).agg(F.sum("size").alias("words"), F.first(F.array_distinct("sources")).alias("sources")), "mix-patterns")
    sizes = patterns.select("words", F.explode("sources").alias("source")).groupBy("source").agg(F.sum("words").alias("source_size"))
    whole = patterns.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.max(F.size("sources")), F.lit(0)).alias("width"), F.coalesce(F.sum(F.size("sources")), F.lit(0)).alias("arcs")).first()
    by_source = written(targets(sizes, share * whole["words"], weights, most), "mix-targets")
    # a pattern without sources has no arc, and no flow
    by_pattern = patterns.select("pattern", "words").join(routed(patterns, by_source, whole["width"] > 1, whole["arcs"], most), "pattern", "left")
    capped = F.least(F.coalesce("flow", F.lit(0.0)), (F.col("words") * most).cast("double"))
    return by_source.drop("node"), by_pattern.select("pattern", "words", capped.alias("flow"))


def copies(sized: DataFrame, by_pattern: DataFrame, seed: str = SEED, tie: str = "size") -> DataFrame:
    """``sized`` (row_key, sources, size) with ``pattern`` and ``copies``: how often the mix takes each document; ``tie`` orders rows of equal key and size.

    Patterns are read from a written table, so Catalyst knows its size and broadcasts it only below
    the session's limit; beyond, both sides are shuffled and AQE splits a hot pattern.
    """
    order = F.md5(F.concat(F.lit(seed), F.col("row_key")))
    docs = sized.withColumns({"pattern": pattern_of(F.col("sources")), "place": order})
    docs = docs.withColumn("bin", F.substring("place", 1, BINS_HEX))
    need = by_pattern.withColumn("base", F.when(F.col("words") > 0, F.floor(F.col("flow") / F.col("words"))).otherwise(0).cast("long"))
    need = need.withColumn("rest", F.col("flow") - F.col("base") * F.col("words")).select("pattern", "base", "rest")
    bins = docs.groupBy("pattern", "bin").agg(F.sum("size").alias("in_bin")).withColumn("upto", F.sum("in_bin").over(Window.partitionBy("pattern").orderBy("bin")))
    cut = bins.join(need, "pattern").where(F.col("upto") > F.col("rest"))
    cut = cut.groupBy("pattern").agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("in_bin")).alias("before")), "bin").alias("cut"))
    known = written(need.join(cut, "pattern", "left"), "mix-cuts")
    docs = docs.join(known, "pattern")
    inside = docs.where(F.col("bin") == F.col("cut.bin"))
    through = F.col("cut.before") + F.sum("size").over(Window.partitionBy("pattern").orderBy("place", "row_key", "size", tie).rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("copies", F.col("base") + (through - F.col("size") / 2 <= F.col("rest")).cast("long"))
    outside = docs.where(F.col("cut.bin").isNull() | (F.col("bin") != F.col("cut.bin")))
    outside = outside.withColumn("copies", F.col("base") + F.when(F.col("cut.bin").isNull(), F.lit(0)).otherwise((F.col("bin") < F.col("cut.bin")).cast("long")))
    return outside.unionByName(inside).drop("place", "bin", "base", "rest", "cut")


def _sized(documents: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return written(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"), key.alias("row_key")), "mix-sizes")


def mix(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every document."""
    sized = _sized(documents)
    by_source, by_pattern = plan(sized)
    taken = copies(sized, by_pattern)
    # a source is joined by its pattern, which is never null
    known = by_source.select(pattern_of(F.array("source")).alias("pattern"), "source_size", "target")
    return taken.join(known, "pattern").select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mix_copies(documents: DataFrame) -> DataFrame:
    """The mix itself: each row as many times as it is taken (rows of size 0 go).

    Rows are taken under a written number of their own. doc_id gives their order, as in ``mix``; rows without one
    are ordered by that number.
    """
    whole = written(packed(documents).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string")))
    sized = written(whole.select("row", F.array("kept.source").alias("sources"), word_count(F.col("text")).alias("size"), key.alias("row_key")), "mix-sizes")
    taken = copies(sized, plan(sized)[1], tie="row").where("copies > 0 and size > 0").select(F.col("row").alias("of_row"), F.col("copies").cast("int").alias("times"))
    repeated = whole.join(taken.hint("shuffle_hash"), F.col("row") == F.col("of_row"))
    return unpacked(repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))), documents.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || doc_id::VARCHAR) AS place FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source
), o AS (
  SELECT *, 2 * source_size / w AS ratio, row_number() OVER (ORDER BY 2 * source_size / w, source) AS n,
    1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(w) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM s
), l AS (SELECT remaining / weight AS level FROM o WHERE remaining / weight <= ratio ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, least(2 * source_size, level * w) AS target FROM o, l),
k AS (SELECT source, source_size, target, floor(target / source_size) AS base, target - floor(target / source_size) * source_size AS rest FROM t),
c AS (
  SELECT doc_id, size, source_size, target, base, rest, sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS middle
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 6) AS target, (size * (base + CASE WHEN middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken,
  (base + CASE WHEN middle <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM c
"""
