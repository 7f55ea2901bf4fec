"""Connected components by label propagation, in Spark."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links of which one task keeps a spanning forest.
FOREST = 200_000


def forest(batches):
    """Of the links (a, b) of a task those that join what the ones before have left apart."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, x)
        return top

    for batch in batches:
        kept = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                above[max(x, y)] = min(x, y)
                kept.append((a, b))
        if kept:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*kept, strict=True)], names=["a", "b"])


def thinned(links: DataFrame, most: int = FOREST) -> DataFrame:
    """Written links (a, b) that join all that ``links`` join, without most of those that others make needless.

    Every task keeps a forest of its share, so a dense group keeps about as many links as it has members, not
    pairs. It is done again as long as that halves them.
    """
    left = links.count()
    while left:
        parts, before = -(-left // most), left
        links = written(links.select("a", "b").repartition(parts).mapInArrow(forest, "a long, b long"), "forest")
        left = links.count()
        if parts == 1 or left * 2 > before:
            break
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of ``links`` (a, b): label is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label's own label, so long
    chains halve. Rounds are written to the shared folder and stop when no label moves.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), F.least("a", "label").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "seen"}), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        own = moved.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = moved.join(own, "label").select("node", "old", F.least("label", "further").alias("label"))
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label != old").isEmpty():
            return labels
