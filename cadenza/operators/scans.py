"""Nearest values on either side of a row, by scans over segments of a clip.

A clip is cut into segments by its order column, so that no clip is one task. A segment is scanned forwards
for the last value before each row and, in descending order, for the next one behind: in both directions a
running ``last``, which costs a step per row, where a frame that begins at the row and ends with the clip
would be gone through anew for each. A row per segment says how many rows it has and its first and last
values; what a clip's other segments leave at a segment's ends is carried over by windows over those rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a segment, if orders are whole numbers without repeats.
SEGMENT = 50_000


def same(pairs: list[tuple[Column, Column]]) -> Column:
    """A join condition under which nulls are equal."""
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in pairs))


def numbered(df: DataFrame, group: str, clip: str, order: str, out: str = "place", segment: int = SEGMENT) -> DataFrame:
    """``df`` with the place (1, 2, ...) of each row of a group in order of (clip, order).

    Rows are ranked within their segment and start at the sum of the segments before it; one task per group
    sums a row per segment, none holds a clip or a group. Nulls come first, rows of equal order in some order.
    """
    cut = df.withColumn("__seg", F.floor(F.col(order) / segment))
    before = Window.partitionBy("__group").orderBy("__clip", "__of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(F.col(group).alias("__group"), F.col(clip).alias("__clip"), F.col("__seg").alias("__of")).agg(F.count("*").alias("__rows"))
    bases = sizes.select("__group", "__clip", "__of", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__base"))
    ranked = cut.withColumn("__n", F.row_number().over(Window.partitionBy(group, clip, "__seg").orderBy(order)))
    joined = ranked.join(bases, same([(F.col(group), F.col("__group")), (F.col(clip), F.col("__clip")), (F.col("__seg"), F.col("__of"))]))
    return joined.withColumn(out, F.col("__n") + F.col("__base")).drop("__seg", "__n", "__group", "__clip", "__of", "__base")


def overlapping(df: DataFrame, at: str, radius: int, segment: int = SEGMENT) -> DataFrame:
    """Rows with their segment __seg of ``at``; those within ``radius`` of a neighbouring segment are in that one too, without __own."""
    own, low, high = (F.floor((F.col(at) + d) / segment) for d in (0, -radius, radius))
    listed = df.withColumn("__seg", F.explode_outer(F.sequence(low, high)))
    return listed.withColumn("__own", F.col("__seg").eqNullSafe(own))


def own_rows(df: DataFrame) -> DataFrame:
    """What windows over ``overlapping`` segments found, each row once."""
    return df.where("__own").drop("__seg", "__own")


def around(df: DataFrame, clip: str, order: str, present: Column, values: list[str], segment: int = SEGMENT) -> DataFrame:
    """``df`` with __pos (1, 2, ... in a clip) and, of the nearest rows at or before and at or behind each row where
    ``present`` holds, structs __before and __after of their position ``at`` and ``values``; null where there is none.

    Rows of equal order come in some order, the same for both directions.
    """
    cut = df.withColumn("__seg", F.floor(F.col(order) / segment))
    inside = Window.partitionBy(clip, "__seg")
    placed = cut.withColumn("__n", F.row_number().over(inside.orderBy(order)).cast("long"))
    own = F.when(present, F.struct(F.col("__n").alias("at"), *(F.col(v) for v in values)))
    scanned = placed.withColumns({
        "__prev": F.last(own, ignorenulls=True).over(inside.orderBy(F.col(order)).rowsBetween(Window.unboundedPreceding, 0)),
        "__next": F.last(own, ignorenulls=True).over(inside.orderBy(F.desc("__n")).rowsBetween(Window.unboundedPreceding, 0)),
    })
    ends = placed.groupBy(F.col(clip).alias("__clip"), F.col("__seg").alias("__of")).agg(
        F.count("*").alias("__rows"), F.min_by(own, F.when(present, F.col("__n"))).alias("__first"), F.max_by(own, F.when(present, F.col("__n"))).alias("__last")
    )
    by_segment = Window.partitionBy("__clip").orderBy("__of")
    ends = ends.withColumn("__base", F.coalesce(F.sum("__rows").over(by_segment.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    moved = lambda c: F.when(F.col(c).isNotNull(), F.col(c).withField("at", F.col(f"{c}.at") + F.col("__base")))
    ends = ends.withColumns({"__first": moved("__first"), "__last": moved("__last")})
    behind = Window.partitionBy("__clip").orderBy(F.desc("__of"))
    ends = ends.select(
        "__clip", "__of", "__base", F.last("__last", ignorenulls=True).over(by_segment.rowsBetween(Window.unboundedPreceding, -1)).alias("__left"),
        F.last("__first", ignorenulls=True).over(behind.rowsBetween(Window.unboundedPreceding, -1)).alias("__right"),
    )
    joined = scanned.join(ends, same([(F.col(clip), F.col("__clip")), (F.col("__seg"), F.col("__of"))]))
    found = joined.withColumns({"__before": F.coalesce(moved("__prev"), F.col("__left")), "__after": F.coalesce(moved("__next"), F.col("__right")), "__pos": F.col("__n") + F.col("__base")})
    return found.drop("__seg", "__n", "__prev", "__next", "__clip", "__of", "__base", "__left", "__right")
