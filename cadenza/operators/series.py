"""Operators over ordered frames of a clip: folds, gap filling, smoothing, neighbours.

``clip`` and ``order`` name the columns that partition and order the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from .folds import Follows, leaps
from .scans import SEGMENT, around, numbered, overlapping, own_rows


def accepted(df: DataFrame, clip: str, order: str, columns: list[str], close: Follows, out: str = "accepted") -> DataFrame:
    """Mark rows that are close to the last accepted row of their clip; the first row with values is accepted.

    Rows with a null among ``columns`` get null and change nothing. A rejected row never becomes the
    row to compare with, so this is a fold rather than a lag.
    """
    shown = lambda usable, reached, last, since: [pa.array(reached, mask=~usable)]
    return leaps(df, clip, order, columns, lambda v: np.ones(len(v), bool), close, [StructField(out, BooleanType())], shown)


def near_value(most: float) -> Follows:
    return lambda last, v: np.abs(v[..., 0] - last[..., 0]) <= most


def near_box(width: float, height: float, center: float = 0.05, ratio: float = 1.15) -> Follows:
    """Centres within a share of the frame, and sides within a ratio of each other."""

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        (a0, a1, a2, a3), (b0, b1, b2, b3) = np.moveaxis(a, -1, 0), np.moveaxis(b, -1, 0)
        near = np.hypot((a0 + a2 - b0 - b2) / 2 / width, (a1 + a3 - b1 - b3) / 2 / height) <= center
        for own, theirs in ((b2 - b0, a2 - a0), (b3 - b1, a3 - a1)):
            side = own / np.maximum(theirs, 1e-9)
            near = near & (1 / ratio <= side) & (side <= ratio)
        return near

    return close


def small_jump(width: float, height: float, most: float = 0.25) -> Follows:
    """Centre moves at most a share of the frame's diagonal."""
    diagonal = np.hypot(width, height)
    return lambda a, b: np.hypot((a[..., 0] + a[..., 2] - b[..., 0] - b[..., 2]) / 2, (a[..., 1] + a[..., 3] - b[..., 1] - b[..., 3]) / 2) / diagonal <= most


def fill_short_gaps(df: DataFrame, clip: str, order: str, columns: list[str], longest: int, flag: str = "interpolated", segment: int = SEGMENT) -> DataFrame:
    """Fill inner runs of nulls no longer than ``longest``: linear by place in the run, halves to even.

    Leading and trailing runs stay null. All columns are null together.
    """
    near = around(df, clip, order, F.col(columns[0]).isNotNull(), columns, segment)
    gap = F.col("__after.at") - F.col("__before.at") - 1
    fills = F.col(columns[0]).isNull() & (gap <= longest)
    share = (F.col("__pos") - F.col("__before.at")) / (gap + 1)
    made = {}
    for c in columns:
        a, b = F.col(f"__before.{c}"), F.col(f"__after.{c}")
        made[c] = F.when(fills, F.rint(a + (b - a) * share).cast(dict(df.dtypes)[c])).otherwise(F.col(c))
    return near.withColumns(made | {flag: F.coalesce(fills, F.lit(False))}).drop("__pos", "__before", "__after")


def fill_signal(df: DataFrame, clip: str, order: str, column: str, out: str, segment: int = SEGMENT) -> DataFrame:
    """Linear inside, nearest value at the ends, 0 where a clip has no value."""
    near = around(df, clip, order, F.col(column).isNotNull(), [column], segment)
    a, b = F.col(f"__before.{column}"), F.col(f"__after.{column}")
    share = (F.col("__pos") - F.col("__before.at")) / (F.col("__after.at") - F.col("__before.at"))
    value = F.coalesce(F.col(column), a + (b - a) * share, a, b, F.lit(0.0))
    return near.withColumn(out, value).drop("__pos", "__before", "__after")


def smoothed(df: DataFrame, clip: str, at: str, columns: list[str], radius: int, segment: int) -> DataFrame:
    """Mean of the rows whose ``at`` differs by at most ``radius``, halves to even, in segments that overlap by it."""
    w = Window.partitionBy(clip, "__seg").orderBy(at).rangeBetween(-radius, radius)
    return own_rows(overlapping(df, at, radius, segment).withColumns({f"{c}_smooth": F.rint(F.avg(c).over(w)).cast("long") for c in columns}))


def smooth_by_index(df: DataFrame, clip: str, order: str, columns: list[str], radius: int, segment: int = SEGMENT) -> DataFrame:
    """Mean of rows whose index differs by at most ``radius`` (not of neighbouring rows), halves to even."""
    return smoothed(df, clip, order, columns, radius, segment)


def smooth_by_row(df: DataFrame, clip: str, order: str, columns: list[str], radius: int, segment: int = SEGMENT) -> DataFrame:
    """Mean of ``radius`` rows on either side, whatever their index, halves to even."""
    return smoothed(numbered(df, clip, clip, order, "__place", segment), clip, "__place", columns, radius, segment).drop("__place")


def consecutive_deltas(df: DataFrame, clip: str, order: str, column: str, segment: int = SEGMENT) -> DataFrame:
    """Change from the previous row, only where it is the previous index too."""
    w = Window.partitionBy(clip, "__seg").orderBy(order)
    steps = overlapping(df, order, 1, segment).withColumns({"__before": F.lag(order).over(w), "delta": F.abs(F.col(column) - F.lag(column).over(w))})
    return own_rows(steps).where(F.col(order) == F.col("__before") + 1).drop("__before")


def shift_window(values: Column, by: int) -> Column:
    """Array moved ``by`` places forward, its last element repeated at the end."""
    n = F.size(values)
    return F.when(n == 0, values).otherwise(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(values, F.least(i + by, n))))


def shifted(df: DataFrame, clip: str, order: str, column: str, by: int, out: str) -> DataFrame:
    """The value ``by`` rows on in the clip; the last row's value where the clip has ended."""
    w = Window.partitionBy(clip).orderBy(order)
    there = F.lead(F.struct(column), by).over(w)  # a struct, as the value itself may be null
    last = F.last(F.struct(column)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(out, F.coalesce(there, last)[column])


def context_window(values: Column, index: Column, width: int = 20) -> Column:
    """``width`` elements from ``index`` on, moved back at the end; null if there are fewer."""
    start = F.greatest(F.lit(0), F.least(index, F.size(values) - width))
    return F.when(F.size(values) >= width, F.slice(values, start.cast("int") + 1, width))


def session_row(local: Column, size: Column) -> Column:
    """0-based row of a session's windows for a 1-based local index, clamped."""
    return F.least(F.greatest(local - 1, F.lit(0)), size - 1)


def session_chunks(total: Column, first: int = 20, step: int = 50) -> Column:
    """array<struct<start, length>>: a first chunk, then equal ones, then the rest."""
    starts = F.when(total <= first, F.array(F.lit(0))).otherwise(F.concat(F.array(F.lit(0)), F.sequence(F.lit(first), total - 1, F.lit(step))))
    length = lambda s: F.least(F.when(s == 0, F.lit(first)).otherwise(F.lit(step)), total - s)
    return F.when(total > 0, F.transform(starts, lambda s: F.struct(s.cast("long").alias("start"), length(s).cast("long").alias("length")))).otherwise(
        F.array().cast("array<struct<start:bigint,length:bigint>>")
    )


def improvements(df: DataFrame, clip: str, order: str, column: str, least: float, patience: int) -> DataFrame:
    """Best value so far, steps since it moved, and whether patience has run out.

    The best moves only for a value smaller by more than ``least``, so it is a fold; null values count as steps.
    """

    def shown(usable: np.ndarray, reached: np.ndarray, last: np.ndarray, since: np.ndarray) -> list[pa.Array]:
        best = np.where(np.isnan(last[:, 0]), np.inf, last[:, 0])
        return [pa.array(best), pa.array(since), pa.array(since >= patience)]

    fields = [StructField("best", DoubleType()), StructField("stale", LongType()), StructField("stopped", BooleanType())]
    return leaps(df, clip, order, [column], lambda v: v[..., 0] < np.inf, lambda best, v: v[..., 0] < best[..., 0] - least, fields, shown)


def phase(step: Column, last: int, warmup: int, stabilise: int) -> Column:
    return F.when(step <= warmup, "warmup").when(step > last - stabilise, "stabilization").otherwise("main")
