"""Two renderings of one clip, or two sets of weights, held against each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import image_metrics_udf


def zipped(series: list[DataFrame], clip: str, order: str) -> DataFrame:
    """(clip, position, one ``has_i`` per series, their columns): frames of equal 0-based position side by side.

    Every series keeps its frames; where a shorter one has ended its columns are null and ``has_i`` is false, so
    the frames all have are those with every ``has_i``. Ties of ``order`` take either order; rows without clip have no
    partner. Columns besides clip and order must differ between the series.
    """
    w = Window.partitionBy(clip).orderBy(order)
    placed = [s.withColumn("position", F.row_number().over(w).cast("long") - 1).drop(order).withColumn(f"__has_{i}", F.lit(True)) for i, s in enumerate(series)]
    joined = reduce(lambda a, b: a.join(b, [clip, "position"], "full"), placed)
    return joined.withColumnsRenamed({f"__has_{i}": f"has_{i}" for i in range(len(series))}).fillna(False, [f"has_{i}" for i in range(len(series))])


def _errors(a: Column, b: Column) -> dict[str, Column]:
    """mae, rmse and max_abs of two arrays of numbers; null where one is null or their lengths differ."""
    gap = F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    size = F.nullif(F.size(gap), F.lit(0))
    return {"mae": total(gap) / size, "rmse": F.sqrt(total(F.transform(gap, lambda x: x * x)) / size), "max_abs": F.array_max(gap)}


def temporal_errors(pairs: DataFrame, clip: str, order: str, a: str, b: str, shape: tuple[int, int] | None = None) -> DataFrame:
    """Per frame but the first of each clip: errors between the motion of two series since the frame before.

    ``a`` and ``b`` are flat images. With a shape (height, width) there is the structural similarity of both motions
    too, shifted by 128 and cut to 0..255. One sort by clip, no join; Python only for the similarity.
    """
    w = Window.partitionBy(clip).orderBy(order)
    moved = pairs.withColumns({f"__{c}": F.lag(c).over(w) for c in (a, b)}).withColumn("__n", F.row_number().over(w)).where("__n > 1")
    delta = {f"__d_{c}": F.zip_with(c, f"__{c}", lambda x, y: x.cast("double") - y) for c in (a, b)}
    moved = moved.withColumns(delta)
    kept = moved.select(clip, order, *(v.alias(k) for k, v in _errors(F.col(f"__d_{a}"), F.col(f"__d_{b}")).items()), f"__d_{a}", f"__d_{b}")
    if shape:
        seen = [F.transform(f"__d_{c}", lambda x: F.greatest(F.lit(0.0), F.least(F.lit(255.0), x + 128))) for c in (a, b)]
        kept = kept.withColumn("ssim", image_metrics_udf(*shape)(*seen)["ssim"])
    return kept.drop(f"__d_{a}", f"__d_{b}")


def weight_parity(left: DataFrame, right: DataFrame, name: str, values: str) -> DataFrame:
    """One row over all parameters of two sets of named arrays: parameter_count, mae, max_abs.

    A name on one side only, or with another number of values, fails the job; two empty sets give 0, null and 0.
    """
    a, b = left.select(name, F.col(values).alias("__a")), right.select(name, F.col(values).alias("__b"))
    both = a.join(b, name, "full")
    fair = F.coalesce(F.size("__a") == F.size("__b"), F.lit(False))
    size = F.when(fair, F.size("__a")).otherwise(F.raise_error(F.concat(F.lit("names or sizes differ: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("int"))
    gap = F.zip_with("__a", "__b", lambda x, y: F.abs(x.cast("double") - y))
    rows = both.select(size.cast("long").alias("n"), F.aggregate(gap, F.lit(0.0), lambda s, x: s + x).alias("total"), F.coalesce(F.array_max(gap), F.lit(0.0)).alias("most"))
    count = F.coalesce(F.sum("n"), F.lit(0))
    return rows.agg(count.alias("parameter_count"), (F.sum("total") / F.nullif(count, F.lit(0))).alias("mae"), F.coalesce(F.max("most"), F.lit(0.0)).alias("max_abs"))
