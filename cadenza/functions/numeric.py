"""Number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    """Round halves to the even neighbour, as an integer."""
    return F.rint(x).cast("long")


def angle_delta(target: Column, source: Column) -> Column:
    """Signed difference of two angles in degrees, in (-180, 180]."""
    turned = F.pmod(target - source + 180.0, F.lit(360.0)) - 180.0
    return F.when(turned == -180.0, 180.0).otherwise(turned)


def spread_index(k: Column, size: Column, picks: Column) -> Column:
    """Position of the k-th of ``picks`` evenly spread picks among ``size`` items; the last pick is the last item."""
    inner = F.floor(k * ((size - 1) / (picks - 1)))
    return F.when(picks <= 1, F.lit(0)).when(k == picks - 1, size - 1).otherwise(inner).cast("long")


def psnr(rmse: Column, peak: float = 255.0) -> Column:
    return F.when(rmse == 0, F.lit(float("inf"))).otherwise(20 * F.log10(F.lit(peak) / rmse))


def finite(x: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def distribution(x: Column) -> list[Column]:
    """Aggregates over finite values: count, min, max, mean, population deviation, exact linear p50 and p90."""
    v = finite(x)
    return [
        F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"), F.percentile(v, 0.5).alias("p50"), F.percentile(v, 0.9).alias("p90"),
    ]


def weighted_mean(x: Column, weight: Column) -> Column:
    """Null where no weight is positive, or any weight is negative or not finite."""
    fair = (F.min(weight) >= 0) & (F.sum(weight) > 0) & (F.count_if(finite(weight).isNull() | finite(x).isNull()) == 0)
    return F.when(fair, F.sum(x * weight) / F.sum(weight))
