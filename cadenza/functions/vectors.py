"""Array-as-vector expressions, in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column, least: float = 1e-12) -> Column:
    """The vector over its norm; null if the norm is not above ``least``."""
    return F.when(norm(a) > least, F.transform(a, lambda x: x.cast("double") / norm(a)))


def array_stats(a: Column) -> dict[str, Column]:
    n = F.size(a)
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double")) / n
    square = F.aggregate(a, F.lit(0.0), lambda s, x: s + (x.cast("double") - mean) * (x.cast("double") - mean)) / n
    return {"size": n.cast("long"), "min": F.array_min(a).cast("double"), "max": F.array_max(a).cast("double"), "mean": mean, "std": F.sqrt(square)}


def array_errors(a: Column, b: Column) -> dict[str, Column]:
    """Mean absolute, root mean square and greatest difference, and equality."""
    gaps = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    total = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)
    squares = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    return {"mae": total / F.size(gaps), "rmse": F.sqrt(squares / F.size(gaps)), "max_abs": F.array_max(gaps), "equal": F.array_max(gaps) == 0}
