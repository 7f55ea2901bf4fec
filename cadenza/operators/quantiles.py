"""Exact quantiles without holding a group.

One aggregation counts values in bins that widen with the value (a tenth of a percent each, the same for
every group, so nothing has to be known before). Running counts over a group's bins, of which there are a
few thousand, tell the bins that hold the ranks asked for. Only those bins' values are read again, counted by
value and run through; a window over them keeps two numbers and spills its input. The bins' numbers come
from the logarithm of Java's strict library, which never falls where its argument rises.

Results are those of ``percentile``: linear between the two nearest ranks, to the last bit. Nulls don't
count; infinities are values; NaN is the greatest value; a group without values has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import same

#: Bins per factor of e, and the value up to which bins are as wide as at 0.
FINE, LEAST = 1000, 1e-6


def bin_of(value: Column) -> Column:
    """A whole number that never falls where ``value`` rises."""
    scaled = F.floor(F.log1p(F.abs(value) / LEAST) * FINE).cast("long")
    return F.when(F.isnan(value), F.lit(2**63 - 1)).when(value < 0, -scaled).otherwise(scaled)


def quantiles(df: DataFrame, group: list[str], columns: dict[str, Column], probs: list[float]) -> DataFrame:
    """(group, one array<double> of exact quantiles at ``probs`` per name): the quantiles of each column's values."""
    named = F.array(*(F.struct(F.lit(name).alias("__name"), c.cast("double").alias("__v")) for name, c in columns.items()))
    long = df.select(*group, F.inline(named)).where(F.col("__v").isNotNull()).withColumn("__bin", bin_of(F.col("__v")))
    keys = [*group, "__name"]
    counts = long.groupBy(*keys, "__bin").agg(F.count("*").alias("__c"))
    whole = Window.partitionBy(*keys)
    upto = F.sum("__c").over(whole.orderBy("__bin"))
    cut = counts.withColumns({"__n": F.sum("__c").over(whole), "__below": upto - F.col("__c"), "__upto": upto})
    places = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*(x for p in places for x in (F.floor(p), F.ceil(p)))))
    inside = F.filter(ranks, lambda r: (r >= F.col("__below")) & (r < F.col("__upto")))
    hit = cut.withColumn("__ranks", inside).where(F.size("__ranks") > 0).select(*(F.col(k).alias(f"__of_{k}") for k in keys), F.col("__bin").alias("__of_bin"), "__n", "__below", "__ranks")
    read = long.join(hit, same([*((F.col(k), F.col(f"__of_{k}")) for k in keys), (F.col("__bin"), F.col("__of_bin"))]))
    values = read.groupBy(*keys, "__bin", "__v").agg(F.count("*").alias("__c"), F.first("__n").alias("__n"), F.first("__below").alias("__below"), F.first("__ranks").alias("__ranks"))
    through = F.col("__below") + F.sum("__c").over(Window.partitionBy(*keys, "__bin").orderBy("__v"))
    found = values.withColumn("__upto", through).withColumn("__own", F.filter("__ranks", lambda r: (r >= F.col("__upto") - F.col("__c")) & (r < F.col("__upto"))))
    # a rank is met once, and there are at most two for each of ``probs``
    met = found.select(*keys, "__n", "__v", F.explode("__own").alias("__rank")).groupBy(*keys).agg(F.first("__n").alias("__n"), F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__at"))

    def between(p: float) -> Column:
        place = (F.col("__n") - 1) * F.lit(float(p))
        low, high = F.element_at("__at", F.floor(place)), F.element_at("__at", F.ceil(place))
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    each = met.select(*keys, F.array(*map(between, probs)).alias("__q"))
    return each.groupBy(*group).agg(*(F.first(F.when(F.col("__name") == name, F.col("__q")), ignorenulls=True).alias(name) for name in columns))


def with_quantiles(rows: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
    """Aggregated rows beside the quantiles of their group, which may be null."""
    if not group:
        return rows.crossJoin(F.broadcast(found))  # one row each
    renamed = found.withColumnsRenamed({k: f"__of_{k}" for k in group})
    return rows.join(renamed, same([(F.col(k), F.col(f"__of_{k}")) for k in group]), "left").drop(*(f"__of_{k}" for k in group))
