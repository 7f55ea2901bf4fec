"""Deterministic splits, samplers and selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import spread_index
from .scans import SEGMENT, around, numbered, same


def group_split(ids: DataFrame, group: str, column: str, salt: str, share: float) -> DataFrame:
    """Per group: its distinct ids; in order of sha256(group:salt:id), the last max(1, round(n * share)), but not all, are val.

    A group with fewer than two ids can't be split and gets a null. A group's ids are ranked in one task:
    they are its clips, not its frames.
    """
    w = Window.partitionBy(group)
    order = F.sha2(F.concat_ws(":", F.col(group).cast("string"), F.lit(salt), F.col(column).cast("string")), 256)
    placed_ = ids.select(group, column).distinct().withColumns({"__n": F.count("*").over(w), "__rank": F.row_number().over(w.orderBy(order))})
    val = F.least(F.col("__n") - 1, F.greatest(F.lit(1), F.rint(F.col("__n") * share)))
    return placed_.select(group, column, F.when(F.col("__n") >= 2, F.when(F.col("__rank") > F.col("__n") - val, "val").otherwise("train")).alias("split"))


def hash_split(ids: DataFrame, column: str, prefix: str, share: float) -> DataFrame:
    """Distinct ids; in order of sha256(prefix + id), the last max(1, round(n * share)) of them, but not all, are val.

    Ranks need counts before each id: the order is cut into 4,096 hash bins whose sizes are summed
    first, so that no task ranks more than a bin.
    """
    hashed = ids.select(column).distinct().withColumn("__hash", F.sha2(F.concat(F.lit(prefix), F.col(column).cast("string")), 256)).withColumn("__bin", F.substring("__hash", 1, 3))
    bins = hashed.groupBy("__bin").agg(F.count("*").alias("__in"))
    upto = bins.select("__bin", (F.sum("__in").over(Window.orderBy("__bin")) - F.col("__in")).alias("__before"))  # at most 4,096 rows
    total = bins.agg(F.sum("__in").alias("__n"))
    ranked = hashed.join(upto, "__bin").withColumn("__rank", F.col("__before") + F.row_number().over(Window.partitionBy("__bin").orderBy("__hash")))
    val = F.least(F.col("__n") - 1, F.greatest(F.lit(1), F.rint(F.col("__n") * share)))
    split = F.when(F.col("__rank") > F.col("__n") - val, "val").otherwise("train")
    return ranked.crossJoin(F.broadcast(total)).select(column, split.alias("split"))  # one row


def tail_split(index: Column, n: Column, share: float) -> Column:
    """By 0-based index: the last share of a clip is val, at least one frame stays train."""
    return F.when(index >= F.greatest(F.lit(1), F.floor(n * (1 - share))), "val").otherwise("train")


def position_split(df: DataFrame, clip: str, order: str, share: float) -> DataFrame:
    w = Window.partitionBy(clip)
    index = F.row_number().over(w.orderBy(order)) - 1
    keep = F.greatest(F.lit(1), F.rint(F.count("*").over(w) * (1 - share)))
    return df.withColumn("split", F.when(index >= keep, "val").otherwise("train"))


def list_split(clips: DataFrame, column: str, share: float) -> DataFrame:
    """The last max(1, round(n * share)) clips in order are val; none if there is at most one.

    The order is cut into ranges whose sizes are summed first, so that no task ranks more than one.
    """
    ranged = clips.repartitionByRange(column).withColumn("__range", F.spark_partition_id())
    inside = ranged.withColumn("__place", F.row_number().over(Window.partitionBy("__range").orderBy(column)))
    sizes = inside.groupBy("__range").agg(F.count("*").alias("__in"))
    upto = sizes.select("__range", (F.sum("__in").over(Window.orderBy("__range")) - F.col("__in")).alias("__before"))  # a row per range
    n = inside.agg(F.count("*").alias("__n"))
    val = F.when(F.col("__n") > 1, F.greatest(F.lit(1), F.rint(F.col("__n") * share))).otherwise(0)
    placed_ = inside.join(upto, "__range").crossJoin(F.broadcast(n))  # one row
    return placed_.select(*clips.columns, F.when(F.col("__place") + F.col("__before") > F.col("__n") - val, "val").otherwise("train").alias("split"))


def capped_silence(df: DataFrame, clip: str, order: str, silent: Column, share: float, segment: int = SEGMENT) -> DataFrame:
    """All voiced rows and the first silent ones, so that these are at most ``share`` of what stays; one if nothing is voiced.

    A row of which silence isn't known counts as voiced. Silent rows are numbered by segments, and a row per clip says how many of them stay.
    """
    marked = df.withColumn("__silent", F.coalesce(silent, F.lit(False)))
    voiced = F.count_if(~F.col("__silent"))
    cap = F.when(voiced == 0, F.lit(1)).otherwise(F.floor(voiced * F.lit(share) / (F.lit(1.0) - F.lit(share))))
    caps = marked.groupBy(F.col(clip).alias("__clip")).agg(cap.alias("__cap"))
    quiet = numbered(marked.where("__silent"), clip, clip, order, "__place", segment)
    quiet = quiet.join(caps, same([(F.col(clip), F.col("__clip"))])).where(F.col("__place") <= F.col("__cap")).drop("__clip", "__cap", "__place")
    return marked.where(~F.col("__silent")).unionByName(quiet).drop("__silent")


def nearest_distance(df: DataFrame, clip: str, order: str, of: Column, out: str = "distance", segment: int = SEGMENT) -> DataFrame:
    """Index distance to the nearest row of the clip where ``of`` holds, by scans both ways."""
    near = around(df.withColumn("__at", F.col(order)), clip, order, of, ["__at"], segment)
    return near.withColumn(out, F.least(F.col(order) - F.col("__before.__at"), F.col("__after.__at") - F.col(order))).drop("__at", "__pos", "__before", "__after")


def is_spread(place: Column, size: Column, picks: Column) -> Column:
    """Whether the 0-based ``place`` is one of ``picks`` evenly spread picks among ``size``.

    The pick that could be there is found by one division; its neighbours are tried for rounding.
    """
    guess = F.floor(place / ((size - 1) / (picks - 1)))
    met = F.lit(False)
    for k in (guess - 1, guess, guess + 1):
        met = met | ((k >= 0) & (k < picks) & (spread_index(k, size, picks) == place))
    return F.when(picks <= 1, place == 0).otherwise(F.coalesce(met, F.lit(False)))


def idle_sample(df: DataFrame, clip: str, order: str, idle: Column, ratio: float, segment: int = SEGMENT) -> DataFrame:
    """Of a clip's idle rows floor(speech * ratio): the four times as many that are nearest to speech, evenly thinned."""
    w = Window.partitionBy(clip)
    near = nearest_distance(df.withColumn("__idle", idle), clip, order, ~F.col("__idle"), "__gap", segment)
    speech = df.groupBy(F.col(clip).alias("__clip")).agg(F.floor(F.count_if(~idle) * ratio).alias("__limit")).where("__limit > 0")
    near = near.where("__idle").join(speech, same([(F.col(clip), F.col("__clip"))])).drop("__clip")
    ranked = near.withColumn("__rank", F.row_number().over(w.orderBy("__gap", order))).where(F.col("__rank") <= 4 * F.col("__limit"))
    placed = ranked.withColumns({"__k": (F.row_number().over(w.orderBy(order)) - 1).cast("long"), "__m": F.count("*").over(w)})
    return placed.where(is_spread(F.col("__k"), F.col("__m"), F.least("__m", "__limit"))).drop("__idle", "__gap", "__limit", "__rank", "__k", "__m")


def spread_picks(df: DataFrame, clip: str, order: str, picks: int, segment: int = SEGMENT) -> DataFrame:
    """``picks`` evenly spread rows of each clip (all, if there are fewer)."""
    sizes = df.groupBy(F.col(clip).alias("__of")).agg(F.count("*").alias("__m"))
    placed = numbered(df, clip, clip, order, "__k", segment).join(sizes, same([(F.col(clip), F.col("__of"))])).drop("__of")
    return placed.where(is_spread(F.col("__k") - 1, F.col("__m"), F.least(F.col("__m"), F.lit(picks)))).drop("__k", "__m")


def first_groups(df: DataFrame, group: str, order: str, groups: int, rows: int, pinned: Sequence[str] = ()) -> DataFrame:
    """The first ``rows`` rows of the ``groups`` groups that appear first, or of the ``pinned`` groups, each of which has to exist."""
    if rows <= 0 or groups <= 0 and not pinned:
        raise ValueError("rows, and groups where none are pinned, have to be positive")
    if pinned:
        first = df.where(F.col(group).isin(*pinned)).groupBy(group).agg(F.min(order).alias("__first"))
        missing = sorted(set(pinned) - {r[group] for r in first.collect()})  # of the pinned groups
        if missing:
            raise ValueError(f"no rows for pinned groups {missing}")
    else:
        first = df.groupBy(group).agg(F.min(order).alias("__first")).orderBy("__first").limit(groups)
    w = Window.partitionBy(group).orderBy(order)
    return df.join(F.broadcast(first), group).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= rows).drop("__n", "__first")


def epoch_order(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """A reproducible permutation key per epoch; sort by it and skip what was done to resume."""
    return df.withColumn("epoch_key", F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), F.col(key).cast("string"))))


def placed(df: DataFrame, hashed: str, key: str, out: str) -> DataFrame:
    """1-based place of every row in order of a hexadecimal hash: ranks within 4,096 bins after a count per bin, as in hash_split."""
    binned = df.withColumn("__bin", F.substring(hashed, 1, 3))
    bins = binned.groupBy("__bin").agg(F.count("*").alias("__in"))
    upto = bins.select("__bin", (F.sum("__in").over(Window.orderBy("__bin")) - F.col("__in")).alias("__before"))  # at most 4,096 rows
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__bin").orderBy(hashed, key))
    return binned.join(upto, "__bin").withColumn(out, place.cast("long")).drop("__bin", "__before")


def top_by(df: DataFrame, group: list[str], keys: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*keys)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def log_rows(df: DataFrame, step: str, last: int, interval: int, always: Sequence[str] = ()) -> DataFrame:
    """Rows that a log shows: the first step, the last, multiples of ``interval``, and those with a value in one of ``always``; none if ``interval`` is 0."""
    if interval <= 0:
        return df.limit(0)
    shown = F.col(step).isin(1, last) | (F.col(step) % interval == 0)
    for c in always:
        shown = shown | F.col(c).isNotNull()
    return df.where(shown)
