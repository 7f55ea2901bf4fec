"""Sliding windows, lag correlation and nearest-window assignment within clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import SEGMENT, around


def window_starts(frames: DataFrame, clip: str, width: int, stride: int) -> DataFrame:
    """(clip, window_id, start, stop): every ``stride`` frames, and one more that ends at the last frame if needed.

    ``frame_idx`` is 1-based and without holes; clips shorter than ``width`` have one short window.
    """
    n = frames.groupBy(clip).agg(F.max("frame_idx").alias("n"))
    last = F.greatest(F.col("n") - width, F.lit(0))
    starts = F.array_union(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(stride).cast("long")), F.array(last.cast("long")))
    placed = n.select(clip, "n", F.posexplode(F.array_sort(starts)).alias("window_id", "start"))
    return placed.select(clip, F.col("window_id").cast("long").alias("window_id"), "start", F.least(F.col("start") + width, F.col("n")).alias("stop"))


def window_frames(frames: DataFrame, clip: str, width: int, stride: int) -> DataFrame:
    """Frames with the windows they lie in (window_id, start, stop), which a frame finds by arithmetic: no join."""
    pos = F.col("frame_idx") - 1
    n = F.max("frame_idx").over(Window.partitionBy(clip)).cast("long")
    last = F.greatest(F.col("__n") - width, F.lit(0))
    regular = F.floor(last / stride)  # the last regular start's number
    low = F.greatest(F.lit(0), F.ceil((pos - width + 1) / stride)).cast("long")
    high = F.least(F.floor(pos / stride), regular).cast("long")
    none = F.array().cast("array<bigint>")
    numbers = F.when(high >= low, F.sequence(low, high)).otherwise(none)
    ending = F.when((last % stride != 0) & (pos >= last), F.array((regular + 1).cast("long"))).otherwise(none)
    placed = frames.withColumn("__n", n).withColumn("window_id", F.explode(F.concat(numbers, ending)))
    start = F.least(F.col("window_id") * stride, last).cast("long")
    return placed.withColumn("start", start).withColumn("stop", F.least(F.col("start") + width, F.col("__n"))).drop("__n")


def speech_windows(frames: DataFrame, clip: str, level: str, width: int, stride: int, voiced: float, share: float) -> DataFrame:
    inside = window_frames(frames, clip, width, stride)
    return inside.groupBy(clip, "window_id", "start", "stop").agg(F.avg((F.col(level) > voiced).cast("double")).alias("voiced")).withColumn("has_speech", F.col("voiced") >= share)


def best_lags(frames: DataFrame, clip: str, left: str, right: str, width: int, stride: int, most: int = 3) -> DataFrame:
    """(clip, window_id, lag, correlation): the lag of ``right`` with the highest Pearson correlation.

    A lag pairs left[i] with right[i + lag] inside the window. Flat series correlate 0. Ties go to the
    smaller absolute lag, then the smaller lag. Correlations are rounded to 9 places before ranking.

    A frame brings the values that each lag pairs it with; a window's co-moments come from one aggregation,
    which merges partial ones before the exchange and is stable where differences of running sums
    would lose a nearly flat window.
    """
    lags = range(-most, most + 1)
    name = lambda lag: f"__r{lag + most}"
    order = Window.partitionBy(clip).orderBy("frame_idx")
    led = frames.withColumns({name(lag): F.lead(right, lag).over(order).cast("double") for lag in lags})
    inside = window_frames(led.select(clip, "frame_idx", F.col(left).cast("double").alias("__l"), *map(name, lags)), clip, width, stride)
    moments = []
    for lag in lags:
        met = F.col("frame_idx") - 1 + lag
        paired = (met >= F.col("start")) & (met < F.col("stop"))
        x, y = F.when(paired, F.col("__l")), F.when(paired, F.col(name(lag)))
        moments.append(F.struct(F.covar_pop(x, y).alias("xy"), F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"), F.count(F.when(paired, 1)).alias("n")))
    sums = inside.groupBy(clip, "window_id", "start", "stop").agg(F.array(*moments).alias("moments"))

    def candidate(place: int, lag: int) -> Column:
        m = F.col("moments")[place]
        scale = F.sqrt(m["xx"] * m["n"]) * F.sqrt(m["yy"] * m["n"])
        correlation = F.round(F.when(scale > 1e-12, m["xy"] * m["n"] / scale).otherwise(0.0), 9)
        one = F.struct((-correlation).alias("falling"), F.lit(abs(lag)).alias("apart"), F.lit(lag).cast("long").alias("lag"), correlation.alias("correlation"))
        reach = F.least(F.lit(most), F.greatest(F.lit(0), F.col("stop") - F.col("start") - 2))
        return F.when(F.lit(abs(lag)) <= reach, one)

    best = F.array_min(F.array_compact(F.array(*(candidate(i, lag) for i, lag in enumerate(lags)))))
    return sums.withColumn("__best", best).select(clip, "window_id", "__best.lag", "__best.correlation")


def center(start: Column, stop: Column) -> Column:
    """The middle of the 0-based frames start..stop - 1."""
    return (start + stop - 1) / 2


def window_records(frames: DataFrame, clip: str, left: str, right: str, width: int, stride: int, voiced: float, share: float, least: float = 0.20, most: int = 3) -> DataFrame:
    """A row per window: its frames and centre, whether it has speech, its best lag and correlation, and the confidence in them."""
    speech = speech_windows(frames, clip, left, width, stride, voiced, share)
    lags = best_lags(frames, clip, left, right, width, stride, most)
    found = speech.join(lags, [clip, "window_id"])
    return found.withColumns({"center": center(F.col("start"), F.col("stop")), "confidence": F.when(F.col("correlation") >= least, "high").otherwise("low")})


def window_flags(has_speech: Column, confidence: Column) -> Column:
    """array<string> of the flags that a kept frame takes from its window."""
    return F.when(has_speech & (confidence == "low"), F.array(F.lit("low_sync_confidence"))).otherwise(F.array().cast("array<string>"))


def nearest_window(frames: DataFrame, clip: str, width: int, stride: int) -> DataFrame:
    """Frames with window_id, start and center of the window whose centre is nearest to frame_idx - 1; ties to the smaller id.

    Starts are regular but for the last, so three candidates by arithmetic do: the regular windows on
    either side, and the last one.
    """
    n = F.max("frame_idx").over(Window.partitionBy(clip))
    placed = frames.withColumn("__n", n)
    last = F.greatest(F.col("__n") - width, F.lit(0)).cast("long")
    regular = F.floor(last / stride)  # the last regular start's number
    middle = (F.least(F.col("__n"), F.lit(width)) - 1) / 2
    pos = F.col("frame_idx") - 1
    low = F.least(F.greatest(F.floor((pos - middle) / stride), F.lit(0)), regular)

    def candidate(number: Column, start: Column) -> Column:
        at = start + middle
        return F.struct(F.abs(at - pos).alias("gap"), number.cast("long").alias("window_id"), start.cast("long").alias("start"), at.alias("center"))

    high = F.least(low + 1, regular)
    ending = regular + (last % stride != 0).cast("long")
    nearest = F.array_min(F.array(candidate(low, low * stride), candidate(high, high * stride), candidate(ending, last)))
    return placed.withColumn("__w", nearest).select(*frames.columns, "__w.window_id", "__w.start", "__w.center")


def nearest_of(frames: DataFrame, windows: DataFrame, clip: str, at: str, center: str, number: str, segment: int = SEGMENT) -> DataFrame:
    """``frames`` with the ``number`` and ``center`` of the window of their clip whose centre is nearest to ``at``; ties to the smaller number.

    The windows are a table and may lie anywhere. Both sides are put into one order and scanned both ways: the
    nearest centre before a frame and the nearest behind it are the only candidates. Frames of a clip without
    windows get nulls. Windows without clip, centre or number are left out.
    """
    points = windows.where(F.col(center).isNotNull() & F.col(number).isNotNull()).groupBy(F.col(clip).alias("__c"), F.col(center).cast("double").alias("__x")).agg(F.min(number).alias("__id"))
    rows = frames.select(F.col(clip).alias("__c"), F.col(at).cast("double").alias("__x"), F.struct(*frames.columns).alias("__row"))
    both = around(rows.unionByName(points, allowMissingColumns=True).withColumn("__center", F.col("__x")), "__c", "__x", F.col("__id").isNotNull(), ["__id", "__center"], segment)
    side = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.__center") - F.col("__x")).alias("gap"), F.col(f"{c}.__id").alias("id"), F.col(f"{c}.__center").alias("center")))
    nearest = F.array_min(F.array_compact(F.array(side("__before"), side("__after"))))
    return both.where(F.col("__row").isNotNull()).withColumn("__w", nearest).select("__row.*", F.col("__w.id").alias(number), F.col("__w.center").alias(center))


def reject_reason(has_speech: Column, correlation: Column, lag: Column, least: float = 0.20, most: int = 2) -> Column:
    return F.when(has_speech & (correlation >= least) & (F.abs(lag) > most), "sync_lag")
