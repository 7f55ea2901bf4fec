"""Metric roll-ups, audits and searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite, psnr
from .quantiles import quantiles, with_quantiles
from .scans import same


def pooled_errors(df: DataFrame, group: list[str], mae: str, rmse: str, most: str, ssim: str | None = None) -> DataFrame:
    """Per group: mean absolute error, root of the mean squared rmse, its PSNR, greatest difference, mean SSIM."""
    pooled = F.sqrt(F.avg(F.col(rmse) * F.col(rmse)))
    aggs = [F.avg(mae).alias("mae"), pooled.alias("rmse"), F.max(most).alias("max_abs"), psnr(pooled).alias("psnr"), *([F.avg(ssim).alias("ssim")] if ssim else [])]
    return df.groupBy(*group).agg(*aggs)


def distributions(df: DataFrame, group: list[str], x: Column) -> DataFrame:
    """Per group, over finite values: count, min, max, mean, population deviation, exact linear p50 and p90."""
    v = finite(x)
    rows = df.groupBy(*group).agg(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    both = with_quantiles(rows, quantiles(df, group, {"__q": v}, [0.5, 0.9]), group)
    return both.withColumns({"p50": F.get("__q", F.lit(0)), "p90": F.get("__q", F.lit(1))}).drop("__q")


def summaries(df: DataFrame, group: list[str], x: Column) -> DataFrame:
    """Per group: count, mean, min, exact linear p05, p50 and p95, max."""
    rows = df.groupBy(*group).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"))
    both = with_quantiles(rows, quantiles(df, group, {"__q": x}, [0.05, 0.5, 0.95]), group)
    return both.select(*group, "count", "mean", "min", *(F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(("p05", "p50", "p95"))), "max")


def bucket_stats(df: DataFrame, group: list[str], by: str, values: list[str]) -> DataFrame:
    """Quartile buckets of ``by`` per group (the last one closed): count, bounds, mean and deviation of ``values``.

    Bounds are exact quantiles, one row per group, joined back; empty buckets have no row.
    """
    bounds = quantiles(df, group, {"__q": F.col(by)}, [0.0, 0.25, 0.5, 0.75, 1.0]).withColumnsRenamed({k: f"__of_{k}" for k in group})
    q = [F.get("__q", F.lit(i)) for i in range(5)]
    bucket = F.when(F.col(by) < q[1], 0).when(F.col(by) < q[2], 1).when(F.col(by) < q[3], 2).otherwise(3)
    marked = df.join(bounds, same([(F.col(k), F.col(f"__of_{k}")) for k in group])).withColumn("bucket", bucket.cast("long"))
    low, high = F.first(F.get("__q", F.col("bucket").cast("int"))), F.first(F.get("__q", F.col("bucket").cast("int") + 1))
    stats = [x for v in values for x in (F.avg(v).alias(f"{v}_mean"), F.stddev_pop(v).alias(f"{v}_std"))]
    return marked.groupBy(*group, "bucket").agg(F.count("*").alias("count"), low.alias("low"), high.alias("high"), *stats)


def batch_then_mean(df: DataFrame, order: str, size: int, by_batch: list[str], by_sample: list[str]) -> DataFrame:
    """Means of batch means for some columns and of samples for others; ``order`` is a 0-based sample number."""
    batches = df.groupBy(F.floor(F.col(order) / size).alias("__batch")).agg(
        *(F.avg(c).alias(c) for c in by_batch), *(F.sum(c).alias(f"__sum_{c}") for c in by_sample), F.count("*").alias("__n")
    )
    return batches.agg(*(F.avg(c).alias(c) for c in by_batch), *((F.sum(f"__sum_{c}") / F.sum("__n")).alias(c) for c in by_sample))


def common_reasons(df: DataFrame, reason: str, order: str, k: int, group: list[str] | None = None) -> DataFrame:
    """The k most frequent reasons; ties go to the one that occurs first."""
    counts = df.groupBy(*(group or []), reason).agg(F.count("*").alias("count"), F.min(order).alias("first_at"))
    if not group:
        return counts.orderBy(F.desc("count"), "first_at").limit(k)
    w = Window.partitionBy(*group).orderBy(F.desc("count"), "first_at")
    return counts.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def reason_examples(df: DataFrame, reason: str, order: str, reasons: int, examples: int) -> DataFrame:
    """The first ``examples`` rows, with their ``place``, of each of the ``reasons`` most frequent reasons (ties: the one that occurs first)."""
    top = common_reasons(df.where(F.col(reason).isNotNull()), reason, order, reasons)
    w = Window.partitionBy(reason).orderBy(order)
    # of a reason no more than ``examples`` rows leave a task
    return df.join(F.broadcast(top.select(reason)), reason).withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= examples).select(*df.columns, "place")


#: The gates of a parity report: name, measure, comparison, threshold (fixed values). Deltas are absolute differences.
PARITY_GATES = (
    ("frame_count_equal", "frame_count_delta", "<=", 0.0),
    ("fps_equal", "fps_delta", "<=", 0.0),
    ("audio_duration_delta_lte_20ms", "audio_duration_delta_seconds", "<=", 0.020),
    ("bbox_iou_gte_0_995_for_95pct_frames", "bbox_iou_pass_fraction_at_0_995", ">=", 0.95),
    ("bbox_center_drift_lte_1px_for_95pct_frames", "bbox_center_pass_fraction_at_1px", ">=", 0.95),
    ("decoded_full_frame_ssim_gte_0_999", "full_frame_ssim", ">=", 0.999),
    ("decoded_full_frame_mae_lte_1", "full_frame_mae", "<=", 1.0),
    ("decoded_roi_ssim_gte_0_995", "roi_ssim", ">=", 0.995),
    ("decoded_roi_mae_lte_2", "roi_mae", "<=", 2.0),
    ("decoded_mouth_ssim_gte_0_995", "mouth_ssim", ">=", 0.995),
    ("decoded_mouth_mae_lte_2", "mouth_mae", "<=", 2.0),
)


def parity_gates(measured: DataFrame) -> DataFrame:
    """gate_report of a one-row frame for all of PARITY_GATES; a measure that is null doesn't pass."""
    return gate_report(measured, list(PARITY_GATES))


def gate_report(metrics: DataFrame, gates: list[tuple[str, str, str, float]]) -> DataFrame:
    """A row per gate (name, column, '>=' or '<=', threshold) of a one-row frame: value and whether it holds."""
    rows = F.array(*(
        F.struct(F.lit(n).alias("gate"), F.col(c).cast("double").alias("value"), F.lit(float(t)).alias("threshold"), F.coalesce(F.col(c) >= t if op == ">=" else F.col(c) <= t, F.lit(False)).alias("passed"))
        for n, c, op, t in gates
    ))
    return metrics.select(F.inline(rows))


def audit_status(checks: DataFrame, status: str = "status") -> DataFrame:
    """The worst of failed, blocked, met over all checks."""
    worst = F.max(F.when(F.col(status) == "failed", 2).when(F.col(status) == "blocked", 1).otherwise(0))
    return checks.agg(F.when(worst == 2, "failed").when(worst == 1, "blocked").otherwise("target_met").alias("status"), F.count("*").alias("checks"), F.count_if(F.col(status) == "failed").alias("failed"))


def proposals(df: DataFrame, keys: list[str], stride: int, scores: str = "scores", offsets: str = "offsets", least: float = 0.3) -> DataFrame:
    """A detector head's proposals: (keys, box_id, x1, y1, x2, y2, score) of every cell that scores ``least`` or more, for ``suppressed``.

    ``scores`` is array<array<array>> by anchor, row and column; ``offsets`` has four such planes per anchor: the distances of
    the left, upper, right and lower side from the cell's corner, in strides. Boxes are a pixel wider and higher than the sides say. Cells
    without a score have no proposal; box_id counts anchors, rows and columns in that order.
    """
    flat = lambda c: F.flatten(F.flatten(c))
    planes = df.select(*keys, flat(scores).alias("__scores"), flat(offsets).alias("__offsets"), F.size(F.get(scores, F.lit(0))).alias("__rows"), F.size(F.get(F.get(scores, F.lit(0)), F.lit(0))).alias("__columns"))
    plane = F.col("__rows") * F.col("__columns")

    def proposal(cell: Column) -> Column:
        anchor, place = F.floor(cell["i"] / plane).cast("int"), cell["i"] % plane
        left, up, right, down = (F.get("__offsets", (anchor * 4 + k) * plane + place).cast("double") * stride for k in range(4))
        x, y = (place % F.col("__columns")) * stride, F.floor(place / F.col("__columns")) * stride
        sides = {"x1": x - left, "y1": y - up, "x2": x + right + 1.0, "y2": y + down + 1.0, "score": cell["score"]}
        return F.struct(cell["i"].cast("long").alias("box_id"), *(v.alias(c) for c, v in sides.items()))

    cells = F.transform("__scores", lambda s, i: F.struct(i.alias("i"), s.cast("double").alias("score")))
    return planes.select(*keys, F.inline(F.transform(F.filter(cells, lambda c: c["score"] >= least), proposal)))


def suppressed(df: DataFrame, group: list[str], score: str, overlap: float = 0.45) -> DataFrame:
    """Greedy non-maximum suppression among one frame's boxes (``group``): by falling score, keep a box that overlaps no kept one by more."""

    side = lambda b, c: b[c].cast("double")
    area = lambda b: (side(b, "x2") - side(b, "x1")) * (side(b, "y2") - side(b, "y1"))
    along = lambda a, b, low, high: F.greatest(F.lit(0.0), F.least(side(a, high), side(b, high)) - F.greatest(side(a, low), side(b, low)))

    def hides(kept: Column, b: Column) -> Column:
        both = along(kept, b, "x1", "x2") * along(kept, b, "y1", "y2")
        either = area(kept) + area(b) - both
        share = both / F.when(either.isNotNull(), F.greatest(either, F.lit(1e-12)))
        return (share > overlap) & ~F.isnan(share)

    # by falling score, those without one last
    order = F.struct(F.coalesce(-F.col(score).cast("double"), F.lit(float("nan"))), F.col("box_id").isNull(), "box_id", F.struct(*df.columns).alias("box"))
    boxes = F.transform(F.array_sort(F.collect_list(order)), lambda o: o["box"])
    add = lambda kept, b: F.when(F.exists(kept, lambda k: hides(k, b)), kept).otherwise(F.concat(kept, F.array(b)))
    found = df.groupBy(*group).agg(boxes.alias("__boxes"))
    return found.select(F.inline(F.aggregate("__boxes", F.slice("__boxes", 1, 0), add)))


def largest(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """The box of greatest area per group; ties to the smaller box_id."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return df.groupBy(group).agg(F.max_by(F.struct(*columns), F.struct(area, -F.col("box_id"))).alias("__b")).select(group, "__b.*")


def cache_map(outcomes: DataFrame, stage: str = "stage", hit: str = "hit") -> DataFrame:
    """One row with map<stage, struct<hits, misses>> of outcomes (clip, stage, hit); a stage that a clip lacks counts nowhere."""
    each = outcomes.groupBy(stage).agg(F.count_if(hit).alias("hits"), F.count_if(~F.col(hit)).alias("misses"))
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(stage, F.struct("hits", "misses"))))).alias("cache"))  # a row per stage
