"""Distributions, pooled errors, reports and audits over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, numeric, vectors
from ..operators import metrics
from ..operators.quantiles import quantiles, with_quantiles
from .standins import BOXES, FRAMES, HEIGHT, WIDTH, boxes, frames, table


def _rounded(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes))


def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type; the 3 largest values count as infinite and are left out."""
    v = F.when(F.col("value") > 350, float("inf")).otherwise(F.col("value"))
    return _rounded(metrics.distributions(frames(spark, sf_dir), ["event_type"], v))


def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.summaries(frames(spark, sf_dir), ["event_type"], F.col("value")))


def quartile_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("event_type", "value", F.col("k").cast("double").alias("k"))
    return _rounded(metrics.bucket_stats(f, ["event_type"], "value", ["k"]))


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    reason = F.when(F.col("x1").isNull(), "missing").otherwise(F.coalesce(geometry.quality_reason(geometry.box(), F.lit(WIDTH), F.lit(HEIGHT)), F.lit("ok")))
    return b.groupBy(reason.alias("reason")).agg(F.count("*").alias("count"))


def clip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under conditions and a distribution per clip."""
    f = frames(spark, sf_dir)
    rows = f.groupBy("clip_id").agg(
        F.count("*").alias("frames"), F.count_if(F.col("event_type") != "error").alias("valid"), F.count_if(F.col("event_type") == "error").alias("rejected"),
        F.count_if((F.col("event_type") == "view") & (F.col("value") < 20)).alias("low_views"), F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("click_mean"),
        F.stddev_pop("k").alias("k_std"), F.when(F.count_if(F.col("event_type") == "purchase") > 0, "ready").otherwise("no_valid_samples").alias("status"),
    )
    both = with_quantiles(rows, quantiles(f, ["clip_id"], {"valid_p90": F.when(F.col("event_type") != "error", F.col("value"))}, [0.9]), ["clip_id"])
    return _rounded(both.withColumn("valid_p90", F.get("valid_p90", F.lit(0))))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).withColumn("split", F.when(F.col("clip_id") % 5 == 0, "val").otherwise("train"))
    return f.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("clip_id").alias("clips"))


def drop_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-clip drop counters summed by reason."""
    per_clip = frames(spark, sf_dir).where("event_type in ('error', 'view')").groupBy("clip_id", "event_type").agg(F.count("*").alias("n"))
    return per_clip.groupBy(F.col("event_type").alias("reason")).agg(F.sum("n").alias("count"), F.count("*").alias("clips"))


def stage_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits, misses and seconds by stage; a stage that a clip lacks counts nowhere."""
    f = frames(spark, sf_dir).where("event_type <> 'signup'")
    hit = F.col("k") < 50
    return f.groupBy(F.col("event_type").alias("stage")).agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses"), F.round(F.sum("value"), 4).alias("seconds"))


def pooled_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").withColumn("e", F.abs(F.col("l_discount") - F.col("l_tax")))  # noqa: E741
    return _rounded(metrics.pooled_errors(l, ["l_returnflag"], "e", "e", "e"))


def validation_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses as means of batch means (the last batch is short), metrics as means of samples."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("loss"), F.col("o_custkey").cast("double").alias("mae"))
    return _rounded(metrics.batch_then_mean(o, "o_orderkey", 64, ["loss"], ["mae"]))


def weighted_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return _rounded(l.groupBy("l_returnflag").agg(numeric.weighted_mean(F.col("l_extendedprice"), F.col("l_discount")).alias("weighted"), F.count("*").alias("count")))


def _box_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each box beside a shifted copy."""
    b = boxes(spark, sf_dir).where("x1 is not null and x2 > x1 and y2 > y1")
    moved = {f"{c}_b": F.col(c) + F.pmod(F.col("event_id"), F.lit(7)) for c in ("x1", "y1", "x2", "y2")}
    p = b.withColumns(moved)
    a, o = geometry.box(), geometry.box("x1_b", "y1_b", "x2_b", "y2_b")
    edges = sum((F.abs(F.col(c) - F.col(f"{c}_b")) for c in ("x1", "y1", "x2", "y2")), F.lit(0)) / 4
    return p.withColumns({"iou": geometry.iou(a, o), "drift": geometry.center_drift(a, o), "edge": edges})


def box_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _box_pairs(spark, sf_dir)
    rows = p.groupBy("event_type").agg(
        F.avg("iou").alias("iou_mean"), F.avg((F.col("iou") >= 0.9).cast("double")).alias("iou_pass"), F.avg("drift").alias("drift_mean"), F.avg((F.col("drift") <= 5).cast("double")).alias("drift_pass"),
        F.avg("edge").alias("edge_mae"),
    )
    both = with_quantiles(rows, quantiles(p, ["event_type"], {"iou_p95": F.col("iou"), "drift_p95": F.col("drift")}, [0.95]), ["event_type"])
    return _rounded(both.withColumns({c: F.get(c, F.lit(0)) for c in ("iou_p95", "drift_p95")}))


def geometry_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass fraction, whether all pass, and the distinct frame sizes seen."""
    p = _box_pairs(spark, sf_dir)
    return p.groupBy("clip_id").agg(F.round(F.avg((F.col("iou") >= 0.8).cast("double")), 6).alias("passed"), F.bool_and(F.col("iou") > 0).alias("all_overlap"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _box_pairs(spark, sf_dir)
    means = p.agg(F.round(F.avg("iou"), 6).alias("iou"), F.round(F.avg("drift"), 6).alias("drift"))
    one = with_quantiles(means, quantiles(p, [], {"low": F.col("iou")}, [0.05]), []).withColumn("iou_low", F.round(F.get("low", F.lit(0)), 6))
    return metrics.gate_report(one, [("iou_mean", "iou", ">=", 0.8), ("drift_mean", "drift", "<=", 1.0), ("iou_p05", "iou_low", ">=", 0.5)])


def parity_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven gates: boxes beside their shifted copies, and values of an event type as the errors of a part of the picture."""
    f, p = frames(spark, sf_dir), _box_pairs(spark, sf_dir)
    of = lambda kind: F.avg(F.when(F.col("event_type") == kind, F.col("value")))
    errors = {"full_frame": of("view"), "roi": of("click"), "mouth": of("purchase")}
    one = f.agg(
        F.abs(F.count("*") - F.count_distinct("event_id")).alias("frame_count_delta"), (F.max("frame_idx") - F.max("frame_idx")).alias("fps_delta"), F.round(F.avg("k") / 1000, 6).alias("audio_duration_delta_seconds"),
        *(F.round(1 - v / 10000, 6).alias(f"{n}_ssim") for n, v in errors.items()), *(F.round(v / 20, 6).alias(f"{n}_mae") for n, v in errors.items()),
    )
    boxed = p.agg(F.round(F.avg((F.col("iou") >= 0.995).cast("double")), 6).alias("bbox_iou_pass_fraction_at_0_995"), F.round(F.avg((F.col("drift") <= 1).cast("double")), 6).alias("bbox_center_pass_fraction_at_1px"))
    return metrics.parity_gates(one.crossJoin(F.broadcast(boxed)))  # one row each


def reason_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three frames of each of the two most frequent kinds of event."""
    return metrics.reason_examples(frames(spark, sf_dir).select("event_type", "event_id", "clip_id"), "event_type", "event_id", 2, 3)


def cache_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and misses of all stages as one map."""
    f = frames(spark, sf_dir).where("event_type <> 'signup'").select("clip_id", F.col("event_type").alias("stage"), (F.col("k") < 50).alias("hit"))
    return metrics.cache_map(f).select(F.to_json("cache").alias("cache"))


def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "P", "blocked").when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 1000 == 1), "failed").otherwise("met").alias("status"))
    return metrics.audit_status(o)


def array_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    stats = vectors.array_stats(F.col("embedding"))
    return _rounded(e.select("vec_id", *(v.alias(k) for k, v in stats.items())))


def array_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between an embedding and itself reversed."""
    e = table(spark, sf_dir, "embeddings")
    found = vectors.array_errors(F.col("embedding"), F.reverse("embedding"))
    return _rounded(e.select("vec_id", *(v.alias(k) for k, v in found.items())))


def unit_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each embedding with its label's first one, after normalising both."""
    e = table(spark, sf_dir, "embeddings").withColumn("u", vectors.unit(F.transform("embedding", lambda x: x * 3)))
    first = e.groupBy("label").agg(F.min_by("u", "vec_id").alias("f"))
    return _rounded(e.join(first, "label").select("vec_id", vectors.dot(F.col("u"), F.col("f")).alias("cosine")))


QUERIES = {f.__name__: f for f in (
    distribution, metric_summary, quartile_buckets, reason_counts, clip_report, split_counts, drop_counters, stage_cache, pooled_errors, validation_means, weighted_loss,
    box_metrics, geometry_report, gate_report, parity_gates, reason_examples, cache_map, audit_status, array_reports, array_errors, unit_cosine,
)}

_PAIRS = f"""{BOXES}, q AS (SELECT *, event_id % 7 AS s FROM boxes WHERE x1 IS NOT NULL AND x2 > x1 AND y2 > y1), i AS (SELECT *, greatest(0, x2 - x1 - s) * greatest(0, y2 - y1 - s) AS shared, sqrt(2 * s * s) AS drift FROM q),
p AS (SELECT *, CASE WHEN 2 * (x2 - x1) * (y2 - y1) - shared > 0 THEN shared / (2 * (x2 - x1) * (y2 - y1) - shared)::DOUBLE ELSE 0 END AS iou FROM i)"""

ORACLE_SQL = {
    "distribution": f"WITH {FRAMES} SELECT event_type, count(*) AS count, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM frames WHERE value <= 350 GROUP BY 1",
    "metric_summary": f"WITH {FRAMES} SELECT event_type, count(*) AS count, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(max(value), 6) AS max FROM frames GROUP BY 1",
    "quartile_buckets": f"WITH {FRAMES}, q AS (SELECT event_type, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM frames GROUP BY 1), b AS (SELECT event_type, value, k, q, CASE WHEN value < q[2] THEN 0 WHEN value < q[3] THEN 1 WHEN value < q[4] THEN 2 ELSE 3 END AS bucket FROM frames JOIN q USING (event_type)) SELECT event_type, bucket::BIGINT AS bucket, count(*) AS count, round(any_value(q[bucket + 1]), 6) AS low, round(any_value(q[bucket + 2]), 6) AS high, round(avg(k), 6) AS k_mean, round(stddev_pop(k), 6) AS k_std FROM b GROUP BY 1, 2",
    "reason_counts": f"WITH {BOXES} SELECT CASE WHEN x1 IS NULL THEN 'missing' WHEN x2 - x1 <= 0 OR y2 - y1 <= 0 THEN 'invalid' WHEN x1 < 0 OR y1 < 0 OR x2 > {WIDTH} OR y2 > {HEIGHT} THEN 'outside_frame' WHEN x2 - x1 < 32 OR y2 - y1 < 32 THEN 'too_small' WHEN x2 - x1 > {WIDTH} * 0.9 OR y2 - y1 > {HEIGHT} * 0.9 THEN 'too_large' ELSE 'ok' END AS reason, count(*) AS count FROM boxes GROUP BY 1",
    "clip_report": f"WITH {FRAMES} SELECT clip_id, count(*) AS frames, count(*) FILTER (event_type <> 'error') AS valid, count(*) FILTER (event_type = 'error') AS rejected, count(*) FILTER (event_type = 'view' AND value < 20) AS low_views, round(avg(value) FILTER (event_type = 'click'), 6) AS click_mean, round(quantile_cont(value, 0.9) FILTER (event_type <> 'error'), 6) AS valid_p90, round(stddev_pop(k), 6) AS k_std, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'ready' ELSE 'no_valid_samples' END AS status FROM frames GROUP BY 1",
    "split_counts": f"WITH {FRAMES} SELECT CASE WHEN clip_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS rows, count(DISTINCT clip_id) AS clips FROM frames GROUP BY 1",
    "drop_counters": f"WITH {FRAMES} SELECT event_type AS reason, count(*) AS count, count(DISTINCT clip_id) AS clips FROM frames WHERE event_type IN ('error', 'view') GROUP BY 1",
    "stage_cache": f"WITH {FRAMES} SELECT event_type AS stage, count(*) FILTER (k < 50) AS hits, count(*) FILTER (k >= 50) AS misses, round(sum(value), 4) AS seconds FROM frames WHERE event_type <> 'signup' GROUP BY 1",
    "pooled_errors": "WITH e AS (SELECT l_returnflag, abs(l_discount - l_tax) AS e FROM lineitem) SELECT l_returnflag, round(avg(e), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(max(e), 6) AS max_abs, round(20 * log10(255 / sqrt(avg(e * e))), 6) AS psnr FROM e GROUP BY 1",
    "validation_means": "WITH b AS (SELECT o_orderkey // 64 AS b, avg(o_totalprice) AS loss FROM orders GROUP BY 1) SELECT round((SELECT avg(loss) FROM b), 6) AS loss, round((SELECT avg(o_custkey) FROM orders), 6) AS mae",
    "weighted_loss": "SELECT l_returnflag, round(sum(l_extendedprice * l_discount) / sum(l_discount), 6) AS weighted, count(*) AS count FROM lineitem GROUP BY 1",
    "box_metrics": f"WITH {_PAIRS} SELECT event_type, round(avg(iou), 6) AS iou_mean, round(quantile_cont(iou, 0.95), 6) AS iou_p95, round(avg((iou >= 0.9)::INT), 6) AS iou_pass, round(avg(drift), 6) AS drift_mean, round(quantile_cont(drift, 0.95), 6) AS drift_p95, round(avg((drift <= 5)::INT), 6) AS drift_pass, round(avg(s), 6) AS edge_mae FROM p GROUP BY 1",
    "geometry_report": f"WITH {_PAIRS} SELECT clip_id, round(avg((iou >= 0.8)::INT), 6) AS passed, bool_and(iou > 0) AS all_overlap, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM p GROUP BY 1",
    "gate_report": f"WITH {_PAIRS}, m AS (SELECT round(avg(iou), 6) AS a, round(avg(drift), 6) AS b, round(quantile_cont(iou, 0.05), 6) AS c FROM p) SELECT 'iou_mean' AS gate, a AS value, 0.8::DOUBLE AS threshold, a >= 0.8 AS passed FROM m UNION ALL SELECT 'drift_mean', b, 1.0::DOUBLE, b <= 1.0 FROM m UNION ALL SELECT 'iou_p05', c, 0.5::DOUBLE, c >= 0.5 FROM m",
    "parity_gates": f"""WITH {_PAIRS}, v AS (SELECT abs(count(*) - count(DISTINCT event_id)) AS frames, round(avg(k) / 1000, 6) AS audio, avg(value) FILTER (event_type = 'view') AS a, avg(value) FILTER (event_type = 'click') AS b, avg(value) FILTER (event_type = 'purchase') AS c FROM frames),
      q2 AS (SELECT round(avg((iou >= 0.995)::INT), 6) AS i, round(avg((drift <= 1)::INT), 6) AS d FROM p),
      g(gate, value, op, threshold) AS (
        SELECT 'frame_count_equal', frames::DOUBLE, -1, 0.0::DOUBLE FROM v UNION ALL SELECT 'fps_equal', 0, -1, 0 UNION ALL SELECT 'audio_duration_delta_lte_20ms', audio, -1, 0.02 FROM v
        UNION ALL SELECT 'bbox_iou_gte_0_995_for_95pct_frames', i, 1, 0.95 FROM q2 UNION ALL SELECT 'bbox_center_drift_lte_1px_for_95pct_frames', d, 1, 0.95 FROM q2
        UNION ALL SELECT 'decoded_full_frame_ssim_gte_0_999', round(1 - a / 10000, 6), 1, 0.999 FROM v UNION ALL SELECT 'decoded_full_frame_mae_lte_1', round(a / 20, 6), -1, 1 FROM v
        UNION ALL SELECT 'decoded_roi_ssim_gte_0_995', round(1 - b / 10000, 6), 1, 0.995 FROM v UNION ALL SELECT 'decoded_roi_mae_lte_2', round(b / 20, 6), -1, 2 FROM v
        UNION ALL SELECT 'decoded_mouth_ssim_gte_0_995', round(1 - c / 10000, 6), 1, 0.995 FROM v UNION ALL SELECT 'decoded_mouth_mae_lte_2', round(c / 20, 6), -1, 2 FROM v)
      SELECT gate, value, threshold, CASE WHEN op = 1 THEN value >= threshold ELSE value <= threshold END AS passed FROM g""",
    "reason_examples": f"WITH {FRAMES}, t AS (SELECT event_type FROM frames GROUP BY 1 ORDER BY count(*) DESC, min(event_id) LIMIT 2) SELECT event_type, event_id, clip_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM frames JOIN t USING (event_type) QUALIFY place <= 3",
    "cache_map": f"WITH {FRAMES}, s AS (SELECT event_type AS stage, count(*) FILTER (k < 50) AS h, count(*) FILTER (k >= 50) AS m FROM frames WHERE event_type <> 'signup' GROUP BY 1) SELECT '{{' || string_agg('\"' || stage || '\":{{\"hits\":' || h || ',\"misses\":' || m || '}}', ',' ORDER BY stage) || '}}' AS cache FROM s",
    "audit_status": "SELECT CASE WHEN bool_or(o_orderstatus = 'F' AND o_orderkey % 1000 = 1) THEN 'failed' WHEN bool_or(o_orderstatus = 'P') THEN 'blocked' ELSE 'target_met' END AS status, count(*) AS checks, count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 1000 = 1) AS failed FROM orders",
    "array_reports": "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) SELECT vec_id, len(e)::BIGINT AS size, round(list_min(e), 6) AS min, round(list_max(e), 6) AS max, round(list_avg(e), 6) AS mean, round(list_stddev_pop(e), 6) AS std FROM e",
    "array_errors": "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), u AS (SELECT vec_id, unnest(e) AS a, unnest(list_reverse(e)) AS b FROM e) SELECT vec_id, round(avg(abs(a - b)), 6) AS mae, round(sqrt(avg((a - b)^2)), 6) AS rmse, round(max(abs(a - b)), 6) AS max_abs, max(abs(a - b)) = 0 AS equal FROM u GROUP BY 1",
    "unit_cosine": "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), f AS (SELECT label, arg_min(e, vec_id) AS f FROM e GROUP BY 1) SELECT vec_id, round(list_dot_product(e, f) / sqrt(list_dot_product(e, e)) / sqrt(list_dot_product(f, f)), 6) AS cosine FROM e JOIN f USING (label)",
}
