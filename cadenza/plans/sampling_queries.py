"""Splits, samplers, rankings and searches over the stand-in tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import pair_id
from ..operators import metrics, sampling, scans, search
from . import snapshot
from .pairing_queries import PAIR_SQL, pair_decisions
from .standins import BOXES, FRAMES, boxes, frames, table


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_split(frames(spark, sf_dir), "clip_id", "p0:salt:", 0.2)


def tail_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("clip_id")
    f = frames(spark, sf_dir).withColumn("n", F.count("*").over(w))
    return f.groupBy("clip_id", sampling.tail_split(F.col("frame_idx") - 1, F.col("n"), 0.15).alias("split")).agg(F.count("*").alias("count"))


def position_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).where("event_type <> 'error'").select("clip_id", "frame_idx")
    return sampling.position_split(f, "clip_id", "frame_idx", 0.2).groupBy("clip_id", "split").agg(F.count("*").alias("count"), F.min("frame_idx").alias("first"))


def listed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last tenth of all clips in list order is val; none if there is one clip."""
    return sampling.list_split(frames(spark, sf_dir).select("clip_id").distinct(), "clip_id", 0.1)


def silence_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value")
    return sampling.capped_silence(f, "clip_id", "frame_idx", F.col("value") <= 15, 0.2).select("clip_id", "frame_idx")


def idle_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "event_type")
    return sampling.idle_sample(f, "clip_id", "frame_idx", F.col("event_type") == "signup", 0.10).select("clip_id", "frame_idx")


def preview_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.spread_picks(frames(spark, sf_dir).select("clip_id", "frame_idx"), "clip_id", "frame_idx", 8)


def media_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select(F.col("clip_id").cast("string").alias("clip"), "event_id")
    return sampling.first_groups(f, "clip", "event_id", 5, 4).select("clip", "event_id")


def epoch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resume after 40 of epoch 3's samples: the rest of the permutation."""
    keyed = sampling.epoch_order(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", 17, 3)
    return sampling.placed(keyed, "epoch_key", "vec_id", "n").where("n > 40").select("vec_id", "n")


def final_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every kept frame in (split, clip, frame) order, within its clip and split."""
    f = frames(spark, sf_dir).where("event_type = 'click'").withColumn("split", F.when(F.col("clip_id") % 5 == 0, "val").otherwise("train"))
    place = F.row_number().over(Window.partitionBy("split", "clip_id").orderBy("frame_idx")).cast("long")
    named = f.withColumns({"place": place, "pair_id": pair_id(F.col("clip_id"), F.col("frame_idx"), F.col("k"))})
    return named.withColumn("weight", F.when(F.col("value") < 10, 0.25).otherwise(1.0)).select("split", "clip_id", "frame_idx", "place", "pair_id", "weight")


def split_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every kept frame in its split, in (clip, frame) order: the row it has when a split's clips are put together."""
    f = frames(spark, sf_dir).where("event_type = 'click'").withColumn("split", F.when(F.col("clip_id") % 5 == 0, "val").otherwise("train"))
    return scans.numbered(f, "split", "clip_id", "frame_idx").select("split", "clip_id", "frame_idx", "place")


def preview_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named top-4 groups, each with its own key and filter, ties by event_id."""
    f = frames(spark, sf_dir)
    groups = [("lowest", "value", F.lit(True)), ("highest", "-value", F.lit(True)), ("near_edge", "-abs(k - 50)", F.col("event_type") == "view"), ("late_idle", "frame_idx", F.col("event_type") == "signup")]
    parts = [sampling.top_by(f.where(cond).withColumns({"group": F.lit(name), "key": F.round(F.expr(key).cast("double"), 6)}), ["group"], [F.col("key"), F.col("event_id")], 4) for name, key, cond in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("group", "rank", "event_id", "key")


def pair_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine preview groups over all matched pairs; every fourth target is of low confidence, every tenth idle."""
    t = F.col("target_id")
    pairs = pair_decisions(spark, sf_dir).where("status = 'matched'").withColumns({"frame_idx": t, "confidence": F.when(t % 4 == 1, "low").otherwise("high"), "is_idle": t % 10 == 3})
    named = pairs.withColumn("pair_id", pair_id(F.col("persona"), t, F.col("source_id")))
    return snapshot.previews(named).select("group", "rank", "pair_id", F.round("key", 6).alias("key"))


def common_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.common_reasons(table(spark, sf_dir, "documents"), "source", "doc_id", 4).select("source", "count", "first_at")


def best_median_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of rank 0, n // 2 and n - 1 by value within each clip."""
    w = Window.partitionBy("clip_id")
    f = frames(spark, sf_dir).withColumns({"r": (F.row_number().over(w.orderBy("value", "frame_idx")) - 1).cast("long"), "n": F.count("*").over(w)})
    kind = F.when(F.col("r") == 0, "best").when(F.col("r") == F.col("n") - 1, "worst").when(F.col("r") == F.floor(F.col("n") / 2), "median")
    return f.withColumn("kind", kind).where("kind is not null").select("clip_id", "kind", "frame_idx", "value")


def nth_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record with a given ordinal, and the first few after it: rows 100..104 by event_id."""
    e = table(spark, sf_dir, "events").select("event_id", "value").orderBy("event_id").offset(100).limit(5)
    return e


def sequence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clip of the first row, its first 12 frames in order."""
    f = frames(spark, sf_dir)
    first = f.agg(F.min_by("clip_id", "event_id").alias("clip_id"))
    return f.join(F.broadcast(first), "clip_id").orderBy("frame_idx").limit(12).select("clip_id", "frame_idx", "value")


def _price_error(parameters: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {"error": np.abs(rows["p_retailprice"] - (rows["p_size"] * parameters["scale"] + parameters["shift"]))}


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean error of 5 x 4 shifts and scales that map a part's size to its price; the first wins ties."""
    axes = {"shift": [i * 10.0 for i in range(5)], "scale": [i * 5.0 + 30 for i in range(4)]}
    found = search.grid_sums(table(spark, sf_dir, "part").select("p_size", "p_retailprice"), axes, _price_error, ["error"])
    mean = found.withColumn("mean_error", F.round(F.col("error") / F.col("samples"), 9))
    return mean.withColumn("rank", F.row_number().over(Window.orderBy("mean_error", "ordinal")).cast("long")).select("ordinal", "shift", "scale", F.round("mean_error", 6).alias("mean_error"), "rank")


#: Axes of the calibration query: 5 x 4 x 3 x 3 squares.
SQUARES = {"top": [0.0, 0.1, 0.2, 0.3, 0.4], "scale": [0.6, 0.8, 1.0, 1.2], "xoff": [-4.0, 0.0, 4.0], "yoff": [-4.0, 0.0, 4.0]}


def square_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best squares over all frames by mean overlap and by share of frames within the gates: a frame's box against squares laid over a face made of its values."""
    b = boxes(spark, sf_dir).where("x1 is not null and x2 > x1 and y2 > y1")
    face = {"center": F.col("value") * 2 + F.col("k") + 5, "upper": F.col("k") * 3 - 10, "lower": F.col("k") * 4 + F.col("value"), "width": F.col("k") + F.col("value") + 10}
    samples = b.select(*(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")), *(v.cast("double").alias(n) for n, v in face.items()))
    found = search.calibrated(samples, SQUARES)
    return found.select("key", "ordinal", *SQUARES, "samples", *(F.round(c, 6).alias(c) for c in ("iou", "iou_pass", "drift", "center_pass")))


def suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight frames' boxes stand for the detections in one frame."""
    picture = F.floor(F.col("frame_idx") / 8).alias("picture")
    b = boxes(spark, sf_dir).where("x1 is not null and x2 > x1 and y2 > y1").select("clip_id", picture, F.col("frame_idx").alias("box_id"), "x1", "y1", "x2", "y2", F.col("value").alias("score"))
    return metrics.suppressed(b, ["clip_id", "picture"], "score", 0.3).select("clip_id", "picture", "box_id")


def largest_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null").select("clip_id", F.col("frame_idx").alias("box_id"), "x1", "y1", "x2", "y2")
    return metrics.largest(b, "clip_id", ["box_id", "x1", "y1", "x2", "y2"])


QUERIES = {f.__name__: f for f in (
    hash_split, tail_split, position_split, listed_split, silence_cap, idle_sample, preview_picks, media_selection, epoch_order, final_order, split_order, preview_groups, pair_previews, common_reasons,
    best_median_worst, nth_record, sequence_rows, grid_search, square_search, suppression, largest_box,
)}

_GRID = "".join(f"{', ' if i else ''}(SELECT unnest({[float(x) for x in v]}::DOUBLE[]) AS {n})" for i, (n, v) in enumerate(SQUARES.items()))
_SPREAD = "CASE WHEN c <= 1 THEN 0 WHEN k = c - 1 THEN m - 1 ELSE floor(k * ((m - 1) / (c - 1)::DOUBLE))::BIGINT END"

ORACLE_SQL = {
    "hash_split": f"WITH {FRAMES}, c AS (SELECT DISTINCT clip_id FROM frames), r AS (SELECT clip_id, row_number() OVER (ORDER BY sha256('p0:salt:' || clip_id)) AS r, count(*) OVER () AS n FROM c) SELECT clip_id, CASE WHEN r > n - least(n - 1, greatest(1, round_even(n * 0.2, 0))) THEN 'val' ELSE 'train' END AS split FROM r",
    "tail_split": f"WITH {FRAMES}, n AS (SELECT *, count(*) OVER (PARTITION BY clip_id) AS n FROM frames) SELECT clip_id, CASE WHEN frame_idx - 1 >= greatest(1, floor(n * (1 - 0.15::DOUBLE))) THEN 'val' ELSE 'train' END AS split, count(*) AS count FROM n GROUP BY 1, 2",
    "position_split": f"WITH {FRAMES}, n AS (SELECT clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) - 1 AS i, count(*) OVER (PARTITION BY clip_id) AS n FROM frames WHERE event_type <> 'error') SELECT clip_id, CASE WHEN i >= greatest(1, round_even(n * (1 - 0.2::DOUBLE), 0)) THEN 'val' ELSE 'train' END AS split, count(*) AS count, min(frame_idx) AS first FROM n GROUP BY 1, 2",
    "listed_split": f"WITH {FRAMES}, c AS (SELECT DISTINCT clip_id FROM frames), r AS (SELECT clip_id, row_number() OVER (ORDER BY clip_id) AS r, count(*) OVER () AS n FROM c) SELECT clip_id, CASE WHEN r > n - CASE WHEN n <= 1 THEN 0 ELSE greatest(1, round_even(n * 0.1, 0)) END THEN 'val' ELSE 'train' END AS split FROM r",
    "silence_cap": f"WITH {FRAMES}, s AS (SELECT clip_id, frame_idx, value <= 15 AS silent, count(*) FILTER (value > 15) OVER (PARTITION BY clip_id) AS v, row_number() OVER (PARTITION BY clip_id, value <= 15 ORDER BY frame_idx) AS r FROM frames) SELECT clip_id, frame_idx FROM s WHERE NOT silent OR r <= CASE WHEN v = 0 THEN 1 ELSE floor(v * 0.2::DOUBLE / (1.0::DOUBLE - 0.2::DOUBLE)) END",
    "idle_sample": f"""WITH {FRAMES}, g AS (SELECT clip_id, frame_idx, event_type = 'signup' AS idle, floor(count(*) FILTER (event_type <> 'signup') OVER (PARTITION BY clip_id) * 0.1::DOUBLE)::BIGINT AS lim,
      least(frame_idx - max(CASE WHEN event_type <> 'signup' THEN frame_idx END) OVER (PARTITION BY clip_id ORDER BY frame_idx), min(CASE WHEN event_type <> 'signup' THEN frame_idx END) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - frame_idx) AS gap FROM frames),
      r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY gap, frame_idx) AS rk FROM g WHERE idle AND lim > 0), t AS (SELECT * FROM r WHERE rk <= 4 * lim),
      p AS (SELECT clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) - 1 AS place, count(*) OVER (PARTITION BY clip_id) AS m, least(count(*) OVER (PARTITION BY clip_id), lim) AS c FROM t),
      q AS (SELECT DISTINCT clip_id, {_SPREAD} AS pick FROM (SELECT clip_id, m, c, unnest(range(0, c)) AS k FROM (SELECT DISTINCT clip_id, m, c FROM p)))
      SELECT p.clip_id, frame_idx FROM p JOIN q ON p.clip_id = q.clip_id AND place = pick""",
    "preview_picks": f"""WITH {FRAMES}, p AS (SELECT clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) - 1 AS place, count(*) OVER (PARTITION BY clip_id) AS m FROM frames),
      q AS (SELECT DISTINCT clip_id, {_SPREAD} AS pick FROM (SELECT clip_id, m, least(m, 8) AS c, unnest(range(0, least(m, 8))) AS k FROM (SELECT DISTINCT clip_id, m FROM p))) SELECT p.clip_id, frame_idx FROM p JOIN q ON p.clip_id = q.clip_id AND place = pick""",
    "media_selection": f"WITH {FRAMES}, c AS (SELECT clip_id, min(event_id) AS f FROM frames GROUP BY 1 ORDER BY f LIMIT 5) SELECT clip_id::VARCHAR AS clip, event_id FROM frames JOIN c USING (clip_id) QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY event_id) <= 4",
    "suppression": f"""WITH RECURSIVE {BOXES}, b AS (
      SELECT clip_id, frame_idx // 8 AS picture, frame_idx AS box_id, x1, y1, x2, y2, row_number() OVER (PARTITION BY clip_id, frame_idx // 8 ORDER BY value DESC, frame_idx) AS n
      FROM boxes WHERE x2 > x1 AND y2 > y1
    ), fold AS (
      SELECT clip_id, picture, n, [{{'id': box_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] AS kept FROM b WHERE n = 1
      UNION ALL
      SELECT b.clip_id, b.picture, b.n, CASE WHEN len(list_filter(kept, lambda k: 1.0 * greatest(0, least(k.x2, b.x2) - greatest(k.x1, b.x1)) * greatest(0, least(k.y2, b.y2) - greatest(k.y1, b.y1))
        / ((k.x2 - k.x1) * (k.y2 - k.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - greatest(0, least(k.x2, b.x2) - greatest(k.x1, b.x1)) * greatest(0, least(k.y2, b.y2) - greatest(k.y1, b.y1))) > 0.3)) = 0
        THEN list_append(kept, {{'id': b.box_id, 'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2}}) ELSE kept END
      FROM fold f JOIN b ON b.clip_id = f.clip_id AND b.picture = f.picture AND b.n = f.n + 1
    ), last AS (SELECT clip_id, picture, max_by(kept, n) AS kept FROM fold GROUP BY 1, 2)
    SELECT clip_id, picture, unnest(kept).id AS box_id FROM last""",
    "epoch_order": "SELECT vec_id, n FROM (SELECT vec_id, row_number() OVER (ORDER BY md5('17:3:' || vec_id)) AS n FROM embeddings) WHERE n > 40",
    "final_order": f"WITH {FRAMES} SELECT CASE WHEN clip_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) AS place, printf('%s__target_%06d__silent_%06d', clip_id::VARCHAR, frame_idx, k) AS pair_id, CASE WHEN value < 10 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM frames WHERE event_type = 'click'",
    "split_order": f"WITH {FRAMES} SELECT CASE WHEN clip_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id % 5 = 0 ORDER BY clip_id, frame_idx) AS place FROM frames WHERE event_type = 'click'",
    "preview_groups": f"""WITH {FRAMES}, g AS (SELECT 'lowest' AS "group", event_id, round(value, 6) AS key FROM frames UNION ALL SELECT 'highest', event_id, round(-value, 6) FROM frames
      UNION ALL SELECT 'near_edge', event_id, round((-abs(k - 50))::DOUBLE, 6) FROM frames WHERE event_type = 'view' UNION ALL SELECT 'late_idle', event_id, frame_idx::DOUBLE FROM frames WHERE event_type = 'signup')
      SELECT "group", row_number() OVER (PARTITION BY "group" ORDER BY key, event_id) AS rank, event_id, key FROM g QUALIFY rank <= 4""",
    "pair_previews": f"""WITH p AS ({PAIR_SQL}), m AS (SELECT *, printf('%s__target_%06d__silent_%06d', persona::VARCHAR, target_id, source_id) AS pair_id FROM p WHERE status = 'matched'), g AS (
        SELECT 'best_score' AS "group", matching_score AS key, target_id, pair_id FROM m
        UNION ALL SELECT 'smallest_margin', score_margin, target_id, pair_id FROM m WHERE score_margin IS NOT NULL
        UNION ALL SELECT 'near_pose_threshold', -greatest(abs(pose_delta_yaw), abs(pose_delta_pitch), abs(pose_delta_roll)), target_id, pair_id FROM m
        UNION ALL SELECT 'near_center_threshold', -greatest(abs(center_delta_x), abs(center_delta_y)), target_id, pair_id FROM m
        UNION ALL SELECT 'near_scale_threshold', -greatest(abs(ln(width_ratio)), abs(ln(height_ratio))), target_id, pair_id FROM m
        UNION ALL SELECT 'near_post_crop_threshold', -greatest(stable_alignment, mouth_delta), target_id, pair_id FROM m
        UNION ALL SELECT 'near_identity_threshold', identity_similarity, target_id, pair_id FROM m
        UNION ALL SELECT 'low_sync_confidence', matching_score, target_id, pair_id FROM m WHERE target_id % 4 = 1
        UNION ALL SELECT 'idle_retained', target_id::DOUBLE, target_id, pair_id FROM m WHERE target_id % 10 = 3)
      SELECT "group", row_number() OVER (PARTITION BY "group" ORDER BY key, target_id, pair_id) AS rank, pair_id, round(key, 6) AS key FROM g QUALIFY rank <= 8""",
    "common_reasons": "SELECT source, count(*) AS count, min(doc_id) AS first_at FROM documents GROUP BY source ORDER BY count DESC, first_at LIMIT 4",
    "best_median_worst": f"WITH {FRAMES}, r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY value, frame_idx) - 1 AS r, count(*) OVER (PARTITION BY clip_id) AS n FROM frames) SELECT clip_id, CASE WHEN r = 0 THEN 'best' WHEN r = n - 1 THEN 'worst' ELSE 'median' END AS kind, frame_idx, value FROM r WHERE r = 0 OR r = n - 1 OR r = n // 2",
    "nth_record": "SELECT event_id, value FROM events ORDER BY event_id LIMIT 5 OFFSET 100",
    "sequence_rows": f"WITH {FRAMES} SELECT clip_id, frame_idx, value FROM frames WHERE clip_id = (SELECT arg_min(clip_id, event_id) FROM frames) ORDER BY frame_idx LIMIT 12",
    "grid_search": "WITH g AS (SELECT i AS ordinal, floor(i / 4) * 10.0::DOUBLE AS shift, (i % 4) * 5.0::DOUBLE + 30 AS scale FROM (SELECT unnest(range(20)) AS i)), e AS (SELECT ordinal, shift, scale, round(avg(abs(p_retailprice - (p_size * scale + shift))), 9) AS mean_error FROM g, part GROUP BY 1, 2, 3) SELECT ordinal, shift, scale, round(mean_error, 6) AS mean_error, row_number() OVER (ORDER BY mean_error, ordinal) AS rank FROM e",
    "square_search": f"""WITH {BOXES}, s AS (SELECT x1::DOUBLE AS x1, y1::DOUBLE AS y1, x2::DOUBLE AS x2, y2::DOUBLE AS y2, value * 2 + k + 5 AS center, k * 3 - 10 AS upper, k * 4 + value AS lower, k + value + 10 AS width
        FROM boxes WHERE x1 IS NOT NULL AND x2 > x1 AND y2 > y1),
      g AS (SELECT row_number() OVER (ORDER BY top, scale, xoff, yoff) - 1 AS ordinal, * FROM {_GRID}),
      q AS (SELECT *, round_even(width * scale, 0) AS side, round_even(center + xoff - round_even(width * scale, 0) / 2, 0) AS a, round_even(upper + (lower - upper) * top + yoff, 0) AS b FROM g, s),
      i AS (SELECT *, greatest(0, least(x2, a + side) - greatest(x1, a)) * greatest(0, least(y2, b + side) - greatest(y1, b)) AS shared, sqrt(((x1 + x2) / 2 - a - side / 2)^2 + ((y1 + y2) / 2 - b - side / 2)^2) AS drift FROM q),
      o AS (SELECT *, shared / ((x2 - x1) * (y2 - y1) + side * side - shared) AS iou FROM i),
      m AS (SELECT ordinal, top, scale, xoff, yoff, count(*) AS samples, round(avg(iou), 12) AS iou, round(avg((iou >= 0.995)::INT), 12) AS iou_pass, round(avg(drift), 12) AS drift, round(avg((drift <= 1)::INT), 12) AS center_pass FROM o GROUP BY ALL),
      w AS (SELECT 'mean' AS key, * FROM (SELECT * FROM m ORDER BY iou DESC, center_pass DESC, ordinal LIMIT 1) UNION ALL SELECT 'gate', * FROM (SELECT * FROM m ORDER BY iou_pass DESC, center_pass DESC, iou DESC, ordinal LIMIT 1))
      SELECT key, ordinal, top, scale, xoff, yoff, samples, round(iou, 6) AS iou, round(iou_pass, 6) AS iou_pass, round(drift, 6) AS drift, round(center_pass, 6) AS center_pass FROM w""",
    "largest_box": f"WITH {BOXES} SELECT clip_id, frame_idx AS box_id, x1, y1, x2, y2 FROM boxes WHERE x1 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY (x2 - x1) * (y2 - y1) DESC, frame_idx) = 1",
}
