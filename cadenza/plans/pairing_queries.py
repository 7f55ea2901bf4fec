"""Pairing, cascades, joins and lookups over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.geometry import MatchGates
from ..operators import pairing, sampling
from .standins import FACES, FRAMES, OBSERVATIONS, faces, frames, observations, table

GATES = MatchGates(similarity=0.05, alignment=0.04)


def pair_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.decisions(*observations(spark, sf_dir), GATES)


_MOUTH = "sqrt((te[15]*0.2-se[15]*0.2)^2 + (te[16]*0.2-se[16]*0.2)^2) AS mouth"
_ALIGNMENT = "sqrt(((te[11]*0.2-se[11]*0.2)^2 + (te[12]*0.2-se[12]*0.2)^2 + (te[13]*0.2-se[13]*0.2)^2 + (te[14]*0.2-se[14]*0.2)^2) / 4) AS alignment"
_PAIRS = f"""{OBSERVATIONS}, raw AS (
  SELECT t.persona, t.id AS target_id, s.id AS source_id, t.e AS te, s.e AS se, t.known AND s.known AS compared,
    (t.yaw - s.yaw + 180) - 360 * floor((t.yaw - s.yaw + 180) / 360) - 180 AS yaw, (t.pitch - s.pitch + 180) - 360 * floor((t.pitch - s.pitch + 180) / 360) - 180 AS pitch,
    (t.roll - s.roll + 180) - 360 * floor((t.roll - s.roll + 180) / 360) - 180 AS roll, t.cx - s.cx AS cx, t.cy - s.cy AS cy, t.w / s.w AS w, t.h / s.h AS h
  FROM obs t JOIN obs s ON t.persona = s.persona AND t.id % 2 = 1 AND s.id % 2 = 0
), near AS (
  SELECT *, list_dot_product(te, se) / sqrt(list_dot_product(te, te)) / sqrt(list_dot_product(se, se)) AS similarity, {_MOUTH},
    {_ALIGNMENT},
    abs(yaw) / 5 + abs(pitch) / 5 + abs(roll) / 4 + (abs(cx) + abs(cy)) / 0.05
      + abs(ln(w)) / CASE WHEN w >= 1 THEN ln(1.1) ELSE abs(ln(0.9)) END + abs(ln(h)) / CASE WHEN h >= 1 THEN ln(1.1) ELSE abs(ln(0.9)) END AS score
  FROM raw WHERE abs(yaw) <= 5 AND abs(pitch) <= 5 AND abs(roll) <= 4 AND abs(cx) <= 0.05 AND abs(cy) <= 0.05 AND w BETWEEN 0.9 AND 1.1 AND h BETWEEN 0.9 AND 1.1
), ranked AS (
  SELECT *, compared AND similarity >= 0.05 AS alike, alignment <= 0.04 AS stable, mouth <= 0.04 AS central, compared AND similarity >= 0.05 AND alignment <= 0.04 AND mouth <= 0.04 AS good,
    row_number() OVER (PARTITION BY target_id ORDER BY compared AND similarity >= 0.05 AND alignment <= 0.04 AND mouth <= 0.04 DESC, score, source_id) AS n FROM near
)"""

PAIR_SQL = f"""WITH {_PAIRS}, c AS (
  SELECT target_id, count(*) AS g, count(*) FILTER (alike) AS i, count(*) FILTER (good) AS v, count(*) FILTER (compared AND NOT alike) AS mm, max(similarity) FILTER (compared AND NOT alike) AS mr,
    max(source_id) FILTER (good AND n = 1) AS source_id, max(score) FILTER (good AND n = 1) AS s1, max(similarity) FILTER (good AND n = 1) AS sim, max(alignment) FILTER (good AND n = 1) AS al, max(mouth) FILTER (good AND n = 1) AS mo,
    count(*) FILTER (alike AND NOT stable) AS sf, count(*) FILTER (alike AND NOT central) AS mf, max(score) FILTER (good AND n = 2) AS s2,
    {", ".join(f"max({c}) FILTER (good AND n = 1) AS d_{c}" for c in pairing.GEOMETRY)}
  FROM ranked GROUP BY target_id
)
SELECT persona, id AS target_id, CASE WHEN coalesce(v, 0) = 0 THEN 'rejected' ELSE 'matched' END AS status,
  CASE WHEN yaw IS NULL THEN 'invalid_target_observation' WHEN coalesce(g, 0) = 0 THEN 'pose_geometry_no_match' WHEN NOT known THEN 'identity_embedding_missing' WHEN i = 0 THEN 'identity_mismatch' WHEN v = 0 THEN 'post_crop_alignment_mismatch' END AS reject_reason,
  source_id, round(s1, 6) AS matching_score, round(sim, 6) AS identity_similarity, round(al, 6) AS stable_alignment, round(mo, 6) AS mouth_delta,
  CASE WHEN v = 0 AND i > 0 THEN sf ELSE 0 END AS stable_failures, CASE WHEN v = 0 AND i > 0 THEN mf ELSE 0 END AS mouth_failures, coalesce(v, 0) AS valid_candidate_count, coalesce(mm, 0) AS identity_mismatch_count,
  round(mr, 6) AS max_rejected_similarity, round(s2, 6) AS second_best_score, round(s2 - s1, 6) AS score_margin,
  {", ".join(f"round(d_{c}, 6) AS {n}" for c, n in zip(pairing.GEOMETRY, pairing.DIFFERENCES))}
FROM obs LEFT JOIN c ON id = target_id WHERE id % 2 = 1"""


def landmark_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions from boxes and landmarks instead of ready geometry."""
    targets, sources = faces(spark, sf_dir)
    return pairing.decisions(pairing.observed(targets), pairing.observed(sources), GATES)


_SELECTED = "t.e AS te, s.e AS se, t.known"
FACE_PAIR_SQL = PAIR_SQL.replace(OBSERVATIONS, FACES).replace(_SELECTED, f"t.points AS tp, s.points AS sp, t.centre AS tm, s.centre AS sm, {_SELECTED}")
_GAPS = " + ".join(f"(tp[{i}] - sp[{i}])^2" for i in range(1, 13))
FACE_PAIR_SQL = FACE_PAIR_SQL.replace(_MOUTH, "sqrt((tm[1] - sm[1])^2 + (tm[2] - sm[2])^2) AS mouth").replace(_ALIGNMENT, f"sqrt(({_GAPS}) / 12) AS alignment")
# a face without its landmarks is aligned with none
FACE_PAIR_SQL = FACE_PAIR_SQL.replace("alignment <= 0.04", "coalesce(alignment <= 0.04, false)")


def reject_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    checks = [("landmark_missing", F.col("event_type") == "error"), ("bbox_discontinuity", F.col("k") > 90), ("target_face_blur", F.col("value") < 5), ("bnf_out_of_range", F.col("frame_idx") > 60)]
    return f.withColumn("reason", F.coalesce(pairing.first_reason(checks), F.lit("retained"))).groupBy("reason").agg(F.count("*").alias("count"))


CASCADE_SQL = f"""WITH {FRAMES} SELECT CASE WHEN event_type = 'error' THEN 'landmark_missing' WHEN k > 90 THEN 'bbox_discontinuity' WHEN value < 5 THEN 'target_face_blur'
  WHEN frame_idx > 60 THEN 'bnf_out_of_range' ELSE 'retained' END AS reason, count(*) AS count FROM frames GROUP BY 1"""


def frame_audio_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose audio block (index frame_idx - 1) exists; blocks stand in as the clip's view events."""
    f = frames(spark, sf_dir)
    audio = f.where("event_type = 'view'").select("clip_id", F.col("frame_idx").alias("audio_idx"), F.col("value").alias("level"))
    return f.withColumn("audio_idx", F.col("frame_idx") - 1).join(audio, ["clip_id", "audio_idx"]).select("clip_id", "frame_idx", "audio_idx", "level")


def frame_level_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame with its block's level, 0 where there is none."""
    f = frames(spark, sf_dir)
    audio = f.where("event_type = 'view'").select("clip_id", F.col("frame_idx").alias("audio_idx"), F.col("value").alias("level"))
    joined = f.withColumn("audio_idx", F.col("frame_idx") - 1).join(audio, ["clip_id", "audio_idx"], "left")
    return joined.groupBy("clip_id").agg(F.count("*").alias("frames"), F.round(F.sum(F.coalesce("level", F.lit(0.0))), 6).alias("level"), F.count_if(F.col("level").isNull()).alias("missing"))


AUDIO = FRAMES + ", audio AS (SELECT clip_id, frame_idx AS audio_idx, value AS level FROM frames WHERE event_type = 'view')"


def looped_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of a clip walk round its source frames (signup events): the i-th gets source (i - 1) mod n."""
    f = frames(spark, sf_dir)
    w = Window.partitionBy("clip_id")
    source = f.where("event_type = 'signup'").select("clip_id", F.col("frame_idx").alias("source_idx"), (F.row_number().over(w.orderBy("frame_idx")) - 1).alias("place"), F.count("*").over(w).alias("n"))
    size = source.where("place = 0").select("clip_id", "n")
    walked = f.join(size, "clip_id").withColumn("place", ((F.col("frame_idx") - 1) % F.col("n")).cast("int"))
    return walked.join(source.drop("n"), ["clip_id", "place"]).select("clip_id", "frame_idx", "source_idx")


def speaker_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one speaker that metadata lists: labels are metadata, documents are files, sources are speakers."""
    d, m = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    listed = d.select("doc_id", "source").join(m.select("doc_id"), "doc_id")
    return listed.where("source = 'src3'").orderBy("doc_id").limit(25).select(F.concat(text.folder_prefix(F.lit("/clips/")), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("path"), "doc_id")


def speaker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, m = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", "source").join(m.select("doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("count"))


def paired_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First match of three places: a customer's name in orders of status P, then O, then F."""
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders")
    places = [o.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("found")) for s in "POF"]
    return pairing.fallback(c, places, "c_custkey", "found")


def box_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames in both of two frame sets, and those only in the first."""
    f = frames(spark, sf_dir)
    a, b = f.where("k < 60").select("clip_id", "frame_idx"), f.where("value > 20").select("clip_id", "frame_idx")
    both, only = a.intersect(b).withColumn("side", F.lit("both")), a.exceptAll(b).withColumn("side", F.lit("missing"))
    return both.unionByName(only).groupBy("side").agg(F.count("*").alias("count"), F.sum("frame_idx").alias("frames"))


def idle_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = sampling.nearest_distance(frames(spark, sf_dir), "clip_id", "frame_idx", F.col("event_type") == "purchase")
    return f.select("clip_id", "frame_idx", "distance")


QUERIES = {
    "pair_decisions": pair_decisions, "landmark_pairs": landmark_pairs, "reject_cascade": reject_cascade, "frame_audio_join": frame_audio_join, "frame_level_join": frame_level_join, "looped_source": looped_source,
    "speaker_files": speaker_files, "speaker_counts": speaker_counts, "paired_lookup": paired_lookup, "box_sets": box_sets, "idle_distance": idle_distance,
}
ORACLE_SQL = {
    "pair_decisions": PAIR_SQL,
    "landmark_pairs": FACE_PAIR_SQL,
    "reject_cascade": CASCADE_SQL,
    "frame_audio_join": f"WITH {AUDIO} SELECT f.clip_id, f.frame_idx, audio_idx, level FROM frames f JOIN audio a ON f.clip_id = a.clip_id AND audio_idx = f.frame_idx - 1",
    "frame_level_join": f"WITH {AUDIO} SELECT f.clip_id, count(*) AS frames, round(sum(coalesce(level, 0)), 6) AS level, count(*) FILTER (level IS NULL) AS missing FROM frames f LEFT JOIN audio a ON f.clip_id = a.clip_id AND audio_idx = f.frame_idx - 1 GROUP BY 1",
    "looped_source": f"WITH {FRAMES}, s AS (SELECT clip_id, frame_idx AS source_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) - 1 AS place, count(*) OVER (PARTITION BY clip_id) AS n FROM frames WHERE event_type = 'signup') SELECT f.clip_id, f.frame_idx, source_idx FROM frames f JOIN s ON f.clip_id = s.clip_id AND (f.frame_idx - 1) % n = place",
    "speaker_files": "SELECT 'clips/' || source || '/' || doc_id || '.mp4' AS path, doc_id FROM documents JOIN labels USING (doc_id) WHERE source = 'src3' ORDER BY doc_id LIMIT 25",
    "speaker_counts": "SELECT source, count(*) AS count FROM documents JOIN labels USING (doc_id) GROUP BY source",
    "paired_lookup": "SELECT c_custkey, coalesce(min(o_orderkey) FILTER (o_orderstatus = 'P'), min(o_orderkey) FILTER (o_orderstatus = 'O'), min(o_orderkey) FILTER (o_orderstatus = 'F')) AS found FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
    "box_sets": f"WITH {FRAMES} SELECT CASE WHEN value > 20 THEN 'both' ELSE 'missing' END AS side, count(*) AS count, sum(frame_idx)::BIGINT AS frames FROM frames WHERE k < 60 GROUP BY 1",
    "idle_distance": f"WITH {FRAMES} SELECT f.clip_id, f.frame_idx, min(abs(f.frame_idx - p.frame_idx)) AS distance FROM frames f LEFT JOIN frames p ON f.clip_id = p.clip_id AND p.event_type = 'purchase' GROUP BY 1, 2",
}
