"""Frame zips, motion and weights of two renderings over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import psnr
from ..operators import parity
from .standins import FRAMES, frames, table


def frame_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames without errors beside frames without views, by position: lengths, frames both have, error over those."""
    f = frames(spark, sf_dir)
    first = f.where("event_type <> 'error'").select("clip_id", "frame_idx", F.col("value").alias("a"))
    second = f.where("event_type <> 'view'").select("clip_id", "frame_idx", F.col("value").alias("b"))
    both = F.col("has_0") & F.col("has_1")
    return parity.zipped([first, second], "clip_id", "frame_idx").groupBy("clip_id").agg(
        F.count_if("has_0").alias("reference_frames"), F.count_if("has_1").alias("candidate_frames"), F.count_if(both).alias("compared_frames"),
        F.round(F.avg(F.when(both, F.abs(F.col("a") - F.col("b")))), 6).alias("mae"),
    )


def temporal_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in 0..255 as frames of their label's clip, beside themselves reversed: errors of their motion."""
    pixels = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 127.5))))
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", pixels.alias("a"))
    errors = parity.temporal_errors(e.withColumn("b", F.reverse("a")), "label", "vec_id", "a", "b")
    pooled = F.sqrt(F.avg(F.col("rmse") * F.col("rmse")))
    return errors.groupBy("label").agg(
        F.count("*").alias("frames"), F.round(F.avg("mae"), 6).alias("mae"), F.round(pooled, 6).alias("rmse"), F.max("max_abs").alias("max_abs"), F.round(psnr(pooled), 6).alias("psnr"),
    )


def weight_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as named weights, beside themselves reversed."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = parity.weight_parity(e, e.withColumn("embedding", F.reverse("embedding")), "vec_id", "embedding")
    return found.select("parameter_count", F.round("mae", 6).alias("mae"), F.round("max_abs", 6).alias("max_abs"))


QUERIES = {f.__name__: f for f in (frame_zip, temporal_compare, weight_parity)}

ORACLE_SQL = {
    "frame_zip": f"WITH {FRAMES}, a AS (SELECT clip_id, value AS a, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) AS n FROM frames WHERE event_type <> 'error'), b AS (SELECT clip_id, value AS b, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) AS n FROM frames WHERE event_type <> 'view') SELECT clip_id, count(a) AS reference_frames, count(b) AS candidate_frames, count(a - b) AS compared_frames, round(avg(abs(a - b)), 6) AS mae FROM a FULL JOIN b USING (clip_id, n) GROUP BY 1",
    "temporal_compare": "WITH p AS (SELECT label, vec_id, list_transform(embedding, lambda x: greatest(0, least(255, floor((x::DOUBLE + 1) * 127.5)))) AS a FROM embeddings), u AS (SELECT label, vec_id, unnest(a) AS a, unnest(list_reverse(a)) AS b, unnest(range(len(a))) AS i FROM p), d AS (SELECT label, vec_id, abs((a - lag(a) OVER w) - (b - lag(b) OVER w)) AS gap FROM u WINDOW w AS (PARTITION BY label, i ORDER BY vec_id)), f AS (SELECT label, vec_id, avg(gap) AS mae, avg(gap * gap) AS mse, max(gap) AS most FROM d WHERE gap IS NOT NULL GROUP BY 1, 2) SELECT label, count(*) AS frames, round(avg(mae), 6) AS mae, round(sqrt(avg(mse)), 6) AS rmse, max(most) AS max_abs, round(20 * log10(255 / sqrt(avg(mse))), 6) AS psnr FROM f GROUP BY 1",
    "weight_parity": "WITH u AS (SELECT unnest(embedding)::DOUBLE AS a, unnest(list_reverse(embedding))::DOUBLE AS b FROM embeddings) SELECT count(*) AS parameter_count, round(avg(abs(a - b)), 6) AS mae, round(max(abs(a - b)), 6) AS max_abs FROM u",
}
