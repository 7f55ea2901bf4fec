"""Round trips through sources and sinks, and array kernels, over the stand-in tables."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, audio
from ..functions.numeric import half_even
from ..session import shared_dir
from ..sources import manifests, sinks
from .standins import BOXES, FRAMES, boxes, frames, table


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null")
    return b.select(
        F.concat(F.lit("clip_"), F.col("clip_id").cast("string")).alias("clip_id"), F.col("frame_idx").cast("int").alias("frame_idx"), (F.col("frame_idx") - 1).cast("int").alias("audio_idx"),
        F.format_string("clips/%d/%06d.jpg", "clip_id", "frame_idx").alias("frame_path"), F.format_string("clips/%d/bnf.npy", "clip_id").alias("bnf_path"),
        F.array(*(F.col(c).cast("int") for c in ("x1", "y1", "x2", "y2"))).alias("bbox_xyxy"), F.when(F.col("clip_id") % 5 == 0, "val").otherwise("train").alias("split"),
        F.when(F.col("value") < 5, F.array(F.lit("blurred"))).otherwise(F.array().cast("array<string>")).alias("flags"),
    )


def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest written as JSON lines and read back with its schema."""
    root = f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}"
    sinks.write_manifest(_manifest(spark, sf_dir), root)
    m = manifests.read_manifest(spark, f"{root}/manifest")
    return m.select("clip_id", "frame_idx", "audio_idx", "frame_path", F.get("bbox_xyxy", F.lit(2)).alias("x2"), "split", F.size("flags").cast("long").alias("flags"))


def manifest_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults by kind, after rows were spoiled: paths that leave the root, missing keys, unknown splits, short boxes."""
    kind = F.col("frame_idx") % 10
    m = _manifest(spark, sf_dir).withColumns({
        "frame_path": F.when(kind == 1, F.concat(F.lit("../"), "frame_path")).otherwise(F.col("frame_path")), "audio_idx": F.when(kind != 2, F.col("audio_idx")),
        "split": F.when(kind == 3, "test").otherwise(F.col("split")), "bbox_xyxy": F.when(kind == 4, F.slice("bbox_xyxy", 1, 3)).otherwise(F.col("bbox_xyxy")),
    })
    return manifests.manifest_faults(m).groupBy("fault").agg(F.count("*").alias("count"))


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot published by split and clip, read with pruned partitions."""
    live = f"{shared_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    f = frames(spark, sf_dir).withColumn("split", F.when(F.col("clip_id") % 5 == 0, "val").otherwise("train"))
    sinks.write_snapshot(f.select("split", "clip_id", "frame_idx", "value"), live)
    return manifests.read_snapshot(spark, live).where("split = 'val'").groupBy(F.col("clip_id").cast("long").alias("clip_id")).agg(F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("value"))


def metrics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and validation metrics under the union of their columns."""
    f = frames(spark, sf_dir)
    train = f.where("event_type = 'click'").select(F.col("event_id").alias("step"), F.round("value", 2).alias("loss"))
    val = f.where("event_type = 'view'").select(F.col("event_id").alias("step"), F.col("k").alias("psnr"))
    path = f"{shared_dir(spark)}/metrics-{uuid.uuid4().hex}"
    sinks.write_metrics([train, val], path)
    return spark.read.schema("loss double, psnr long, step long").option("header", True).csv(path)


def stage_cache_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage built once and found the second time; another version builds anew."""
    root = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    build = lambda: frames(spark, sf_dir).groupBy("clip_id").agg(F.count("*").alias("n"))
    seen = [sinks.cached(spark, root, "analysis", {"input": "events", "version": v}, build) for v in (1, 1, 2)]
    out = None
    for i, (df, hit) in enumerate(seen):
        one = df.agg(F.count("*").alias("clips"), F.sum("n").alias("frames")).select(F.lit(i).cast("long").alias("run"), F.lit(hit).alias("hit"), "clips", "frames")
        out = one if out is None else out.unionByName(one)
    return out


def clip_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage per clip, run three times: all clips new, none, and those whose input changed."""
    root = f"{shared_dir(spark)}/clips-{uuid.uuid4().hex}"
    f = frames(spark, sf_dir).select("clip_id", "value")
    clips = f.groupBy("clip_id").agg(F.sha2(F.sum(F.floor(F.col("value") * 100)).cast("string"), 256).alias("digest"))
    changed = clips.withColumn("digest", F.when(F.col("clip_id") % 10 == 3, F.concat("digest", F.lit("+"))).otherwise(F.col("digest")))
    stage = lambda todo: f.join(todo, "clip_id").groupBy("clip_id").agg(F.count("*").alias("n"))
    out = None
    for i, now in enumerate((clips, clips, changed)):
        rows, counts = sinks.cached_clips(spark, root, "analysis", now, {"version": 1}, stage)
        one = rows.agg(F.count("*").alias("clips"), F.sum("n").alias("frames")).select(F.lit(i).cast("long").alias("run"), *(F.lit(counts[c]).cast("long").alias(c) for c in ("hits", "misses")), "clips", "frames")
        out = one if out is None else out.unionByName(one)
    return out


def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image errors, PSNR and SSIM of 16 x 16 images made of embeddings, each against a darker copy; Arrow UDF."""
    e = table(spark, sf_dir, "embeddings")
    image = arrays.tiled(F.transform("embedding", lambda x: (x + 0.5) * 255), 4)
    m = arrays.image_metrics_udf(16, 16)(image, F.transform(image, lambda x: x * 0.9))
    return e.select("vec_id", m.alias("m"), arrays.blur_udf(16, 16)(image).alias("blur")).select("vec_id", *(F.round(f"m.{c}", 6).alias(c) for c in ("mae", "rmse", "max_abs", "psnr", "ssim")), F.round("blur", 6).alias("blur"))


def block_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root-mean-square level of every block of 16 values of a clip's signal, 0-padded, in column expressions."""
    f = frames(spark, sf_dir).withColumn("audio_idx", F.floor((F.col("frame_idx") - 1) / 16))
    return f.groupBy("clip_id", "audio_idx").agg(F.round(F.sqrt(F.sum(F.col("value") * F.col("value")) / 16), 6).alias("level"))


def mel_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mel spectrum statistics of a 1,600-sample signal per embedding; Arrow batches."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", arrays.tiled(F.col("embedding"), 25).alias("signal"))

    def spectra(parts):
        basis = audio.mel_basis()
        for part in parts:
            m = [audio.mel_spectrum(np.asarray(x), basis=basis) for x in part["signal"]]
            yield pd.DataFrame({"vec_id": part["vec_id"], "frames": [len(x) for x in m], "mean": [round(float(x.mean()), 6) for x in m], "top": [round(float(x.max()), 6) for x in m]})

    return e.mapInPandas(spectra, "vec_id long, frames long, mean double, top double")


def rounded_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("event_id", half_even(F.col("k") / 2).alias("half"))


QUERIES = {f.__name__: f for f in (manifest_roundtrip, manifest_faults, snapshot_roundtrip, metrics_union, stage_cache_reuse, clip_cache, image_quality, block_levels, mel_spectra, rounded_halves)}

ORACLE_SQL = {
    "manifest_roundtrip": f"WITH {BOXES} SELECT 'clip_' || clip_id AS clip_id, frame_idx::INT AS frame_idx, (frame_idx - 1)::INT AS audio_idx, printf('clips/%d/%06d.jpg', clip_id, frame_idx) AS frame_path, x2::INT AS x2, CASE WHEN clip_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, (value < 5)::BIGINT AS flags FROM boxes WHERE x1 IS NOT NULL",
    "manifest_faults": f"WITH {BOXES}, f AS (SELECT CASE WHEN frame_idx % 10 = 2 THEN 'missing_key' WHEN frame_idx % 10 = 1 THEN 'bad_path' WHEN frame_idx % 10 = 4 THEN 'bad_bbox' WHEN x2 <= x1 OR y2 <= y1 THEN 'empty_bbox' WHEN frame_idx % 10 = 3 THEN 'bad_split' END AS fault FROM boxes WHERE x1 IS NOT NULL) SELECT fault, count(*) AS count FROM f WHERE fault IS NOT NULL GROUP BY 1",
    "snapshot_roundtrip": f"WITH {FRAMES} SELECT clip_id, count(*) AS rows, round(sum(value), 4) AS value FROM frames WHERE clip_id % 5 = 0 GROUP BY 1",
    "metrics_union": f"WITH {FRAMES} SELECT round(value, 2) AS loss, NULL::BIGINT AS psnr, event_id AS step FROM frames WHERE event_type = 'click' UNION ALL SELECT NULL, k, event_id FROM frames WHERE event_type = 'view'",
    "stage_cache_reuse": f"WITH {FRAMES}, a AS (SELECT count(DISTINCT clip_id) AS clips, count(*) AS frames FROM frames) SELECT r AS run, r = 1 AS hit, clips, frames FROM a, (SELECT unnest(range(3)) AS r)",
    "clip_cache": f"WITH {FRAMES}, a AS (SELECT count(DISTINCT clip_id) AS clips, count(DISTINCT clip_id) FILTER (clip_id % 10 = 3) AS odd, count(*) AS frames FROM frames) SELECT r AS run, CASE r WHEN 0 THEN 0 WHEN 1 THEN clips ELSE clips - odd END AS hits, CASE r WHEN 0 THEN clips WHEN 1 THEN 0 ELSE odd END AS misses, clips, frames FROM a, (SELECT unnest(range(3)) AS r)",
    "block_levels": f"WITH {FRAMES} SELECT clip_id, (frame_idx - 1) // 16 AS audio_idx, round(sqrt(sum(value * value) / 16), 6) AS level FROM frames GROUP BY 1, 2",
    "rounded_halves": f"WITH {FRAMES} SELECT event_id, round_even(k / 2, 0)::BIGINT AS half FROM frames",
}
