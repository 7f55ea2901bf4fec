"""Typed readers: manifests, media listings, caches, boxes, and their checks."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.audio import pcm16_mono

MANIFEST = T.StructType([
    T.StructField("clip_id", T.StringType()), T.StructField("frame_idx", T.IntegerType()), T.StructField("audio_idx", T.IntegerType()), T.StructField("frame_path", T.StringType()),
    T.StructField("bnf_path", T.StringType()), T.StructField("bbox_xyxy", T.ArrayType(T.IntegerType())), T.StructField("split", T.StringType()), T.StructField("flags", T.ArrayType(T.StringType())),
])

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
OBSERVATION = T.StructType([
    T.StructField("frame_idx", T.IntegerType()), T.StructField("bbox_xyxy", T.ArrayType(T.IntegerType())), T.StructField("frame_width", T.IntegerType()), T.StructField("frame_height", T.IntegerType()),
    T.StructField("landmarks", T.MapType(T.StringType(), POINT)), T.StructField("pose", T.StructType([T.StructField(c, T.DoubleType()) for c in ("yaw", "pitch", "roll")])),
    T.StructField("face_blur", T.DoubleType()), T.StructField("mouth_blur", T.DoubleType()), T.StructField("mouth_open", T.DoubleType()), T.StructField("landmark_valid", T.BooleanType()),
    T.StructField("identity_embedding", T.ArrayType(T.FloatType())), T.StructField("bbox_continuity_valid", T.BooleanType()), T.StructField("reject_reason", T.StringType()),
])
VIDEO_SUFFIXES = ("mp4", "mov", "mkv")


def relative(path: Column) -> Column:
    """Whether a path is relative and stays inside its root."""
    return (path != "") & ~path.startswith("/") & ~F.exists(F.split(path, "/"), lambda p: p == "..")


def manifest_faults(df: DataFrame) -> DataFrame:
    """Rows that break the manifest's rules, with the first rule broken."""
    b = "bbox_xyxy"
    reason = (
        F.when(F.col("clip_id").isNull() | F.col("frame_idx").isNull() | F.col("audio_idx").isNull(), "missing_key").when(~F.coalesce(relative(F.col("frame_path")) & relative(F.col("bnf_path")), F.lit(False)), "bad_path")
        .when(F.coalesce(F.size(b), F.lit(0)) != 4, "bad_bbox").when((F.get(b, F.lit(2)) <= F.get(b, F.lit(0))) | (F.get(b, F.lit(3)) <= F.get(b, F.lit(1))), "empty_bbox")
        .when(~F.coalesce(F.col("split").isin("train", "val"), F.lit(False)), "bad_split")
    )
    return df.withColumn("fault", reason).where("fault is not null")


def read_manifest(spark: SparkSession, path: str, split: str | None = None, strict: bool = True) -> DataFrame:
    """JSON lines with the declared schema; malformed lines fail (strict) or are left out; blank lines are skipped."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    df = spark.read.schema(MANIFEST).option("mode", mode).json(path)
    return df.where(F.col("split") == split) if split else df


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OBSERVATION).option("mode", "FAILFAST").json(path)


def read_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON file that holds one list of objects."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_snapshot(spark: SparkSession, path: str, splits: tuple[str, ...] = ("train", "val")) -> DataFrame:
    """A published snapshot; every split has to be there and have rows."""
    df = spark.read.parquet(path)
    found = {r["split"] for r in df.groupBy("split").count().where("count > 0").collect()}  # a row per split
    if found != set(splits):
        raise ValueError(f"snapshot has splits {sorted(found)}, wanted {sorted(splits)}")
    return df


def split_tables(rows: DataFrame, splits: tuple[str, ...] = ("train", "val"), every: bool = True, order: tuple[str, ...] = ("clip_id", "frame_idx")) -> dict[str, DataFrame]:
    """A table per split, without the split column, clips one after the other in ``order``.

    With ``every`` each split has to have rows (a snapshot); else empty ones are left out and one has to be left
    (a processed set). Rows of other splits are in neither.
    """
    found = {r["split"] for r in rows.where(F.col("split").isin(*splits)).select("split").distinct().collect()}  # a row per split
    if not found or (every and found != set(splits)):
        raise ValueError(f"no rows for splits {sorted(set(splits) - found)}")
    return {s: rows.where(F.col("split") == s).drop("split").orderBy(*order) for s in splits if s in found}


def media_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES, recursive: bool = False, limit: int = 0) -> DataFrame:
    """(path, length, group): files with a suffix in any case, sorted; group is the first folder below root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root).select("path", "length")
    kept = found.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes))
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.regexp_replace(F.expr(f"substring(path, locate('{base}', path) + {len(base)})"), "^/+", "")
    grouped = kept.withColumn("group", F.when(F.contains(below, F.lit("/")), F.substring_index(below, "/", 1))).orderBy("path")
    return grouped.limit(limit) if limit else grouped


def read_waveforms(spark: SparkSession, path: str, rate: int = 16_000) -> DataFrame:
    """(path, samples array<float>) of 16-bit WAV files."""

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"path": part["path"], "samples": [pcm16_mono(c, rate) for c in part["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(decode, "path string, samples array<float>")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, values) of .npy matrices, a row per matrix row (higher axes flattened)."""

    def load(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, content in zip(part["path"], part["content"], strict=True):
                m = np.load(io.BytesIO(content), allow_pickle=False)
                m = m.reshape(len(m), -1).astype(np.float32)
                yield pd.DataFrame({"path": name, "row": np.arange(len(m)), "values": list(m)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(load, "path string, row long, values array<float>")


def read_boxes(spark: SparkSession, path: str, truncate: bool = False) -> DataFrame:
    """(frame_idx, x1, y1, x2, y2) from a JSON object of frame to [x1, x2, y1, y2]; halves to even, or truncated."""
    read = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<double>>")).alias("frame", "v"))
    whole = (lambda c: c.cast("long")) if truncate else (lambda c: F.rint(c).cast("long"))
    return read.select(F.regexp_extract("frame", r"(\d+)", 1).cast("long").alias("frame_idx"), *(whole(F.get("v", F.lit(i))).alias(n) for n, i in (("x1", 0), ("y1", 2), ("x2", 1), ("y2", 3))))


def one_source(local: str | None, remote: str | None) -> tuple[str, str]:
    """('local' or 'remote', value): exactly one has to be given."""
    if bool(local) == bool(remote):
        raise ValueError("give exactly one of a local path and a remote name")
    return ("local", local) if local else ("remote", remote)
