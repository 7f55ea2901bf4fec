"""Writers: manifests, snapshots with atomic publishing, decisions, metrics, stage caches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    """(file system, Path class) that holds a path: works for any store Spark can write to."""
    jvm = spark._jvm
    cls = jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark._jsc.hadoopConfiguration()), cls


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small driver-side file: written beside its target, then renamed over it in one step."""
    fs, cls = _fs(spark, path)
    part = cls(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(cls(path)), over)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_text(spark, path, json.dumps(value, sort_keys=True, indent=2, default=str))


def publish(spark: SparkSession, staged: str, live: str) -> None:
    """Swap a staged directory in; the one before it is kept until the swap is done and put back if it fails."""
    fs, cls = _fs(spark, live)
    if not fs.exists(cls(staged)):
        raise OSError(f"nothing staged at {staged}")
    previous = cls(f"{live}.previous")
    fs.delete(previous, True)
    had = fs.exists(cls(live))
    if had and not fs.rename(cls(live), previous):
        raise OSError(f"could not set {live} aside")
    if not fs.rename(cls(staged), cls(live)):
        if had:
            fs.rename(previous, cls(live))
        raise OSError(f"could not publish {live}")
    fs.delete(previous, True)


def write_manifest(rows: DataFrame, root: str) -> dict[str, int]:
    """JSON lines under ``manifest`` and row counts by split in splits.json."""
    rows.write.mode("overwrite").json(f"{root}/manifest")
    counts = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}  # a row per split
    write_json(rows.sparkSession, f"{root}/splits.json", counts)
    return counts


def write_snapshot(rows: DataFrame, live: str, clip: str = "clip_id") -> None:
    """Parquet by split, staged beside the live directory and then swapped in.

    Clips are dealt to the shuffle's partitions and sorted there: a clip lies in one file, and its
    row groups' statistics prune the others. The number of files goes with the cluster, not with the clips.
    """
    staged = f"{live}.building-{uuid.uuid4().hex}"
    rows.repartition("split", clip).sortWithinPartitions("split", clip).write.partitionBy("split").parquet(staged)
    publish(rows.sparkSession, staged, live)


def write_decisions(decisions: DataFrame, path: str) -> None:
    """One row per frame; an empty table keeps its schema."""
    decisions.write.mode("overwrite").parquet(path)


def write_metrics(tables: list[DataFrame], path: str) -> DataFrame:
    """Rows of several tables under the sorted union of their columns, as CSV with a header."""
    merged = tables[0]
    for t in tables[1:]:
        merged = merged.unionByName(t, allowMissingColumns=True)
    merged = merged.select(*sorted(merged.columns))
    merged.write.mode("overwrite").option("header", True).csv(path)
    return merged


def config_hash(config: dict) -> str:
    import hashlib

    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def cached(spark: SparkSession, root: str, stage: str, key: dict, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """(result, hit): a stage's Parquet under the hash of its inputs and version; built and published once."""
    live = f"{root}/{stage}/{config_hash(key)}"
    fs, cls = _fs(spark, live)
    if fs.exists(cls(f"{live}/_SUCCESS")):
        return spark.read.parquet(live), True
    staged = f"{live}.building-{uuid.uuid4().hex}"
    build().write.parquet(staged)
    publish(spark, staged, live)
    return spark.read.parquet(live), False


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The finished tables below a folder, by name. They are read by these names: Spark takes two scans of one folder for the same, though files came in between."""
    fs, cls = _fs(spark, path)
    found = [f.getPath().toString() for f in fs.listStatus(cls(path))] if fs.exists(cls(path)) else []
    return sorted(x for x in found if fs.exists(cls(f"{x}/_SUCCESS")))


def cached_clips(spark: SparkSession, root: str, stage: str, clips: DataFrame, settings: dict, compute: Callable[[DataFrame], DataFrame], clip: str = "clip_id", digest: str = "digest", batches: int = 4) -> tuple[DataFrame, dict[str, int]]:
    """(rows of all ``clips``, {"hits", "misses"}) of a stage that works clip by clip.

    ``clips`` has a row per clip with the digest of its input; ``compute`` gets such rows and gives any number of rows
    with the clip's column. An entry is known by clip, digest and settings (with the stage's version among them), so
    only new or changed clips are computed. They are computed in ``batches`` by a hash of the clip, and each batch is
    kept before the next begins: a run that fails leaves its finished batches for the next one. Rows are written
    before the list that makes them count, and rows of a batch that isn't listed are never read.
    """
    base, known = f"{root}/{stage}/{config_hash(settings)}", clips.select(clip, digest).dropna().distinct()
    finished = _runs(spark, f"{base}/done")
    todo = known.join(spark.read.parquet(*finished), [clip, digest], "left_anti") if finished else known
    counts = {"hits": known.count(), "misses": todo.count()}
    counts["hits"] -= counts["misses"]
    for i in range(batches if counts["misses"] else 0):
        part = todo.where(F.pmod(F.xxhash64(F.col(clip).cast("string")), F.lit(batches)) == i)
        if part.isEmpty():
            continue
        run = uuid.uuid4().hex
        compute(part).withColumn("run", F.lit(run)).write.parquet(f"{base}/rows/{run}")
        part.select(clip, digest, F.lit(run).alias("run")).write.parquet(f"{base}/done/{run}")
    finished = _runs(spark, f"{base}/done")
    if not finished:
        return compute(known), counts  # no clips: an empty table with the stage's columns
    # a clip may be listed twice if two runs met; one of its entries counts
    current = known.join(spark.read.parquet(*finished), [clip, digest]).groupBy(clip).agg(F.min("run").alias("run"))
    rows = spark.read.parquet(*(f"{base}/rows/{path.rsplit('/', 1)[-1]}" for path in finished))
    return rows.join(current, [clip, "run"]).drop("run"), counts
