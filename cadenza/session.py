"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "cadenza", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="cadenza-src-"), "cadenza.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir, which driver and executors share.

    Where that is unset, a temporary folder does on a local master; on a cluster its executors would
    each write to a disk of their own, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cadenza-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cadenza-{spark.sparkContext.applicationId}"


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark can write to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_shared(spark: SparkSession) -> None:
    """Delete the tables that this application's queries have written; results not yet read are lost with them."""
    removed(spark, shared_dir(spark))
