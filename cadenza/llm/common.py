"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Give back the shuffle files of plans that nothing holds any more.

    Spark deletes them when the driver's JVM collects their handles, which a driver with memory to spare puts off while disks fill.
    """
    gc.collect()
    spark._jvm.System.gc()


#: Both sides hold a batch of texts, which can be long.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "5000"}


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches between the JVM and Python, unless the session's owner has set their size."""
    for name in BATCHES.keys() - spark.conf.getAll.keys():
        spark.conf.set(name, BATCHES[name])


def plain_docs(documents: DataFrame) -> DataFrame:
    """(doc_id long, text string without nulls); every other column is left behind."""
    bounded_batches(documents.sparkSession)
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def keyed_docs(documents: DataFrame) -> DataFrame:
    """Like plain_docs, for operators that join on doc_id: rows without doc_id are left out."""
    return plain_docs(documents).where("doc_id is not null")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt anew where there are fewer partitions than cores: texts cost more to work on than to move.

    An input of many files or row groups is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def packed(documents: DataFrame) -> DataFrame:
    """(kept struct of all columns but text, doc_id long, text string): work beside columns of any name."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    return documents.select(F.struct(*others).alias("kept"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns that ``packed`` put away, some of them replaced."""
    own = {"text": F.col("text")} | replaced
    return df.select(*(own.get(c, F.col("kept").getField(c)).alias(c) for c in columns))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]


def block_count(docs: DataFrame, mb: float) -> int:
    """How many blocks of about ``mb`` MB of text the documents make."""
    return max(1, -(-text_bytes(docs) // int(mb * 1_000_000)))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column back to back, and the n + 1 offsets into them."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII white space: (distinct words, index into them for every word, words per row)."""
    column = column.cast(pa.large_string())
    if not len(column):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    full = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        row = np.repeat(np.arange(len(lengths)), lengths)[full]
        values = values.filter(pa.array(full))
        lengths = np.bincount(row, minlength=len(lengths)).astype(np.int64)
    coded = values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string: a polynomial over its bytes, then mixed."""
    data, offsets = string_bytes(words)
    if not len(words):
        return np.zeros(0, np.uint64)
    starts, ends = offsets[:-1], offsets[1:]
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    longest = int((ends - starts).max(initial=1))
    weights = np.cumprod(np.full(longest, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    terms = mixed(data.astype(np.uint64) + np.uint64(1)) * weights[place]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))


def planes(x: np.ndarray, width: int | None = None) -> bytes:
    """The low ``width`` bytes of fixed-width numbers, plane by plane: slowly changing high bytes compress well."""
    width = width or x.dtype.itemsize
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.dtype.itemsize)[:, :width].T).tobytes()


def unplanes(data: bytes, dtype, width: int | None = None) -> np.ndarray:
    full = np.dtype(dtype).itemsize
    width = width or full
    out = np.zeros((len(data) // width, full), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view(dtype).reshape(-1)


def one_per_id(docs: DataFrame) -> DataFrame:
    """Of rows with equal doc_id only the smallest text stays. Costs a count of ids where none repeats."""
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    return docs.groupBy("doc_id").agg(F.min("text").alias("text"))


def gathered(batches: Iterator[pa.RecordBatch], least: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold at least ``least`` bytes of a string column."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size or held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
