"""A corpus pipeline: classify, deduplicate, redact, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of ``documents``. Stage by stage:

quality        rows that the classifier rejects go
ngram_join     of each component of near duplicates one row stays, that with its smallest doc_id
secrets        secrets in texts become [SECRET], and n_chars follows
mixing         each document appears as many times as the mix takes it
sentencepiece  ids of every text, and the digest of what they decode to
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import mixing, ngram_join, pieces, quality, secrets
from cadenza.llm.common import released, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_copies(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = pieces.encode_pieces(docs)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("ngram_join", ngram_join_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The classifier and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        released(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
