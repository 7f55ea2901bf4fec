"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import clusters, lexical, media, mixing, ngram_join, ngrams, personal, pieces, quality, secrets, sketch, suffixes, tokenids


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_media_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(_documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(_documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(_documents(spark, sf_dir))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(_documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_digests(_documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(_documents(spark, sf_dir))


def op11_yinyang_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media_features": op1_media_features,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_lm_scores": op5_lm_scores,
    "op6_secrets": op6_secrets,
    "op7_token_ids": op7_token_ids,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    "op11_yinyang_clusters": op11_yinyang_clusters,
    "op12_lexical_search": op12_lexical_search,
    "op13_personal_data": op13_personal_data,
}
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": ngram_join.ORACLE,
    "op3_suffix_dedup": suffixes.ORACLE,
    "op6_secrets": secrets.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op10_fingerprints": sketch.ORACLE,
    "op11_yinyang_clusters": clusters.ORACLE,
    "op12_lexical_search": lexical.ORACLE,
    "op13_personal_data": personal.ORACLE,
}
