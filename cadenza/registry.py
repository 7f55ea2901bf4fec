"""The queries of the frame-series operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import io_queries, metric_queries, pairing_queries, parity_queries, sampling_queries, scalar_queries, series_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _family in (pairing_queries, series_queries, sampling_queries, metric_queries, scalar_queries, io_queries, parity_queries):
    QUERIES |= _family.QUERIES
    ORACLE_SQL |= _family.ORACLE_SQL
