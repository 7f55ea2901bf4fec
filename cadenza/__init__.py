"""Spark-native analytics over ordered per-clip frame series."""
