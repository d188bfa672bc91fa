"""Parquet tables at rest (the driver's test tables, or any table written by a sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of ``{sf_dir}/{name}.parquet``; callers select columns so the scan prunes."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
