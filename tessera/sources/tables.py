"""Parquet inputs (the driver's tables). Column pruning and filters reach the
scan because every caller selects only what it uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """``{root}/{name}.parquet``, optionally projected to ``columns``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
