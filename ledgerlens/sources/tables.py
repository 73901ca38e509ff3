"""Parquet table access (S5) and drifted multi-directory reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_drifted(spark: SparkSession, paths, merge_schema: bool = False) -> DataFrame:
    """Read several Parquet directories as one table whose files disagree on
    columns (T3).  Missing columns become null instead of silently taking the
    first file's schema.  ``merge_schema`` uses Parquet schema merging in one
    scan; otherwise each path is scanned and unioned by name."""
    paths = list(paths)
    if merge_schema:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    frames = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
