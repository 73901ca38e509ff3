"""Sinks (K1-K5, K7): partitioned split, Parquet, gzip line JSON, small CSV
append, sampled TSV extract."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_split(df: DataFrame, flag_col: str, path: str, mode: str = "overwrite") -> str:
    """One computed table, one write, split into ``flag=true``/``flag=false``
    directories (K1).  Readers filtering on the flag prune whole directories;
    the table is computed once, so no cache is needed."""
    df.write.mode(mode).option("compression", "zstd").partitionBy(flag_col).parquet(path)
    return path


def read_split(spark, path: str, flag_col: str) -> DataFrame:
    """Read a :func:`write_split` table; the partition flag comes back boolean."""
    from pyspark.sql import functions as F
    return spark.read.parquet(path).withColumn(flag_col, F.col(flag_col).cast("boolean"))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_json_gz(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 500_000) -> str:
    """Gzip-compressed line-delimited JSON (K3), at gzip's fastest level.  A
    gzip file is read by one task, so files hold a bounded number of rows
    however many a writing task has."""
    (df.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
       .option("maxRecordsPerFile", rows_per_file).json(path))
    return path


def append_small_csv(df: DataFrame, path: str) -> str:
    """Append a small metrics table as one CSV file with header (K4).  Only for
    tables whose size is bounded by their parameters (e.g. one row per k)."""
    df.coalesce(1).write.mode("append").option("header", "true").csv(path)
    return path


def write_sample_tsv(df: DataFrame, path: str, key_cols, k: int = 10_000, mode: str = "overwrite") -> str:
    """A sample of exactly ``k`` rows, by key hash, as one tab-separated file
    with header (K5).  One task writes the file, but it sees the sample only."""
    from ledgerlens.functions.keys import bottom_k
    bottom_k(df, key_cols, k).coalesce(1).write.mode(mode).option("sep", "\t").option("header", "true").csv(path)
    return path
