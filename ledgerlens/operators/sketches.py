"""Distinct-count profiles kept as mergeable sketches.

A profile is a table of HyperLogLog sketches, one per (partition value,
column), with row and null counts.  It is made in one pass over its input: all
columns are summarised side by side, partially on the map side, so the shuffle
carries sketches, never values.  New data is profiled alone and appended; a
distinct count over any set of partitions is the union of their sketches, so
nothing is read twice.  ``compact`` folds the appended rows into one per
(partition, column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, IntegerType, LongType, StringType

from ledgerlens.operators.profile import _to_long
from ledgerlens.session import cut_lineage

#: 2 ** 12 registers: about 1.6 % standard error
LG_K = 12
SCHEMA = "part string, column_name string, sketch binary, n_rows long, n_nulls long"


def sketch_columns(df: DataFrame, cols=None, part: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """(part, column_name, sketch, n_rows, n_nulls): a sketch per column and
    value of ``part`` (all rows are one part without it)."""
    cols = list(cols or df.columns)
    own = F.col(part).cast("string") if part else F.lit(None).cast("string")
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(f"`{c}`")
        if not isinstance(df.schema[c].dataType, (IntegerType, LongType, StringType, BinaryType)):
            value = value.cast("string")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.hll_sketch_agg(value, lg_k).alias("sketch"), F.count(F.lit(1)).alias("n_rows"),
                             F.count_if(F.col(f"`{c}`").isNull()).alias("n_nulls")).alias(f"__s{i}"))
    wide = df.groupBy(own.alias("part")).agg(*aggs)
    return wide.select("part", F.explode(F.array(*(f"__s{i}" for i in range(len(cols))))).alias("s")).select("part", "s.*")


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches united per ``by`` (columns of the sketch table)."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"))


def append_profile(df: DataFrame, path: str, cols=None, part: str | None = None) -> None:
    """Profile new rows and add them to the stored profile; nothing stored is read."""
    sketch_columns(df, cols, part).write.mode("append").parquet(path)


def read_profile(spark: SparkSession, path: str, parts: list | None = None) -> DataFrame:
    """(column_name, approx_distinct, n_rows, n_nulls) over all partitions or the given ones."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if parts is not None:
        rows = rows.where(F.col("part").isin([str(p) for p in parts]))
    merged = merge_sketches(rows, "column_name")
    return merged.select("column_name", F.hll_sketch_estimate("sketch").alias("approx_distinct"), "n_rows", "n_nulls")


def compact_profile(spark: SparkSession, path: str, out: str) -> None:
    """The stored profile with one row per (partition, column), as a new table."""
    merge_sketches(spark.read.schema(SCHEMA).parquet(path), "column_name", "part").select("part", "column_name", "sketch", "n_rows", "n_nulls").write.parquet(out)


def exact_distinct(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, exact_distinct): what the sketches are held against.  Each
    column is grouped by itself, read alone from a stored table, and whole
    numbers, dates and texts as they are; columns without a value have no row."""
    out = []
    for c in list(cols or df.columns):
        value = F.col(f"`{c}`")
        if not isinstance(df.schema[c].dataType, (IntegerType, LongType, StringType, DateType)):
            value = value.cast("string")
        own = df.select(value.alias("value")).where("value is not null").distinct()
        out.append(own.agg(F.count(F.lit(1)).alias("exact_distinct")).select(F.lit(c).alias("column_name"), "exact_distinct").where("exact_distinct > 0"))
    return reduce(DataFrame.unionByName, out)


def profile_distinct(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, approx_distinct) of every column in one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LG_K)).alias(c) for c in cols))
    return _to_long(wide, cols, "approx_distinct")


def checked_profile(df: DataFrame, path: str, part: str, tolerance: float = 0.1) -> DataFrame:
    """The profile of ``df`` kept in two appended halves under ``path``, with
    what it promises as booleans: every estimate within ``tolerance`` of the
    exact count, and the halves' union equal to a profile made at once."""
    cols = df.columns
    half = F.pmod(F.xxhash64(*cols), F.lit(2))
    append_profile(df.where(half == 0), path, cols, part)
    append_profile(df.where(half == 1), path, cols, part)
    spark = df.sparkSession
    merged = cut_lineage(read_profile(spark, path), "profile")
    whole = cut_lineage(sketch_columns(df, cols), "profile-whole").select("column_name", F.hll_sketch_estimate("sketch").alias("at_once"))
    exact = exact_distinct(df, cols)
    rows = merged.join(whole, "column_name").join(exact, "column_name", "left").withColumn("exact_distinct", F.coalesce("exact_distinct", F.lit(0)))
    off = F.abs(F.col("approx_distinct") - F.col("exact_distinct"))
    # union keeps registers, not the order-dependent part of the estimator: equal up to its rounding
    same = F.abs(F.col("approx_distinct") - F.col("at_once")) <= 0.05 * F.col("at_once") + 1
    return rows.select("column_name", "n_rows", "n_nulls", "exact_distinct", (off <= tolerance * F.col("exact_distinct") + 1).alias("within_tolerance"), same.alias("halves_equal_whole"))
