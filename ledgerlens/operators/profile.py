"""Column profiling (A18, A20, O2, O5): each a single scan.  Distinct counts (A17) are in ``sketches``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage


def _to_long(wide: DataFrame, cols, value_name: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, {value_name})")


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct values (with row counts) of several low-cardinality columns in
    one pass (A18, O5): unpivot to (column_name, value) and aggregate."""
    cols = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("__kv")).select("__kv.*")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def ordered_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column in order (O2)."""
    return df.select(col).distinct().orderBy(col)


def placed(df: DataFrame, col: str, out: str = "place") -> DataFrame:
    """Ordered distinct values with their place from 1, by range partitions:
    a row's place is its place in its partition plus the sizes before."""
    rows = cut_lineage(df.repartitionByRange(col).sortWithinPartitions(col).withColumn("__p", F.spark_partition_id())
                         .withColumn("__i", F.monotonically_increasing_id()), "placed")
    sizes = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    # one row per partition
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out_rows = rows.join(before, "__p").withColumn(out, F.col("__before") + F.col("__i") - F.col("__first") + 1)
    return out_rows.select(out, *df.columns)


def describe(df: DataFrame, cols) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column (A20) as typed
    doubles in long form -- one aggregate, unlike ``describe()``'s strings."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`"
                      for c in cols)
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) AS (column_name, n, mean, stddev, min, max)")
