"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path

#: ASCII white space separates words; every other character belongs to one.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and continue from the files: lineage is cut, a lost executor loses
    nothing, and the planner sees the real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_chunks(column: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts of a column in runs of about ``size`` bytes, each with the place
    of its first: what a task makes of texts need not hold a whole batch."""
    first, held, n = 0, [], 0
    for text in column.cast(pa.binary()):
        held.append(text.as_py())
        n += len(held[-1] or b"")
        if n >= size:
            yield first, held
            first, held, n = first + len(held), [], 0
    if held:
        yield first, held


def give_back() -> None:
    """Return freed memory of a Python worker to its machine: Spark uses the
    worker again for later stages, beside their own needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def unit_hash(*cols) -> Column:
    """Uniform integer in [0, 2**40) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40))


def numbered(df: DataFrame, keys: list[str], order: list, out: str, rows_per_task: int = 200_000) -> DataFrame:
    """Number the rows of each key gaplessly from 0 without sending a key to
    one task: rows are numbered inside (key, hash slice) groups, and the
    slices' sizes give each its offset.  ``df`` must be cheap to read twice
    (a stored table)."""
    slices = 1 + df.count() // rows_per_task
    df = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    sizes = df.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order)
    return (df.withColumn(out, F.row_number().over(inside).cast("long") - 1)
              .join(sizes, [*keys, "__slice"])
              .withColumn(out, F.col(out) + F.col("__before")).drop("__slice", "__before"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected edges (a, b: long).

    Returns (node, component), component being the smallest node reachable.
    Alternating large-star and small-star steps: every step is one grouped
    minimum and one join on the node, and the edge table never grows beyond
    the number of links; each round is stored, so lineage stays flat."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, F.col("a") == F.col("node"))
                     .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        small = large.join(low, F.col("a") == F.col("node")).select("b", "a", "m")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(small.where("b = m").select("a", "b"))
                      .unionByName(small.where("b <> m").select("a", F.col("m").alias("b")))
                      .where("a <> b").distinct())
        new = stored(small, name)
        #: a forest of stars: no node is both a child and a centre, and no child has two centres
        state = new.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        twice = state.where("n > 1").limit(1).count()
        chained = new.join(new.select(F.col("a").alias("c")).distinct(), F.col("b") == F.col("c"), "left_semi").limit(1).count()
        edges = new
        if not twice and not chained:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                 .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
