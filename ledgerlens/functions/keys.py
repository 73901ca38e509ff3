"""Reproducible row keys, hash-based samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def key_text(cols) -> Column:
    """Stable text form of a key: values joined by '|', null as ''."""
    return F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def hash_fraction(cols) -> Column:
    """A value in [0, 1) from the md5 of the key text: the same in every
    engine and under any partitioning (unlike ``rand``/``randomSplit``)."""
    h = F.conv(F.substring(F.md5(key_text(cols)), 1, 8), 16, 10).cast("bigint")
    return h / F.lit(4294967296.0)


def hash_sample(df: DataFrame, key_cols, frac: float = 0.25) -> DataFrame:
    """Reproducible Bernoulli-like sample keyed on ``key_cols``."""
    return df.where(hash_fraction(key_cols) < F.lit(frac))


def hash_split(df: DataFrame, key_cols, frac: float = 0.7):
    """Reproducible two-way split keyed on ``key_cols`` (O7): (first, second)."""
    u = hash_fraction(key_cols)
    return df.where(u < F.lit(frac)), df.where(u >= F.lit(frac))


def bottom_k(df: DataFrame, key_cols, k: int, out: str | None = None) -> DataFrame:
    """Exactly ``k`` rows (all if there are fewer): those with the smallest md5
    of their key, ties by the whole row (K5, O6).

    A uniform sample of exact size that any engine reproduces and that merges:
    the bottom k of a union is the bottom k of its parts' bottom k.  Only rows
    below a threshold are ordered.  It is set from the row count so that about
    ``k`` rows lie below it, and widened in the rare case that fewer do, so the
    table itself never meets in one task."""
    n = df.count()
    rows = df.withColumn("__h", F.md5(key_text(key_cols)))
    below = min(1.0, (k + 6 * math.sqrt(k) + 10) / max(n, 1))
    while below < 1:
        near = rows.where(F.col("__h") < f"{int(below * (1 << 32)):08x}")
        if near.count() >= k:
            rows = near
            break
        below *= 4
    rows = rows.orderBy("__h", *df.columns).limit(k)
    return rows.withColumnRenamed("__h", out) if out else rows.drop("__h")


def row_text(cols) -> Column:
    """Injective text form of a row: every value with its length in front,
    null as a mark of its own, so no two different rows have one text."""
    def part(c):
        t = _c(c).cast("string")
        return F.when(t.isNull(), F.lit("N")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t))
    return F.concat(*[part(c) for c in cols])


def add_surrogate_key(df: DataFrame, out: str = "row_id", chunk: int = 1 << 20) -> DataFrame:
    """Reproducible surrogate key: md5 of the row's values plus the ordinal of
    the row among rows equal on every column (P12).

    Rows equal on every column are indistinguishable, so any ordinal
    assignment among them yields the same set of (row, key) pairs, in any
    engine and under any partitioning.  The ordinal comes from counting equal
    rows (partial aggregation: a hot value costs one row per map task) and
    regenerating them.  Every group is cut into chunk numbers, which are dealt
    out before the ordinals of a chunk are made, so a value holding a third of
    the table is expanded by many tasks, ``chunk`` rows at a time.
    """
    cols = list(df.columns)
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    last = F.floor((F.col("__n") - 1) / chunk).cast("bigint")
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    chunks = chunks.repartition(*[F.col(c) for c in cols], F.col("__chunk"))
    rows = chunks.withColumn("__ord", F.explode(F.sequence(
        F.col("__chunk") * chunk + 1, F.least(F.col("__n"), (F.col("__chunk") + 1) * chunk))))
    text = F.concat(row_text(cols), F.lit("#"), F.col("__ord").cast("string"))
    return rows.withColumn(out, F.md5(text)).drop("__n", "__chunk", "__ord")
