"""Grouped aggregates, rates and model-quality metrics.

All are single declarative plans: partial aggregation on the map side, one
shuffle on the group keys, no driver round trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def rate(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with null for a zero or null denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def period_agg(df: DataFrame, keys: dict, qty: str, weight: str | None = None,
               default_weight: float = 1.0, count_col: str = "order_count",
               sum_col: str = "pill_count", weighted_col: str = "normalized_pill_count") -> DataFrame:
    """Group by named key expressions; count (as double), sum and weighted sum
    ``sum(qty * coalesce(weight, default))`` (A1, F8-F10).  A null weight is
    both its own group (when it is a key) and weight ``default_weight``."""
    grouped = df.groupBy(*[_c(v).alias(k) for k, v in keys.items()])
    aggs = [F.count(F.lit(1)).cast("double").alias(count_col),
            F.sum(_c(qty)).alias(sum_col)]
    if weight is not None:
        aggs.append(F.sum(_c(qty) * F.coalesce(_c(weight), F.lit(default_weight))).alias(weighted_col))
    return grouped.agg(*aggs)


def split_counts(df: DataFrame, flag: str, qty: str) -> DataFrame:
    """Rows and quantity per flag value."""
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n_rows"),
                                F.sum(_c(qty)).alias("sum_qty"))


def reconcile_counts(labelled: dict) -> DataFrame:
    """Union of labelled row counts (A22): {label: DataFrame} -> (table, n_rows).
    One job; each count is a partial aggregate of its own input."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("table"), "n_rows")
              for k, df in labelled.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def anomalies(df: DataFrame, y: str, yhat: str, k_sigma: float = 1.0) -> DataFrame:
    """Rows whose actual lies outside ``yhat +/- k * stddev_samp(y)`` (A12, P4,
    M15).  The standard deviation is a one-row aggregate evaluated in the same
    plan as a scalar subquery instead of a driver collect."""
    sigma = df.agg(F.stddev_samp(_c(y))).scalar()
    band = F.lit(k_sigma) * sigma
    return df.where(~_c(y).between(_c(yhat) - band, _c(yhat) + band))


def rank_anomalies(df: DataFrame, key: str, y: str, yhat: str, n: int = 100,
                   count_col: str = "anomalies_count", delta_col: str = "delta") -> DataFrame:
    """Count and total absolute residual per key, top ``n`` by count with the
    key as tie-break (A13, O1): a TakeOrderedAndProject, not a full sort."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col),
                            F.sum(F.abs(_c(y) - _c(yhat))).alias(delta_col))
    return g.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(n)


def rmse(df: DataFrame, y: str, yhat: str, out: str = "rmse") -> DataFrame:
    """Root mean squared error as one aggregate."""
    return df.agg(F.sqrt(F.avg(F.pow(_c(y) - _c(yhat), 2))).alias(out))


def weighted_entropy(df: DataFrame, cluster: str, label: str, out: str = "weighted_entropy") -> DataFrame:
    """Size-weighted label entropy within clusters, over all rows, natural log
    (A15, F12).  Two-level aggregate: (cluster, label) counts, then per-cluster
    sums of ``-n_l ln(n_l / n_c)``; no group is ever materialised in memory,
    so one cluster holding a third of the rows costs nothing extra."""
    cl = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("__n"))
    w = cl.groupBy(cluster).agg(F.sum("__n").alias("__nc"),
                                F.sum(F.col("__n") * F.ln(F.col("__n"))).alias("__s"))
    # sum_l -n_l ln(n_l/n_c) = n_c ln n_c - sum_l n_l ln n_l
    per = w.select((F.col("__nc") * F.ln(F.col("__nc")) - F.col("__s")).alias("__h"),
                   F.col("__nc"))
    return per.agg((F.sum("__h") / F.sum("__nc")).alias(out))
