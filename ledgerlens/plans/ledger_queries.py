"""Calendar, weekly aggregation, history and anomaly queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import backfill, value_for_year, week_index, year_index
from ledgerlens.operators import aggregate as agg
from ledgerlens.operators.history import explode_slots, history
from ledgerlens.operators.nulls import drop_nulls
from ledgerlens.plans import fixtures as fx
from ledgerlens.plans.registry import register
from ledgerlens.session import cut_lineage
from ledgerlens.sources.tables import table

EPOCH_SQL = f"DATE '{fx.TX_EPOCH}'"
HISTORY_N = 13

# ---------------------------------------------------------------- calendar


@register("calendar_index", sql=f"""
SELECT CAST(date_diff('day', {EPOCH_SQL}, CAST(l_shipdate AS DATE)) // 7 AS BIGINT) AS week_index,
       CAST(year(CAST(l_shipdate AS DATE)) - year({EPOCH_SQL}) AS BIGINT) AS year_index,
       count(*) AS n_rows, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty
FROM lineitem GROUP BY 1, 2
""")
def calendar_index(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return (li.groupBy(week_index("l_shipdate", fx.TX_EPOCH).alias("week_index"),
                       year_index("l_shipdate", fx.TX_EPOCH).alias("year_index"))
              .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty")))


# ------------------------------------------------------- population by year

_POP_SQL_PICK = ("CASE WHEN yi BETWEEN 0 AND 6 THEN [" + ", ".join(f"w.{c}" for c in fx.POP_COLS)
                 + "][yi + 1] END")


def tx_with_population(spark: SparkSession, d: str, ledger=fx.tx) -> DataFrame:
    """The ledger with its year's population (F7): a broadcast of the per-nation
    population table, whose size is bounded by the nation table (25 rows)."""
    t = ledger(spark, d)
    pw = F.broadcast(fx.pop_wide(spark, d))
    t = t.join(pw, "nation_key")
    yi = year_index("tx_date", fx.TX_EPOCH)
    return t.withColumn("year_index", yi).withColumn(
        "population", value_for_year("year_index", fx.POP_COLS)).drop(*fx.POP_COLS)


@register("population_for_year", sql=fx.with_ctes(f"""
SELECT nation_key, yi AS year_index, {_POP_SQL_PICK} AS population,
       count(*) AS n_rows
FROM (SELECT t.nation_key, CAST(year(t.tx_date) - year({EPOCH_SQL}) AS BIGINT) AS yi, w.*
      FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key) w
GROUP BY 1, 2, 3
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL))
def population_for_year(spark: SparkSession, d: str) -> DataFrame:
    t = tx_with_population(spark, d)
    return t.groupBy("nation_key", "year_index", "population").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("population_backfill", sql=fx.with_ctes(f"""
SELECT nation_key, yi AS year_index,
       CASE WHEN yi BETWEEN 0 AND 6 THEN [w.pop_y4, w.pop_y4, w.pop_y4, w.pop_y4, w.pop_y4,
                                           w.pop_y5, w.pop_y6][yi + 1] END AS population,
       count(*) AS n_rows
FROM (SELECT t.nation_key, CAST(year(t.tx_date) - year({EPOCH_SQL}) AS BIGINT) AS yi, w.*
      FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key) w
GROUP BY 1, 2, 3
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL))
def population_backfill(spark: SparkSession, d: str) -> DataFrame:
    """P8 + F7: the first four yearly columns copied from the fifth (as the
    reference copies 2010 into 2006-2009), then the row's year picked."""
    t = fx.tx(spark, d)
    pw = backfill(fx.pop_wide(spark, d), fx.POP_COLS[:4], fx.POP_COLS[4])
    t = t.join(F.broadcast(pw), "nation_key").withColumn(
        "year_index", year_index("tx_date", fx.TX_EPOCH))
    t = t.withColumn("population", value_for_year("year_index", fx.POP_COLS))
    return t.groupBy("nation_key", "year_index", "population").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------ weekly agg

WEEKLY_KEYS_SQL = f"""
  t.nation_key, t.nation, t.region, t.category,
  CAST(date_diff('day', {EPOCH_SQL}, t.tx_date) // 7 AS BIGINT) AS week_index,
  CAST(year(t.tx_date) - year({EPOCH_SQL}) AS BIGINT) AS year_index,
  {_POP_SQL_PICK.replace('yi', '(year(t.tx_date) - year(' + EPOCH_SQL + '))')} AS population,
  t.strength
"""

WEEKLY_SQL = f"""
SELECT {WEEKLY_KEYS_SQL},
  CAST(count(*) AS DOUBLE) AS order_count,
  sum(t.quantity) AS pill_count,
  sum(t.quantity * coalesce(t.strength, 1.0)) AS normalized_pill_count
FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key
GROUP BY ALL
"""

WEEKLY_RATE_SQL = """
SELECT *, CASE WHEN population IS NULL OR population = 0 THEN NULL
               ELSE pill_count / population END AS pill_count_per_capita
FROM weekly_base
"""


def weekly(spark: SparkSession, d: str) -> DataFrame:
    """Ledger aggregated per nation, category, week, year, population and
    strength (A1), with the per-capita rate (A2)."""
    t = tx_with_population(spark, d)
    keys = {"nation_key": "nation_key", "nation": "nation", "region": "region",
            "category": "category", "week_index": week_index("tx_date", fx.TX_EPOCH),
            "year_index": "year_index", "population": "population", "strength": "strength"}
    w = agg.period_agg(t, keys, qty="quantity", weight="strength")
    return w.withColumn("pill_count_per_capita", agg.rate("pill_count", "population"))


@register("weekly_agg", sql=fx.with_ctes(
    "SELECT * EXCLUDE (pill_count_per_capita) FROM weekly",
    tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL))
def weekly_agg(spark: SparkSession, d: str) -> DataFrame:
    return weekly(spark, d).drop("pill_count_per_capita")


@register("weekly_rate", sql=fx.with_ctes(
    "SELECT nation_key, category, week_index, year_index, strength, population, "
    "round(pill_count_per_capita, 9) AS pill_count_per_capita FROM weekly",
    tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL))
def weekly_rate(spark: SparkSession, d: str) -> DataFrame:
    w = weekly(spark, d)
    return w.select("nation_key", "category", "week_index", "year_index", "strength", "population",
                    F.round("pill_count_per_capita", 9).alias("pill_count_per_capita"))


# ---------------------------------------------------------------- history

HIST_ORDER_SQL = "week_index, year_index, strength NULLS FIRST"
_H_COLS = ", ".join(f"coalesce(h[{i + 1}], 0.0) AS h{i + 1}" for i in range(HISTORY_N))
HISTORY_SQL = fx.with_ctes(f"""
SELECT nation_key, category, week_index, year_index, strength,
       round(pill_count_per_capita, 9) AS pill_count_per_capita, {_H_COLS.replace('h[', 'hr[')}
FROM (SELECT *, list_transform(coalesce(hl, []), lambda x: round(x, 9)) AS hr FROM (
  SELECT *, list(pill_count_per_capita) OVER (
      PARTITION BY nation_key, category ORDER BY {HIST_ORDER_SQL}
      ROWS BETWEEN {HISTORY_N} PRECEDING AND 1 PRECEDING) AS hl
  FROM weekly
  WHERE nation_key IS NOT NULL AND nation IS NOT NULL AND region IS NOT NULL
    AND category IS NOT NULL AND week_index IS NOT NULL AND year_index IS NOT NULL
    AND population IS NOT NULL AND strength IS NOT NULL AND order_count IS NOT NULL
    AND pill_count IS NOT NULL AND normalized_pill_count IS NOT NULL
    AND pill_count_per_capita IS NOT NULL))
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL)


def weekly_history(spark: SparkSession, d: str, n: int = HISTORY_N) -> DataFrame:
    """E5: drop incomplete rows, then the per-(nation, category) lag list of
    the per-capita rate over the 13 preceding rows (W2, W3)."""
    w = drop_nulls(weekly(spark, d))
    return history(w, keys=["nation_key", "category"], order="week_index",
                   tie_break=("year_index", "strength"), value="pill_count_per_capita",
                   n=n, pad="right", out="history")


@register("history_window", sql=HISTORY_SQL)
def history_window(spark: SparkSession, d: str) -> DataFrame:
    h = weekly_history(spark, d)
    h = h.withColumn("history", F.transform("history", lambda x: F.round(x, 9)))
    h = h.select("nation_key", "category", "week_index", "year_index", "strength",
                 F.round("pill_count_per_capita", 9).alias("pill_count_per_capita"), "history")
    return explode_slots(h, "history", HISTORY_N)


# ------------------------------------------------------------- anomalies

PREDICTED_SQL = """
SELECT *, avg(pill_count) OVER (PARTITION BY category) AS predicted FROM weekly
"""


def predicted(spark: SparkSession, d: str) -> DataFrame:
    """Weekly aggregate with a group-mean predictor (the mean weekly quantity
    of the row's category): a stand-in for the forest, expressible in SQL."""
    # the weekly aggregate is read three times (means, rows, stddev): once written
    w = cut_lineage(weekly(spark, d))
    means = w.groupBy("category").agg(F.avg("pill_count").alias("predicted"))
    # one row per category: bounded by the category domain, not by the data
    return w.join(means, "category")


ANOM_SQL = """
SELECT p.* FROM predicted p CROSS JOIN (SELECT stddev_samp(pill_count) AS sigma FROM predicted) s
WHERE NOT (p.pill_count BETWEEN p.predicted - s.sigma AND p.predicted + s.sigma)
"""


@register("anomalies", sql=fx.with_ctes(
    "SELECT nation_key, category, week_index, year_index, strength, pill_count, "
    "round(predicted, 6) AS predicted FROM anomalies_t",
    tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL,
    predicted=PREDICTED_SQL, anomalies_t=ANOM_SQL))
def anomalies_q(spark: SparkSession, d: str) -> DataFrame:
    a = agg.anomalies(predicted(spark, d), "pill_count", "predicted", k_sigma=1.0)
    return a.select("nation_key", "category", "week_index", "year_index", "strength", "pill_count",
                    F.round("predicted", 6).alias("predicted"))


@register("ranked_anomalies", sql=fx.with_ctes("""
SELECT nation, count(*) AS anomalies_count,
       round(sum(abs(pill_count - predicted)), 4) AS delta
FROM anomalies_t GROUP BY nation ORDER BY anomalies_count DESC, nation ASC LIMIT 100
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL,
    predicted=PREDICTED_SQL, anomalies_t=ANOM_SQL))
def ranked_anomalies(spark: SparkSession, d: str) -> DataFrame:
    a = agg.anomalies(predicted(spark, d), "pill_count", "predicted", k_sigma=1.0)
    r = agg.rank_anomalies(a, "nation", "pill_count", "predicted", n=100)
    return r.withColumn("delta", F.round("delta", 4))


@register("rmse", sql=fx.with_ctes("""
SELECT round(sqrt(avg(power(pill_count - predicted, 2))), 6) AS rmse FROM predicted
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL,
    predicted=PREDICTED_SQL))
def rmse_q(spark: SparkSession, d: str) -> DataFrame:
    r = agg.rmse(predicted(spark, d), "pill_count", "predicted")
    return r.select(F.round("rmse", 6).alias("rmse"))
