"""Profiling, sampling, keys, null handling and file round-trip queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.calendar import week_index
from ledgerlens.functions.keys import add_surrogate_key, hash_fraction, hash_sample
from ledgerlens.operators import profile as pf
from ledgerlens.operators import sketches as sk
from ledgerlens.operators.nulls import drop_nulls, fill_nulls
from ledgerlens.plans import fixtures as fx
from ledgerlens.plans.ledger_queries import (EPOCH_SQL, WEEKLY_RATE_SQL, WEEKLY_SQL,
                                             tx_with_population, weekly)
from ledgerlens.plans.registry import register
from ledgerlens.session import scratch_path
from ledgerlens.sources.csv import scan_csv, scan_quarantined, write_csv
from ledgerlens.sources.sinks import write_parquet, write_sample_tsv
from ledgerlens.sources.tables import read_drifted, table


def _md5_frac_sql(expr: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


# ---------------------------------------------------------------- profile


_LEDGER_COLS = ("order_key", "line_no", "part_key", "supp_key", "cust_key", "tx_date", "quantity", "amount", "category", "brand", "part_name", "strength",
                "segment", "nation_key", "nation", "region", "priority", "status", "return_flag", "buyer_state", "buyer_county", "buyer_zip")


@register("profile_distinct", sql=fx.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS exact_distinct, "
    "TRUE AS within_tolerance, TRUE AS halves_equal_whole FROM tx" for c in _LEDGER_COLS), tx=fx.TX_SQL))
def profile_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Every ledger column profiled by mergeable sketches, kept per year
    in two appended halves, against the exact counts."""
    t = fx.tx(spark, d).withColumn("year", F.year("tx_date"))
    r = sk.checked_profile(t, scratch_path(spark, "ledger-profile"), "year")
    return r.where(F.col("column_name") != "year")


PROFILE_COLS = ("l_returnflag", "l_linestatus")


@register("profile_values", sql="SELECT column_name, value, count(*) AS n_rows FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem"
                               for c in PROFILE_COLS) + ") GROUP BY 1, 2")
def profile_values(spark: SparkSession, d: str) -> DataFrame:
    return pf.distinct_values(table(spark, d, "lineitem"), PROFILE_COLS)


DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("describe_stats", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in DESCRIBE_COLS))
def describe_stats(spark: SparkSession, d: str) -> DataFrame:
    r = pf.describe(table(spark, d, "lineitem"), DESCRIBE_COLS)
    return r.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


# --------------------------------------------------------------- sampling


@register("sample_extract", sql=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE {_md5_frac_sql('o_orderkey')} < 0.25
""")
def sample_extract(spark: SparkSession, d: str) -> DataFrame:
    """O6 + K5: reproducible 25 % sample keyed on the order key, written as a
    TSV extract and read back with a strict schema."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    s = hash_sample(o, ["o_orderkey"], 0.25)
    path = scratch_path(spark, "sample-tsv")
    write_csv(s, path, sep="\t")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    return scan_csv(spark, path, schema, sep="\t")


EXTRACT_ROWS = 1000


@register("sample_bottom_k", sql=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT {EXTRACT_ROWS}
""")
def sample_bottom_k(spark: SparkSession, d: str) -> DataFrame:
    """K5: a sample of an exact number of rows as one tab-separated file, read
    back with a strict schema."""
    path = scratch_path(spark, "bottom-k")
    write_sample_tsv(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, ["o_orderkey"], EXTRACT_ROWS)
    return scan_csv(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double", sep="\t")


@register("ordered_values", sql="SELECT row_number() OVER (ORDER BY p_type) AS place, p_type FROM (SELECT DISTINCT p_type FROM part)")
def ordered_values(spark: SparkSession, d: str) -> DataFrame:
    """O2: the distinct values of a column in order, with their places."""
    rows = pf.ordered_values(table(spark, d, "part"), "p_type")
    return pf.placed(rows, "p_type")


@register("hash_split", sql=f"""
SELECT CASE WHEN {_md5_frac_sql('o_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS side,
       count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1
""")
def hash_split_q(spark: SparkSession, d: str) -> DataFrame:
    """70/30 split by key hash -- the same under any partitioning."""
    o = table(spark, d, "orders")
    side = F.when(hash_fraction(["o_orderkey"]) < 0.7, "train").otherwise("test")
    return o.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.sum("o_orderkey").alias("key_sum"))


# ------------------------------------------------------------ surrogate key

SK_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _part_sql(c: str) -> str:
    t = f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN {c} IS NULL THEN 'N' ELSE CAST(length({t}) AS VARCHAR) || ':' || {t} END"


@register("surrogate_key", sql=f"""
SELECT {', '.join(SK_COLS)},
       md5({' || '.join(_part_sql(c) for c in SK_COLS)} || '#' ||
           CAST(row_number() OVER (PARTITION BY {', '.join(SK_COLS)}) AS VARCHAR)) AS row_id
FROM lineitem
""")
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    """Reproducible row id of the whole row = md5 of its values and the
    ordinal among equal rows."""
    li = table(spark, d, "lineitem").select(*SK_COLS)
    return add_surrogate_key(li, out="row_id")


# ------------------------------------------------------------------ nulls

#: the categories of a row, and its numbers: the fourteen columns of the clustering table
PREP_CATS = ("segment", "category", "region", "nation", "brand", "priority", "status", "return_flag", "line", "strength_label")
PREP_NUMS = ("week_index", "strength", "population", "quantity")
PREP_FILL = {**{c: "N/A" for c in PREP_CATS}, "strength": 0.0, "week_index": 0, "population": 0, "quantity": 0.0}


def clustering_prep(spark: SparkSession, d: str) -> DataFrame:
    """Project the clustering columns, calendar + population, fill nulls."""
    t = tx_with_population(spark, d)
    t = t.withColumns({"line": F.col("line_no").cast("string"), "strength_label": F.col("strength").cast("string"),
                       "week_index": week_index("tx_date", fx.TX_EPOCH)})
    return fill_nulls(t.select(*PREP_CATS, *PREP_NUMS), PREP_FILL)


PREP_SQL = f"""
SELECT {', '.join(f"coalesce({c}, 'N/A') AS {c}" for c in PREP_CATS if c not in ('line', 'strength_label'))},
       coalesce(CAST(line_no AS VARCHAR), 'N/A') AS line,
       coalesce(CAST(strength AS VARCHAR), 'N/A') AS strength_label,
       coalesce(CAST(date_diff('day', {EPOCH_SQL}, tx_date) // 7 AS BIGINT), 0) AS week_index,
       coalesce(strength, 0.0) AS strength,
       coalesce(CASE WHEN year(tx_date) - year({EPOCH_SQL}) BETWEEN 0 AND 6 THEN
         [w.pop_y0, w.pop_y1, w.pop_y2, w.pop_y3, w.pop_y4, w.pop_y5, w.pop_y6]
         [year(tx_date) - year({EPOCH_SQL}) + 1] END, 0) AS population,
       coalesce(quantity, 0.0) AS quantity
FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key
"""


@register("null_fill", sql=fx.with_ctes(PREP_SQL, tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL))
def null_fill(spark: SparkSession, d: str) -> DataFrame:
    return clustering_prep(spark, d)


@register("null_drop", sql=fx.with_ctes("""
SELECT nation_key, category, week_index, year_index, strength, pill_count FROM weekly
WHERE nation_key IS NOT NULL AND nation IS NOT NULL AND region IS NOT NULL
  AND category IS NOT NULL AND week_index IS NOT NULL AND year_index IS NOT NULL
  AND population IS NOT NULL AND strength IS NOT NULL AND order_count IS NOT NULL
  AND pill_count IS NOT NULL AND normalized_pill_count IS NOT NULL
  AND pill_count_per_capita IS NOT NULL
""", tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, weekly_base=WEEKLY_SQL, weekly=WEEKLY_RATE_SQL))
def null_drop(spark: SparkSession, d: str) -> DataFrame:
    """Weekly rows with any null dropped (null strength, zero population)."""
    w = drop_nulls(weekly(spark, d))
    return w.select("nation_key", "category", "week_index", "year_index", "strength", "pill_count")


# ------------------------------------------------------------- round trips

ORDERS_TEXT_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_note", T.StringType()),
])


@register("csv_strict_roundtrip", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_note,
       n_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def csv_strict_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as bzip2-compressed TSV (splittable) with
    null token 'null' and dates as MMddyyyy, nation as plain CSV; both read
    back strictly with explicit schemas and joined (through customer) again."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("o_note"))
    opath, npath = scratch_path(spark, "orders-tsv"), scratch_path(spark, "nation-csv")
    write_csv(o, opath, sep="\t", null_token="null", date_format="MMddyyyy", compression="bzip2")
    write_csv(table(spark, d, "nation"), npath)
    o2 = scan_csv(spark, opath, ORDERS_TEXT_SCHEMA, sep="\t", null_token="null",
                  date_format="MMddyyyy")
    n2 = scan_csv(spark, npath, "n_nationkey int, n_name string, n_regionkey int")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (o2.join(c, o2.o_custkey == c.c_custkey)
              .join(F.broadcast(n2), F.col("c_nationkey") == n2.n_nationkey)
              .select(*[f.name for f in ORDERS_TEXT_SCHEMA.fields], "n_name"))


@register("schema_drift_union", sql="""
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def schema_drift_union(spark: SparkSession, d: str) -> DataFrame:
    """Two Parquet directories from one table, the second without a
    column, read back as one table with the missing column null."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    a, b = scratch_path(spark, "drift-a"), scratch_path(spark, "drift-b")
    write_parquet(o.where(F.col("o_orderkey") % 2 == 0), a)
    write_parquet(o.where(F.col("o_orderkey") % 2 == 1).drop("o_orderpriority"), b)
    return read_drifted(spark, [a, b])


# ------------------------------------------------------------- quarantine

_BROKEN = {"amount": 83, "date": 89, "fields": 97}
_QUARANTINE_SQL = f"""
SELECT reason, count(*) AS n_rows, count(DISTINCT row_id) AS n_ids, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, sum(n_blank) AS n_blank FROM (
  SELECT CASE WHEN o_orderkey % {_BROKEN['fields']} = 0 THEN '5 fields of 6'
              WHEN o_orderkey % {_BROKEN['amount']} = 0 AND o_orderkey % {_BROKEN['date']} = 0 THEN 'unreadable: o_totalprice, o_orderdate'
              WHEN o_orderkey % {_BROKEN['amount']} = 0 THEN 'unreadable: o_totalprice'
              WHEN o_orderkey % {_BROKEN['date']} = 0 THEN 'unreadable: o_orderdate' ELSE 'ok' END AS reason,
         o_orderkey, o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS BIGINT) AS n_blank FROM orders) GROUP BY 1
"""


def write_broken_orders(spark: SparkSession, d: str) -> str:
    """Orders as bzip2 TSV with null tokens and planted bad records: a number
    that is none, a date that is none, a line cut by one field."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))
    key = F.col("o_orderkey")
    o = table(spark, d, "orders")
    fields = [text("o_orderkey"), text("o_custkey"), F.when(F.col("o_orderstatus") == "F", "null").otherwise(text("o_orderstatus")),
              F.when(key % _BROKEN["amount"] == 0, "12,5x").otherwise(text("o_totalprice")),
              F.when(key % _BROKEN["date"] == 0, "31312020").otherwise(F.date_format("o_orderdate", "MMddyyyy"))]
    cut = F.concat_ws("\t", *fields)
    whole = F.concat(cut, F.lit("\t"), text("o_orderpriority"))
    path = scratch_path(spark, "broken-orders")
    o.select(F.when(key % _BROKEN["fields"] == 0, cut).otherwise(whole).alias("value")).write.option("compression", "bzip2").text(path)
    return path


@register("quarantine_scan", sql=_QUARANTINE_SQL)
def quarantine_scan(spark: SparkSession, d: str) -> DataFrame:
    """Typed scan of delimited text; bad records go to a table of their own
    with file and reason, good ones are numbered and their nulls filled."""
    good, bad = scratch_path(spark, "orders-good"), scratch_path(spark, "orders-bad")
    scan_quarantined(spark, write_broken_orders(spark, d), ORDERS_TEXT_SCHEMA, good, bad, sep="\t", null_token="null", date_format="MMddyyyy",
                     header=False, fill={"o_orderstatus": ""})
    ok = spark.read.parquet(good).select(F.lit("ok").alias("reason"), "row_id", "o_orderkey", (F.col("o_orderstatus") == "").cast("long").alias("blank"))
    line = F.split("line", "\t")
    out = spark.read.parquet(bad).select("reason", F.get(line, 0).cast("long").alias("row_id"), F.get(line, 0).cast("long").alias("o_orderkey"),
                                         (F.get(line, 2) == "null").cast("long").alias("blank"))
    return ok.unionByName(out).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids"),
                                                     F.sum("o_orderkey").alias("key_sum"), F.sum("blank").alias("n_blank"))
