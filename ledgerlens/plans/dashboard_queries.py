"""Export documents and dashboard panel queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.geo import geohash_sql
from ledgerlens.functions.calendar import week_index
from ledgerlens.operators import dashboard as db
from ledgerlens.plans import fixtures as fx
from ledgerlens.plans.ledger_queries import EPOCH_SQL, _POP_SQL_PICK, tx_with_population
from ledgerlens.plans.registry import register
from ledgerlens.session import scratch_path
from ledgerlens.sources.sinks import write_json_gz
from ledgerlens.sources.tables import table

# reference panels use a 7-year window with an 8-hour offset; ours covers the
# fixture's years and stops before 2001 so the filter removes rows
TIME_LO = "1995-01-01 08:00:00"
TIME_HI = "2001-01-01 08:00:00"
HIST_DAYS = 30
BBOX = (60.0, -190.0, -40.0, 20.0)  # top, left (wraps past the date line), bottom, right
PHRASES = ("ECONOMY", "SMALL")
SELECTED = ("NATION_1", "NATION_3", "NATION_5", "NATION_7")
NESTED = (("category", 5), ("segment", 6), ("nation", 20))

DOC_COLS = ["doc_id", "order_key", "line_no", "part_key", "cust_key", "tx_date", "quantity",
            "amount", "category", "segment", "nation_key", "nation", "region", "strength",
            "state_county", "population", "longitude", "latitude"]


def docs(spark: SparkSession, d: str, ledger=fx.tx) -> DataFrame:
    """The exported document table: ledger + population + coordinates.  The
    texts put together from other columns come after the joins: large tables
    shuffle there."""
    e = db.export_documents(tx_with_population(spark, d, ledger), fx.geo(spark, d), "cust_key")
    e = e.withColumn("doc_id", F.concat_ws("-", "order_key", "line_no", "part_key", "supp_key")) \
         .withColumn("state_county", F.concat("region", F.lit("/"), "nation"))
    return e.select(*DOC_COLS)


DOCS_SQL = f"""
SELECT concat_ws('-', t.order_key, t.line_no, t.part_key, t.supp_key) AS doc_id,
       t.order_key, t.line_no, t.part_key, t.cust_key, t.tx_date, t.quantity, t.amount,
       t.category, t.segment, t.nation_key, t.nation, t.region, t.strength,
       t.region || '/' || t.nation AS state_county,
       {_POP_SQL_PICK.replace('yi', '(year(t.tx_date) - year(' + EPOCH_SQL + '))')} AS population,
       g.lon AS longitude, g.lat AS latitude
FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key
JOIN geo g ON t.cust_key = g.cust_key
"""


def _sql(body: str) -> str:
    return fx.with_ctes(body, tx=fx.TX_SQL, pop_wide=fx.POP_WIDE_SQL, geo=fx.GEO_SQL,
                        docs=DOCS_SQL)


@register("export_documents", sql=_sql("SELECT * FROM docs"))
def export_documents(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d)


DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("order_key", T.LongType()),
    T.StructField("line_no", T.LongType()), T.StructField("part_key", T.LongType()),
    T.StructField("cust_key", T.LongType()), T.StructField("tx_date", T.DateType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("amount", T.DoubleType()),
    T.StructField("category", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("nation_key", T.LongType()), T.StructField("nation", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("strength", T.DoubleType()),
    T.StructField("state_county", T.StringType()), T.StructField("population", T.LongType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
])


@register("export_json_roundtrip", sql=_sql("SELECT * FROM docs"))
def export_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K3: documents written as gzip line JSON, read back with the schema."""
    path = scratch_path(spark, "export-json")
    write_json_gz(docs(spark, d, ledger=fx.tx_once), path)
    return spark.read.schema(DOC_SCHEMA).json(path)


INDEX_MAPPING = {"doc_id": "keyword", "category": "keyword", "segment": "keyword",
                 "nation": "keyword", "state_county": "keyword", "quantity": "float",
                 "amount": "float", "strength": "float", "population": "bigint",
                 "tx_date": "date", "location": "geo_point"}


@register("index_projection", sql=_sql("""
SELECT doc_id, category, segment, nation, state_county, CAST(quantity AS FLOAT) AS quantity,
       CAST(amount AS FLOAT) AS amount, CAST(strength AS FLOAT) AS strength, population, tx_date,
       CAST(latitude AS FLOAT) AS location_lat, CAST(longitude AS FLOAT) AS location_lon
FROM docs
"""))
def index_projection(spark: SparkSession, d: str) -> DataFrame:
    """Schema-enforcing projection with narrowing casts; the geo point
    struct is flattened only for comparison."""
    ix = db.to_index_docs(docs(spark, d), INDEX_MAPPING)
    return ix.select(*[c for c in ix.columns if c != "location"],
                     F.col("location.lat").alias("location_lat"),
                     F.col("location.lon").alias("location_lon"))


@register("kpi_total", sql=_sql("SELECT sum(quantity) AS sum_qty, count(*) AS n_rows FROM docs"))
def kpi_total(spark: SparkSession, d: str) -> DataFrame:
    return db.kpi(docs(spark, d), "quantity")


@register("kpi_filtered", sql=_sql("SELECT " + ", ".join(
    f"sum(CASE WHEN category = '{v}' THEN quantity END) AS sum_{v.lower()}, "
    f"count(CASE WHEN category = '{v}' THEN 1 END) AS n_{v.lower()}" for v in PHRASES)
    + " FROM docs"))
def kpi_filtered(spark: SparkSession, d: str) -> DataFrame:
    return db.kpi_filtered(docs(spark, d), "quantity", "category", PHRASES)


@register("top_n_terms", sql=_sql(
    "SELECT nation, sum(quantity) AS sum_qty FROM docs GROUP BY nation "
    "ORDER BY sum_qty DESC, nation LIMIT 10"))
def top_n_terms(spark: SparkSession, d: str) -> DataFrame:
    return db.top_n(docs(spark, d), "nation", "quantity", 10)


@register("selector_terms", sql=_sql(
    "SELECT segment, count(*) AS n_rows FROM docs GROUP BY segment "
    "ORDER BY n_rows DESC, segment LIMIT 5"))
def selector_terms(spark: SparkSession, d: str) -> DataFrame:
    return db.top_terms_by_count(docs(spark, d), "segment", 5)


@register("selector_filter", sql=_sql(
    "SELECT nation, category, sum(quantity) AS sum_qty, count(*) AS n_rows FROM docs "
    "WHERE nation IN (" + ", ".join(f"'{v}'" for v in SELECTED) + ") GROUP BY 1, 2"))
def selector_filter(spark: SparkSession, d: str) -> DataFrame:
    f = db.selector_filter(docs(spark, d), "nation", SELECTED)
    return db.kpi(f, "quantity", by=["nation", "category"])


def _hist_sql(by: str, size: int, days: int) -> str:
    return _sql(f"""
SELECT DATE '1970-01-01' + CAST(floor(date_diff('day', DATE '1970-01-01', tx_date) / {days}) * {days}
       AS INTEGER) AS bucket_start, d.{by}, sum(quantity) AS sum_qty, count(*) AS n_rows
FROM docs d
JOIN (SELECT {by} FROM docs
      WHERE CAST(tx_date AS TIMESTAMP) >= TIMESTAMP '{TIME_LO}'
        AND CAST(tx_date AS TIMESTAMP) < TIMESTAMP '{TIME_HI}'
      GROUP BY {by} ORDER BY sum(quantity) DESC, {by} LIMIT {size}) top USING ({by})
WHERE CAST(tx_date AS TIMESTAMP) >= TIMESTAMP '{TIME_LO}'
  AND CAST(tx_date AS TIMESTAMP) < TIMESTAMP '{TIME_HI}'
GROUP BY 1, 2
""")


@register("date_histogram_terms", sql=_hist_sql("category", 5, HIST_DAYS))
def date_histogram_terms(spark: SparkSession, d: str) -> DataFrame:
    """A6 + P15: 30-day buckets x top 5 categories inside the time range."""
    r = db.time_range(docs(spark, d), "tx_date", TIME_LO, TIME_HI)
    return db.date_histogram(r, "tx_date", "quantity", "category", HIST_DAYS, 5)


@register("date_histogram_bucket_terms", sql=_sql(f"""
SELECT bucket_start, category, sum_qty, n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket_start ORDER BY sum_qty DESC, category) AS rk
  FROM (SELECT DATE '1970-01-01' + CAST(floor(date_diff('day', DATE '1970-01-01', tx_date) / {HIST_DAYS})
                 * {HIST_DAYS} AS INTEGER) AS bucket_start, category,
               sum(quantity) AS sum_qty, count(*) AS n_rows
        FROM docs
        WHERE CAST(tx_date AS TIMESTAMP) >= TIMESTAMP '{TIME_LO}'
          AND CAST(tx_date AS TIMESTAMP) < TIMESTAMP '{TIME_HI}'
        GROUP BY 1, 2)) WHERE rk <= 3
"""))
def date_histogram_bucket_terms(spark: SparkSession, d: str) -> DataFrame:
    """A6 with the terms nested under the histogram: the top 3 categories of
    each 30-day bucket."""
    r = db.time_range(docs(spark, d), "tx_date", TIME_LO, TIME_HI)
    return db.date_histogram(r, "tx_date", "quantity", "category", HIST_DAYS, 3, rank_within="bucket")


def _auto_days() -> int:
    from datetime import datetime
    span = (datetime.fromisoformat(TIME_HI) - datetime.fromisoformat(TIME_LO)).days
    return db.auto_interval(span, target_buckets=100)


@register("timeseries_terms", sql=_hist_sql("nation", 10, _auto_days()))
def timeseries_terms(spark: SparkSession, d: str) -> DataFrame:
    """Automatic interval for the range, split by the top 10 nations."""
    r = db.time_range(docs(spark, d), "tx_date", TIME_LO, TIME_HI)
    return db.date_histogram(r, "tx_date", "quantity", "nation", _auto_days(), 10)


def _nested_sql() -> str:
    (c1, k1), (c2, k2), (c3, k3) = NESTED
    return _sql(f"""
, l1 AS (SELECT {c1}, sum(quantity) AS sum_{c1} FROM docs GROUP BY 1
         ORDER BY sum_{c1} DESC, {c1} LIMIT {k1}),
l2 AS (SELECT * FROM (SELECT {c1}, {c2}, sum_{c2},
         row_number() OVER (PARTITION BY {c1} ORDER BY sum_{c2} DESC, {c2}) AS rk
       FROM (SELECT d.{c1}, d.{c2}, sum(quantity) AS sum_{c2} FROM docs d
             WHERE d.{c1} IN (SELECT {c1} FROM l1) GROUP BY 1, 2)) WHERE rk <= {k2}),
l3 AS (SELECT * FROM (SELECT {c1}, {c2}, {c3}, sum_{c3},
         row_number() OVER (PARTITION BY {c1}, {c2} ORDER BY sum_{c3} DESC, {c3}) AS rk
       FROM (SELECT d.{c1}, d.{c2}, d.{c3}, sum(quantity) AS sum_{c3} FROM docs d
             WHERE ({c1}, {c2}) IN (SELECT ({c1}, {c2}) FROM l2) GROUP BY 1, 2, 3)) WHERE rk <= {k3})
SELECT l1.{c1}, l1.sum_{c1}, l2.{c2}, l2.sum_{c2}, l3.{c3}, l3.sum_{c3}
FROM l1 JOIN l2 USING ({c1}) JOIN l3 USING ({c1}, {c2})
""").replace("\n\n, l1", ", l1").replace(")\n, l1", "),\nl1")


@register("nested_terms", sql=_nested_sql())
def nested_terms(spark: SparkSession, d: str) -> DataFrame:
    """Category (5) -> segment (6) -> nation (20), each by sum within its parent."""
    return db.nested_top_k(docs(spark, d), "quantity", NESTED)


@register("geo_grid", sql=_sql(f"""
SELECT {geohash_sql('latitude', 'longitude', 3)} AS cell, sum(quantity) AS sum_qty,
       count(*) AS n_rows, round(avg(latitude), 6) AS centroid_lat,
       round(avg(longitude), 6) AS centroid_lon
FROM docs GROUP BY 1
"""))
def geo_grid(spark: SparkSession, d: str) -> DataFrame:
    g = db.geo_grid(docs(spark, d), "latitude", "longitude", "quantity", precision=3)
    return g.withColumn("centroid_lat", F.round("centroid_lat", 6)) \
            .withColumn("centroid_lon", F.round("centroid_lon", 6))


@register("geo_grid_bbox", sql=_sql(f"""
SELECT {geohash_sql('latitude', 'longitude', 5)} AS cell, sum(quantity) AS sum_qty,
       count(*) AS n_rows, round(avg(latitude), 6) AS centroid_lat,
       round(avg(longitude), 6) AS centroid_lon
FROM docs
WHERE latitude BETWEEN {BBOX[2]} AND {BBOX[0]}
  AND (longitude >= {((BBOX[1] + 180) % 360) - 180} OR longitude <= {((BBOX[3] + 180) % 360) - 180})
GROUP BY 1
"""))
def geo_grid_bbox(spark: SparkSession, d: str) -> DataFrame:
    """A10 + P16: fine heat-map grid inside a map extent that wraps the date line."""
    g = db.geo_grid(docs(spark, d), "latitude", "longitude", "quantity", precision=5, bbox=BBOX)
    return g.withColumn("centroid_lat", F.round("centroid_lat", 6)) \
            .withColumn("centroid_lon", F.round("centroid_lon", 6))


@register("choropleth", sql=_sql("""
SELECT CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name,
       coalesce(a.sum_qty, 0.0) AS sum_qty, coalesce(a.n_rows, 0) AS n_rows
FROM nation n LEFT JOIN (SELECT nation_key, sum(quantity) AS sum_qty, count(*) AS n_rows
                         FROM docs WHERE category = 'SMALL' GROUP BY 1) a
  ON n.n_nationkey = a.nation_key
"""))
def choropleth(spark: SparkSession, d: str) -> DataFrame:
    """Every nation with the sum and count of its 'SMALL' documents."""
    regions = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")
    f = docs(spark, d).where(F.col("category") == "SMALL")
    return db.choropleth(f, regions, "nation_key", "quantity", region_key="n_nationkey")


@register("choropleth_totals", sql=_sql("""
SELECT CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name,
       coalesce(a.sum_qty, 0.0) AS sum_qty, coalesce(a.n_rows, 0) AS n_rows
FROM nation n LEFT JOIN (SELECT nation_key, sum(quantity) AS sum_qty, count(*) AS n_rows FROM docs GROUP BY 1) a
  ON n.n_nationkey = a.nation_key
"""))
def choropleth_totals(spark: SparkSession, d: str) -> DataFrame:
    """J8 over all documents, whatever their category."""
    regions = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")
    return db.choropleth(docs(spark, d), regions, "nation_key", "quantity", region_key="n_nationkey")


#: every field of an indexed document and its type; nothing else is kept
FULL_MAPPING = {**{c: "keyword" for c in ("doc_id", "order_key", "line_no", "part_key", "supp_key", "cust_key", "category", "brand", "segment", "nation_key",
                                          "nation", "region", "state_county", "priority", "status", "return_flag", "buyer_state", "buyer_county",
                                          "buyer_zip", "month")},
                "part_name": "text", "tx_date": "date", "quantity": "float", "amount": "float", "strength": "float", "unit_price": "float",
                "normalized_quantity": "float", "week_index": "bigint", "year_index": "bigint", "population": "bigint", "returned": "boolean",
                "location": "geo_point"}


def full_docs(spark: SparkSession, d: str) -> DataFrame:
    """Documents with every field of the full mapping."""
    t = tx_with_population(spark, d).withColumns({
        "doc_id": F.concat_ws("-", "order_key", "line_no", "part_key", "supp_key"), "state_county": F.concat("region", F.lit("/"), "nation"),
        "month": F.date_format("tx_date", "yyyy-MM"), "unit_price": F.try_divide("amount", "quantity"),
        "normalized_quantity": F.col("quantity") * F.coalesce("strength", F.lit(1.0)), "week_index": week_index("tx_date", fx.TX_EPOCH),
        "returned": F.col("return_flag") == "R"})
    return db.export_documents(t, fx.geo(spark, d), "cust_key")


@register("index_mapping", sql=_sql(f"""
SELECT concat_ws('-', order_key, line_no, part_key, supp_key) AS doc_id,
       {', '.join(f'CAST(t.{c} AS VARCHAR) AS {c}' for c in FULL_MAPPING if FULL_MAPPING[c] == 'keyword' and c not in ('doc_id', 'state_county', 'month'))},
       t.region || '/' || t.nation AS state_county, strftime(t.tx_date, '%Y-%m') AS month, t.part_name, t.tx_date,
       CAST(t.quantity AS FLOAT) AS quantity, CAST(t.amount AS FLOAT) AS amount, CAST(t.strength AS FLOAT) AS strength,
       CAST(CASE WHEN t.quantity <> 0 THEN t.amount / t.quantity END AS FLOAT) AS unit_price,
       CAST(t.quantity * coalesce(t.strength, 1.0) AS FLOAT) AS normalized_quantity,
       CAST(date_diff('day', {EPOCH_SQL}, t.tx_date) // 7 AS BIGINT) AS week_index, CAST(year(t.tx_date) - year({EPOCH_SQL}) AS BIGINT) AS year_index,
       {_POP_SQL_PICK.replace('yi', '(year(t.tx_date) - year(' + EPOCH_SQL + '))')} AS population, t.return_flag = 'R' AS returned,
       CAST(g.lat AS FLOAT) AS location_lat, CAST(g.lon AS FLOAT) AS location_lon
FROM tx t JOIN pop_wide w ON t.nation_key = w.nation_key JOIN geo g ON t.cust_key = g.cust_key
"""))
def index_mapping(spark: SparkSession, d: str) -> DataFrame:
    """P17 with all 32 mapped fields."""
    ix = db.to_index_docs(full_docs(spark, d), FULL_MAPPING)
    return ix.select(*[c for c in ix.columns if c != "location"], F.col("location.lat").alias("location_lat"), F.col("location.lon").alias("location_lon"))
