"""Dashboard questions as DataFrame operators.

Each is what a search index computes for a dashboard panel, but exact: terms
are ranked over the whole table (no per-shard approximation), ties broken by
key.  Sets that feed a later step (top terms, kept parents) are bounded by
their ``n``/``k`` parameter, never by the data, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.geo import in_bbox, with_geohash
from ledgerlens.session import cut_lineage


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def kpi(df: DataFrame, qty: str, by=None, sum_col: str = "sum_qty",
        count_col: str = "n_rows") -> DataFrame:
    """Sum and count, globally or per ``by``."""
    aggs = [F.sum(_c(qty)).alias(sum_col), F.count(F.lit(1)).alias(count_col)]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def kpi_filtered(df: DataFrame, qty: str, col: str, values, prefix: str = "") -> DataFrame:
    """One pass computing sum and count for each phrase filter ``col = value``
    (A4, P13): conditional aggregates instead of one scan per panel."""
    aggs = []
    for v in values:
        cond = _c(col) == F.lit(v)
        tag = prefix + str(v).lower().replace(" ", "_")
        aggs += [F.sum(F.when(cond, _c(qty))).alias(f"sum_{tag}"),
                 F.count(F.when(cond, F.lit(1))).alias(f"n_{tag}")]
    return df.agg(*aggs)


def top_n(df: DataFrame, key: str, qty: str, n: int = 10, sum_col: str = "sum_qty") -> DataFrame:
    """Top ``n`` keys by summed metric, key as tie-break (A5).  Planned as a
    partial/final aggregate plus TakeOrderedAndProject (no global sort)."""
    g = df.groupBy(key).agg(F.sum(_c(qty)).alias(sum_col))
    return g.orderBy(F.col(sum_col).desc(), F.col(key).asc()).limit(n)


def top_terms_by_count(df: DataFrame, key: str, n: int = 5, count_col: str = "n_rows") -> DataFrame:
    """Selector list: the ``n`` most frequent keys."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return g.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(n)


def selector_filter(df: DataFrame, key: str, values) -> DataFrame:
    """Keep rows whose key is among ``values`` (P14).  The caller chooses the
    plan: literals are an ``isin`` (pushed to the scan), a DataFrame of keys
    is a semi join."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias("__sel")).distinct()
        return df.join(keys, _c(key) == F.col("__sel"), "left_semi")
    return df.where(_c(key).isin(list(values)))


def time_range(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Half-open time filter ``lo <= ts < hi`` (P15); prunes partitions and
    row groups when pushed to the scan."""
    t = _c(ts).cast("timestamp")
    return df.where((t >= F.lit(lo).cast("timestamp")) & (t < F.lit(hi).cast("timestamp")))


# interval ladder used by the automatic interval (days)
INTERVAL_LADDER = (1, 7, 30, 90, 365)


def auto_interval(range_days: float, target_buckets: int = 100, ladder=INTERVAL_LADDER) -> int:
    """Smallest interval from the ladder giving at most ``target_buckets``
    buckets over ``range_days``."""
    for d in ladder:
        if range_days / d <= target_buckets:
            return d
    return ladder[-1]


def bucket_start(ts: Column | str, days: int) -> Column:
    """Epoch-aligned ``days``-wide bucket start as a date (1970-01-01 based)."""
    start = F.window(_c(ts).cast("timestamp"), f"{days} days").start
    return start.cast("date")


def date_histogram(df: DataFrame, ts: str, qty: str, by: str, interval_days: int = 30,
                   size: int = 5, sum_col: str = "sum_qty", count_col: str = "n_rows",
                   rank_within: str = "total") -> DataFrame:
    """Sum per time bucket per term (A6, A7).  Empty buckets are omitted.

    ``rank_within="total"``: the ``size`` terms with the largest sum over the
    whole range, in every bucket.  ``rank_within="bucket"``: the ``size``
    largest terms of each bucket (terms nested under the histogram).  One
    pass over the rows: the (bucket, term) aggregate is computed once and
    ranked afterwards (the top-term set has ``size`` rows and is broadcast)."""
    cells = df.groupBy(bucket_start(ts, interval_days).alias("bucket_start"), by).agg(
        F.sum(_c(qty)).alias(sum_col), F.count(F.lit(1)).alias(count_col))
    if rank_within == "bucket":
        w = Window.partitionBy("bucket_start").orderBy(F.col(sum_col).desc(), F.col(by).asc())
        return cells.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= size) \
                    .drop("__rk")
    # read twice (totals, then the kept cells): written once, so the optimizer
    # cannot push the semi join below the aggregate into a second scan
    cells = cut_lineage(cells)
    top = top_n(cells, by, sum_col, size, sum_col="__total").select(by)
    return cells.join(F.broadcast(top), by, "left_semi")


def nested_top_k(df: DataFrame, qty: str, levels, sum_prefix: str = "sum_") -> DataFrame:
    """Nested terms (A8): top k1 of level 1 by sum, within each the top k2 of
    level 2 by sum, and so on.  Returns one row per kept leaf path with the
    sum at every level.  The rows are read once: everything is derived from
    the finest-level aggregate, and each level keeps only children of kept
    parents (a semi join against a set bounded by k1*k2*..., so broadcast)."""
    cols = [c for c, _ in levels]
    # the finest aggregate feeds every level: written once to the checkpoint
    # folder so the rows are scanned once
    fine = cut_lineage(df.groupBy(*cols).agg(F.sum(_c(qty)).alias("__q")))
    path: list[str] = []
    kept = None  # DataFrame of kept paths with their sums
    for col, k in levels:
        rows = fine if kept is None else fine.join(F.broadcast(kept.select(*path)), path, "left_semi")
        s = rows.groupBy(*path, col).agg(F.sum("__q").alias(sum_prefix + col))
        if path:
            w = Window.partitionBy(*path).orderBy(F.col(sum_prefix + col).desc(), F.col(col).asc())
            ranked = s.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= k).drop("__rk")
        else:
            ranked = s.orderBy(F.col(sum_prefix + col).desc(), F.col(col).asc()).limit(k)
        kept = ranked if kept is None else kept.join(ranked, path)
        path.append(col)
    return kept


def geo_grid(df: DataFrame, lat: str, lon: str, qty: str, precision: int = 3, bbox=None,
             cell_col: str = "cell") -> DataFrame:
    """Sum, count and centroid per geohash cell (A9, A10); optional map
    extent (top, left, bottom, right) filter first (P16)."""
    if bbox is not None:
        df = df.where(in_bbox(lat, lon, *bbox))
    return with_geohash(df, lat, lon, precision, cell_col).groupBy(cell_col).agg(
        F.sum(_c(qty)).alias("sum_qty"), F.count(F.lit(1)).alias("n_rows"),
        F.avg(_c(lat)).alias("centroid_lat"), F.avg(_c(lon)).alias("centroid_lon"))


def choropleth(df: DataFrame, regions: DataFrame, key: str, qty: str,
               region_key: str | None = None) -> DataFrame:
    """Regions left-joined to their sum and count, so empty regions remain."""
    region_key = region_key or key
    a = df.groupBy(key).agg(F.sum(_c(qty)).alias("sum_qty"), F.count(F.lit(1)).alias("n_rows"))
    j = regions.join(a, regions[region_key] == a[key], "left")
    return j.select(regions["*"], F.coalesce("sum_qty", F.lit(0.0)).alias("sum_qty"),
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def export_documents(df: DataFrame, coords: DataFrame, key: str, coord_key: str | None = None,
                     lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Inner join of the resolved ledger with coordinates (J3, P7): rows with
    no coordinates are dropped, as the reference's export does."""
    coord_key = coord_key or key
    c = coords.select(F.col(coord_key).alias("__ck"), F.col(lon).alias("longitude"),
                      F.col(lat).alias("latitude"))
    return df.join(c, _c(key) == F.col("__ck")).drop("__ck")


def to_index_docs(df: DataFrame, mapping: dict, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Project to an index mapping (P17): ``{field: type}``; 'float' narrows
    doubles, 'geo_point' builds ``struct(lat, lon)`` from the coordinates;
    unmapped columns are dropped (the mapping is not dynamic)."""
    cols = []
    for field, typ in mapping.items():
        if typ == "geo_point":
            cols.append(F.struct(_c(lat).cast("float").alias("lat"),
                                 _c(lon).cast("float").alias("lon")).alias(field))
        elif typ == "keyword" or typ == "text":
            cols.append(_c(field).cast("string").alias(field))
        else:
            cols.append(_c(field).cast(typ).alias(field))
    return df.select(*cols)
