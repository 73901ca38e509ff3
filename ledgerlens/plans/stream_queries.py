"""JSON ingest and stream-upsert queries (E9 load path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.plans.registry import register
from ledgerlens.session import scratch_path
from ledgerlens.sources.tables import table
from ledgerlens.streaming import ingest as ig
from ledgerlens.streaming import logstore

#: document ids repeat: event_id mod nine tenths of the events, so the ids grow with the table
ID_SPACE_SQL = "(SELECT greatest(1, 9 * count(*) // 10) FROM events)"
ROWS_PER_FILE = 1_000_000
#: batches of the removing streams, and the rows of a file of theirs: a gzip
#: file is read by one task, so a batch of more rows is more files
BATCHES, BATCH_FILE_ROWS = 9, 100_000

EVENT_DOC_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()), T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])


def write_event_json(spark: SparkSession, d: str, break_every: int | None = None, least_files: int = 3) -> str:
    """Export events as gzip line-JSON files, ordered in time across files, so
    each file is one micro-batch and later files overwrite earlier ids.  Every
    ``break_every``-th event's line is cut short."""
    e = table(spark, d, "events")
    n = e.count()
    docs = e.select("event_id", (F.col("event_id") % max(1, 9 * n // 10)).alias("doc_id"), "ts", "user_id",
                    "event_type", "value", "props",
                    ((F.col("user_id") % 360) - 179.5).cast("double").alias("lon"),
                    ((F.col("user_id") % 170) - 84.5).cast("double").alias("lat"))
    path = scratch_path(spark, "event-json")
    docs = docs.repartitionByRange(max(least_files, -(-n // ROWS_PER_FILE)), "event_id")
    if break_every:
        line = F.to_json(F.struct(*docs.columns), ig.JSON_OPTIONS)
        cut = F.when(F.col("event_id") % break_every == 0, F.substring(line, 1, 30)).otherwise(line)
        docs.select(cut.alias("value")).write.option("compression", "gzip").text(path)
    else:
        docs.write.option("compression", "gzip").options(**ig.JSON_OPTIONS).json(path)
    return path


def _flat(df: DataFrame) -> DataFrame:
    """Nested point flattened for comparison; props parsed."""
    return df.select("event_id", "doc_id", "ts", "user_id", "event_type", "value",
                     F.from_json("props", "k long").k.alias("props_k"),
                     F.col("location.lat").alias("location_lat"),
                     F.col("location.lon").alias("location_lon"))


_BASE_SQL = f"""
SELECT event_id, CAST(event_id % {ID_SPACE_SQL} AS VARCHAR) AS doc_id, ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
       CAST(user_id % 170 - 84.5 AS DOUBLE) AS location_lat,
       CAST(user_id % 360 - 179.5 AS DOUBLE) AS location_lon
FROM events
"""


@register("json_ingest", sql=_BASE_SQL)
def json_ingest(spark: SparkSession, d: str) -> DataFrame:
    """ST1 + ST2: file stream from the beginning, parse, drop raw text, id to
    string, nested location; appended exactly once (availableNow)."""
    src = write_event_json(spark, d)
    s = ig.ingest_json(spark, src, EVENT_DOC_SCHEMA, id_col="doc_id", lat="lat", lon="lon",
                        max_files_per_trigger=1)
    out, ck = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-ckpt")
    ig.append_stream(s, out, ck)
    return _flat(spark.read.parquet(out))


@register("stream_upsert", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, value DESC, event_id DESC) AS rn
  FROM ({_BASE_SQL})) WHERE rn = 1
""")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """ST3 + K6: the same stream upserted by document id (latest by ts, value,
    event id); replaying the files under a fresh checkpoint gives the same
    table (checked in the tests)."""
    src = write_event_json(spark, d)
    s = ig.ingest_json(spark, src, EVENT_DOC_SCHEMA, id_col="doc_id", lat="lat", lon="lon",
                        max_files_per_trigger=1)
    target, ck = scratch_path(spark, "upsert"), scratch_path(spark, "upsert-ckpt")
    ig.upsert_stream(s, target, "doc_id", ["ts", "value", "event_id"], ck)
    return _flat(ig.read_current(spark, target))


@register("json_broken_lines", sql="""
SELECT CAST(count(*) FILTER (WHERE event_id % 97 <> 0) AS BIGINT) AS n_records,
       CAST(count(*) FILTER (WHERE event_id % 97 = 0) AS BIGINT) AS n_broken,
       CAST(sum(event_id) FILTER (WHERE event_id % 97 <> 0) AS BIGINT) AS event_sum
FROM events
""")
def json_broken_lines(spark: SparkSession, d: str) -> DataFrame:
    """lines that are no record go to a table of their own and never
    become null rows."""
    src = write_event_json(spark, d, break_every=97)
    good, bad = scratch_path(spark, "good-lines"), scratch_path(spark, "broken-lines")
    ig.split_stream(spark, src, EVENT_DOC_SCHEMA, good, bad, scratch_path(spark, "split-ckpt"), id_col="doc_id")
    ok = spark.read.parquet(good).select(F.col("event_id"), F.lit(None).cast("string").alias("line"))
    both = ok.unionByName(spark.read.parquet(bad).select(F.lit(None).cast("long").alias("event_id"), "line"))
    return both.agg(F.count(F.when(F.col("line").isNull(), 1)).alias("n_records"), F.count("line").alias("n_broken"),
                    F.sum("event_id").alias("event_sum"))


@register("stream_second_load", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, value DESC, event_id DESC) AS rn
  FROM ({_BASE_SQL})) WHERE rn = 1
""")
def stream_second_load(spark: SparkSession, d: str) -> DataFrame:
    """K6 over two loads: two halves of the events, by hash, lie in two
    folders, loaded one after the other with a checkpoint each; then the first
    is loaded again.  Nothing of either is lost."""
    src = spark.read.text(write_event_json(spark, d))
    folders = [scratch_path(spark, f"event-half{i}") for i in (0, 1)]
    for i, folder in enumerate(folders):
        src.where(F.pmod(F.xxhash64("value"), F.lit(2)) == i).write.option("compression", "gzip").text(folder)
    target = scratch_path(spark, "upsert-two")
    for folder in (*folders, folders[0]):
        s = ig.ingest_json(spark, folder, EVENT_DOC_SCHEMA, id_col="doc_id", lat="lat", lon="lon")
        ig.upsert_stream(s, target, "doc_id", ["ts", "value", "event_id"], scratch_path(spark, "upsert-two-ckpt"))
    return _flat(ig.read_current(spark, target))


#: an event of this type removes its document
REMOVES = "error"

_LATEST_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, value DESC, event_id DESC) AS rn
  FROM ({_BASE_SQL})) WHERE rn = 1 AND event_type <> '{REMOVES}'
"""


def _batched_events(spark: SparkSession, d: str) -> tuple[str, int]:
    """Event files for the removing streams, and how many make one of their batches."""
    each = max(1, -(-table(spark, d, "events").count() // (BATCHES * BATCH_FILE_ROWS)))
    return write_event_json(spark, d, least_files=BATCHES * each), each


def _removing_stream(spark: SparkSession, src: str, target: str, files: int, **layout) -> None:
    """One load of the event files, ``files`` a batch, with removals."""
    s = ig.ingest_json(spark, src, EVENT_DOC_SCHEMA, id_col="doc_id", lat="lat", lon="lon", max_files_per_trigger=files)
    ig.upsert_stream(s, target, "doc_id", ["ts", "value", "event_id"], scratch_path(spark, "log-ckpt"), deleted=F.col("event_type") == REMOVES, **layout)


@register("stream_compacted", sql=_LATEST_SQL)
def stream_compacted(spark: SparkSession, d: str) -> DataFrame:
    """K6 + ST3 with removals, compaction and growing buckets: nine batches,
    two segments a tier, so merges of several tiers run and tombstones live on
    in them until a merge of all segments."""
    (src, files), target = _batched_events(spark, d), scratch_path(spark, "log")
    _removing_stream(spark, src, target, files, fanout=2, buckets=1, bucket_rows=500)
    return _flat(logstore.read(spark, target))


@register("stream_log_costs", sql=f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(event_id) AS BIGINT) AS event_sum, TRUE AS deltas_hold_their_batch, TRUE AS merges_are_logarithmic,
       TRUE AS buckets_doubled, TRUE AS compaction_keeps_rows, TRUE AS replay_keeps_rows, TRUE AS vacuum_keeps_rows, TRUE AS lookup_finds_rows
FROM ({_LATEST_SQL})
""")
def stream_log_costs(spark: SparkSession, d: str) -> DataFrame:
    """What the log-structured target promises, each as a boolean beside the
    final rows: a delta holds at most its batch; a row is merged at most once a
    tier; buckets double; full compaction, a replayed load and vacuum change no
    row; point look-ups agree."""
    (src, files), target = _batched_events(spark, d), scratch_path(spark, "log-costs")
    _removing_stream(spark, src, target, files, fanout=2, buckets=1, bucket_rows=500)
    n = table(spark, d, "events").count()
    log = logstore.manifests(spark, target).agg(F.sum("appended").alias("appended"), F.sum("merged").alias("merged"), F.max("version").alias("last")).first()
    tiers = logstore.segments(spark, target).agg(F.max("tier").alias("t"), F.max("buckets").alias("b")).first()

    def digest():
        rows = _flat(logstore.read(spark, target))
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("event_sum"), F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")).alias("hash")).first()

    before = digest()
    _removing_stream(spark, src, target, files, fanout=2, buckets=1, bucket_rows=500)
    replayed = digest()
    logstore.compact(spark, target, F.lit(True), bucket_rows=500)
    compacted = digest()
    logstore.vacuum(spark, target)
    vacuumed = digest()
    some = [r[0] for r in logstore.read(spark, target).orderBy(F.xxhash64("doc_id")).select("doc_id").limit(20).collect()]
    found = logstore.lookup(spark, target, [*some, "no such key"]).select("doc_id").collect()
    row = (before["n_rows"], before["event_sum"], log["appended"] <= n, log["merged"] <= n * tiers["t"], tiers["b"] > 1,
           compacted == before, replayed == before, vacuumed == before, sorted(r[0] for r in found) == sorted(some))
    return spark.createDataFrame([row], "n_rows long, event_sum long, deltas_hold_their_batch boolean, merges_are_logarithmic boolean, buckets_doubled boolean, "
                                        "compaction_keeps_rows boolean, replay_keeps_rows boolean, vacuum_keeps_rows boolean, lookup_finds_rows boolean")
