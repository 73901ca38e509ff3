"""File-stream ingest of line JSON and keyed idempotent upserts (ST1-ST3, F13-F15, K6).

* :func:`ingest_json` reads a directory of (gzip) line-JSON files as a
  stream of raw text lines, parses each line with an explicit schema, drops
  the raw text, casts the document id to string and nests the coordinates
  into a ``location`` struct -- the record transform chain of the index
  loader, as column expressions.
* :func:`upsert_stream` applies every micro-batch to a log-structured keyed
  table (:mod:`ledgerlens.streaming.logstore`), so that replays overwrite and
  never duplicate and a batch costs what it holds.
* :func:`split_stream` parts records from broken lines in one pass.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.streaming import logstore

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}
CORRUPT = "__corrupt"


def ingest_json(spark: SparkSession, src: str, schema: StructType | str, id_col: str | None = None,
                lat: str | None = None, lon: str | None = None, location: str = "location",
                max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Streaming DataFrame of parsed records from line-JSON files in ``src``;
    lines that are no record of the schema are left to :func:`broken_lines`.
    ``max_files_per_trigger`` bounds a micro-batch (results do not depend on
    it: the upsert orders rows by their data, not by file)."""
    parsed = _parsed(_lines(spark, src, max_files_per_trigger), schema)
    out = parsed.where(F.col(f"__r.{CORRUPT}").isNull()).select("__r.*").drop(CORRUPT)
    return transform_records(out, id_col, lat, lon, location)


def broken_lines(spark: SparkSession, src: str, schema: StructType,
                 max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Streaming DataFrame (line) of the lines that ``ingest_json`` leaves out."""
    parsed = _parsed(_lines(spark, src, max_files_per_trigger), schema)
    return parsed.select(F.col(f"__r.{CORRUPT}").alias("line")).where(F.col("line").isNotNull())


def _lines(spark: SparkSession, src: str, max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(src).where(F.length(F.trim("value")) > 0)


def _parsed(lines: DataFrame, schema: StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return lines.select(F.from_json("value", wide, JSON_OPTIONS | {"columnNameOfCorruptRecord": CORRUPT}).alias("__r"))


def transform_records(df: DataFrame, id_col: str | None, lat: str | None, lon: str | None,
                      location: str = "location") -> DataFrame:
    """F14 (id as string) and F15 (lon/lat moved into a nested point)."""
    if id_col:
        df = df.withColumn(id_col, F.col(id_col).cast("string"))
    if lat and lon:
        df = df.withColumn(location, F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))) \
               .drop(lat, lon)
    return df


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The newest committed version of an upsert target."""
    return logstore.read(spark, target)


def upsert_stream(sdf: DataFrame, target: str, key: str, order, checkpoint: str, available_now: bool = True,
                  deleted: Column | None = None, **layout) -> None:
    """Run the stream (``availableNow``) applying each micro-batch as an
    idempotent keyed upsert into a log-structured table (``logstore``; its
    ``fanout``, ``buckets`` and ``bucket_rows`` may be given); rows for which
    ``deleted`` holds remove their key.

    A batch costs what it holds.  One whose (stream id, epoch) the table has
    already is passed over, and any other builds on the newest version,
    whatever checkpoint it comes from.  One stream at a time may write to a
    target."""
    spark = sdf.sparkSession

    def apply(batch: DataFrame, epoch: int) -> None:
        logstore.upsert(spark, target, batch, key, order, (_stream_id(spark, checkpoint), epoch), deleted, **layout)

    w = sdf.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    q.awaitTermination()


def split_stream(spark: SparkSession, src: str, schema: StructType | str, good: str, broken: str, checkpoint: str,
                 id_col: str | None = None, max_files_per_trigger: int | None = 1000) -> None:
    """One stream, read once: records to ``good``, broken lines (line) to
    ``broken``.  A batch's folders bear its epoch and are overwritten by a
    replay, so nothing is lost or written twice."""
    parsed = _parsed(_lines(spark, src, max_files_per_trigger), schema)

    def apply(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            whole = F.col(f"__r.{CORRUPT}").isNull()
            ok = transform_records(batch.where(whole).select("__r.*").drop(CORRUPT), id_col, None, None)
            ok.write.mode("overwrite").parquet(f"{good.rstrip('/')}/epoch={epoch:012d}")
            batch.where(~whole).select(F.col(f"__r.{CORRUPT}").alias("line")).write.mode("overwrite").parquet(f"{broken.rstrip('/')}/epoch={epoch:012d}")
        finally:
            batch.unpersist()

    parsed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_stream(sdf: DataFrame, path: str, checkpoint: str) -> None:
    """Plain exactly-once append of a stream into Parquet (availableNow)."""
    q = (sdf.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
