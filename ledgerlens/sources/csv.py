"""Strict delimited-text scans, and scans that set bad records apart."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from ledgerlens.session import scratch_path


def scan_csv(spark: SparkSession, path, schema: StructType | str | None = None, sep: str = ",",
             null_token: str | None = None, date_format: str | None = None,
             header: bool = True, strict: bool = True) -> DataFrame:
    """Header CSV/TSV with an explicit schema.  ``strict`` fails the job on the
    first malformed row (FAILFAST) instead of silently nulling it.  Without a
    schema every column is a string (S4) -- no inference pass over the data.
    Compressed inputs (gzip, bz2) are read transparently; bz2 stays splittable.
    """
    r = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    if null_token is not None:
        r = r.option("nullValue", null_token)
    if date_format is not None:
        r = r.option("dateFormat", date_format)
    if strict:
        r = r.option("mode", "FAILFAST")
    paths = [path] if isinstance(path, str) else list(path)
    return r.csv(paths)


def write_csv(df: DataFrame, path: str, sep: str = ",", null_token: str | None = None,
              date_format: str | None = None, mode: str = "overwrite",
              compression: str | None = None) -> str:
    w = df.write.mode(mode).option("header", "true").option("sep", sep)
    if null_token is not None:
        w = w.option("nullValue", null_token)
    if date_format is not None:
        w = w.option("dateFormat", date_format)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


LINE, FILE, REASON = "line", "file", "reason"


def _typed(text: Column, kind, date_format: str | None) -> Column:
    if isinstance(kind, DateType) and date_format:
        return F.try_to_timestamp(text, F.lit(date_format)).cast("date")
    if isinstance(kind, TimestampType):
        return F.try_to_timestamp(text)
    return text.try_cast(kind)


def scan_quarantined(spark: SparkSession, path, schema: StructType | str, good: str, bad: str, sep: str = ",",
                     null_token: str | None = None, date_format: str | None = None, header: bool = True,
                     row_id: str | None = "row_id", fill: dict | None = None) -> tuple[str, str]:
    """Typed scan of CSV/TSV in one pass: records that fit the schema
    are numbered, their nulls filled (``fill``) and written to ``good``; all
    others go to ``bad`` with their line, file and reason, and stop nothing.

    A record fits if it has a value or the null token for every column and
    each value is of its column's type.  The reason names the number of fields,
    or the columns whose values do not parse.  Row ids are unique; they come
    with the stored table, so later reads agree on them."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"sep": sep, "header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    if null_token is not None:
        options["nullValue"] = null_token
    if date_format is not None:
        options["dateFormat"] = date_format
    wide = StructType([*schema.fields, StructField(LINE, StringType())])
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.options(**options).schema(wide).csv(paths).withColumn(FILE, F.col("_metadata.file_path"))
    # one parse, one write: both sides are read from what it leaves
    both = scratch_path(spark, "scanned")
    rows.withColumn("fits", F.col(LINE).isNull()).write.partitionBy("fits").parquet(both)
    stored = spark.read.schema(StructType([*wide.fields, StructField(FILE, StringType()), StructField("fits", StringType())])).parquet(both)
    ok = stored.where("fits = 'true'").select(*schema.names)
    if row_id:
        ok = ok.withColumn(row_id, F.monotonically_increasing_id())
    if fill:
        ok = ok.fillna(fill)
    ok.write.parquet(good)
    fields = F.split(LINE, re.escape(sep), -1)
    unread = []
    for i, f in enumerate(schema.fields):
        text = F.get(fields, i)
        empty = text.isin("", null_token) if null_token is not None else text == ""
        unread.append(F.when(~empty & _typed(text, f.dataType, date_format).isNull(), f.name))
    n = F.size(fields)
    reason = (F.when(n != len(schema.fields), F.concat(n.cast("string"), F.lit(f" fields of {len(schema.fields)}")))
               .otherwise(F.concat(F.lit("unreadable: "), F.array_join(F.array_compact(F.array(*unread)), ", "))))
    stored.where("fits = 'false'").select(LINE, FILE, reason.alias(REASON)).write.parquet(bad)
    return good, bad
