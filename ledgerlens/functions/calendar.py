"""Calendar indexes and per-year value selection."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_EPOCH = "2006-01-01"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _epoch(epoch) -> Column:
    if isinstance(epoch, (str, _dt.date)):
        return F.lit(str(epoch)).cast("date")
    return _c(epoch)


def trunc_div(num: Column, d: int) -> Column:
    """Integral division truncating toward zero (Spark's ``div``)."""
    return ((num - num % F.lit(d)) / F.lit(d)).cast("bigint")


def week_index(c: Column | str, epoch=DEFAULT_EPOCH) -> Column:
    """Whole weeks since ``epoch``: day difference div 7, truncating toward
    zero, so the six days before the epoch are week 0.  Day arithmetic on
    dates, not local-zone milliseconds, so daylight saving cannot shift it.
    Null date -> null."""
    days = F.datediff(_c(c).cast("date"), _epoch(epoch)).cast("bigint")
    return trunc_div(days, 7)


def year_index(c: Column | str, epoch=DEFAULT_EPOCH) -> Column:
    """Calendar years since the epoch's year."""
    return (F.year(_c(c).cast("date")) - F.year(_epoch(epoch))).cast("bigint")


def value_for_year(year_idx: Column | str, cols) -> Column:
    """Pick ``cols[year_idx]`` (0-based); null outside the range instead of an
    error (T7), and null only when the chosen year's value is null."""
    return F.get(F.array(*[_c(c) for c in cols]), _c(year_idx).cast("int"))


def backfill(df, target_cols, source_col):
    """Copy one column into several (P8), in one projection."""
    return df.withColumns({t: F.col(source_col) for t in target_cols})
