"""Geohash cells as pure column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the standard geohash base-32 alphabet
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _cell_xy(lat, lon, precision: int):
    total = 5 * precision
    lon_bits = (total + 1) // 2
    lat_bits = total // 2
    x = F.least(F.floor((_c(lon) + 180.0) / 360.0 * (1 << lon_bits)), F.lit((1 << lon_bits) - 1))
    y = F.least(F.floor((_c(lat) + 90.0) / 180.0 * (1 << lat_bits)), F.lit((1 << lat_bits) - 1))
    return (F.greatest(x, F.lit(0)).cast("bigint"), F.greatest(y, F.lit(0)).cast("bigint"),
            lon_bits, lat_bits)


def _chars_from_xy(x: Column, y: Column, precision: int, lon_bits: int, lat_bits: int) -> Column:
    """Interleave, character by character: bit b (0 = most significant) of the
    hash is longitude bit ``lon_bits-1-b//2`` for even b, else latitude bit
    ``lat_bits-1-b//2``; each character reads only its own five bits."""
    chars = F.split(F.lit(GEOHASH_ALPHABET), "")
    out = []
    for i in range(precision):
        idx = None
        for k in range(5):
            b = 5 * i + k
            src, nbits = (x, lon_bits) if b % 2 == 0 else (y, lat_bits)
            bit = F.shiftright(src, nbits - 1 - b // 2).bitwiseAND(1)
            term = F.shiftleft(bit, 4 - k)
            idx = term if idx is None else idx + term
        out.append(F.get(chars, idx.cast("int")))
    return F.concat(*out)


def geohash(lat: Column | str, lon: Column | str, precision: int = 3) -> Column:
    """Geohash string of ``precision`` characters.

    Longitude takes ceil(5p/2) bits and latitude floor(5p/2); bits alternate
    from the most significant end starting with longitude.  Coordinates on the
    upper edge (lat 90, lon 180) are clamped into the last cell.  Prefer
    :func:`with_geohash` on wide scans: it computes the cell coordinates once.
    """
    x, y, lb, tb = _cell_xy(lat, lon, precision)
    return F.when(_c(lat).isNull() | _c(lon).isNull(), F.lit(None).cast("string")) \
        .otherwise(_chars_from_xy(x, y, precision, lb, tb))


def with_geohash(df, lat: str, lon: str, precision: int = 3, out: str = "cell"):
    """Add the geohash column, computing the integer cell coordinates once as
    their own columns (so the optimizer does not repeat them per bit)."""
    x, y, lb, tb = _cell_xy(lat, lon, precision)
    d = df.withColumns({"__gx": x, "__gy": y})
    cell = F.when(F.col("__gx").isNull() | F.col("__gy").isNull(), F.lit(None).cast("string")) \
        .otherwise(_chars_from_xy(F.col("__gx"), F.col("__gy"), precision, lb, tb))
    return d.withColumn(out, cell).drop("__gx", "__gy")


def geohash_sql(lat: str, lon: str, precision: int = 3) -> str:
    """The same formula as DuckDB SQL text (used by the oracle)."""
    total = 5 * precision
    lon_bits = (total + 1) // 2
    lat_bits = total // 2
    x = (f"greatest(least(floor(({lon} + 180.0) / 360.0 * {1 << lon_bits}), "
         f"{(1 << lon_bits) - 1}), 0)::BIGINT")
    y = (f"greatest(least(floor(({lat} + 90.0) / 180.0 * {1 << lat_bits}), "
         f"{(1 << lat_bits) - 1}), 0)::BIGINT")
    terms = []
    for j in range(lon_bits):
        pos = total - 1 - 2 * (lon_bits - 1 - j)
        terms.append(f"(((({x}) >> {j}) & 1) << {pos})")
    for j in range(lat_bits):
        pos = total - 2 - 2 * (lat_bits - 1 - j)
        terms.append(f"(((({y}) >> {j}) & 1) << {pos})")
    code = "(" + " + ".join(terms) + ")"
    chars = [f"substr('{GEOHASH_ALPHABET}', ((({code}) >> {5 * (precision - 1 - i)}) & 31)::INTEGER + 1, 1)"
             for i in range(precision)]
    return " || ".join(chars)


def in_bbox(lat: Column | str, lon: Column | str, top: float, left: float,
            bottom: float, right: float) -> Column:
    """Map-extent filter.  Longitudes outside [-180, 180] (a map panned past
    the date line) are wrapped; a box wider than 360 degrees keeps all."""
    lat_ok = _c(lat).between(bottom, top)
    if right - left >= 360:
        return lat_ok
    lo = ((left + 180.0) % 360.0) - 180.0
    hi = ((right + 180.0) % 360.0) - 180.0
    if lo <= hi:
        lon_ok = _c(lon).between(lo, hi)
    else:
        lon_ok = (_c(lon) >= lo) | (_c(lon) <= hi)
    return lat_ok & lon_ok
