"""Name normalisation and code lookups as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for equal results) -------------
# Trailing area suffixes removed from county names, in the reference's order.
AREA_SUFFIXES = ("CITY AND BOROUGH", "COUNTY", "BOROUGH", "CENSUS AREA",
                 "MUNICIPALITY", "PARISH")

# State / territory name -> two-letter code (50 states, DC and six special
# cases), in the reference's order.
STATE_CODES = (
    ("ALABAMA", "AL"), ("ALASKA", "AK"), ("ARIZONA", "AZ"), ("ARKANSAS", "AR"),
    ("CALIFORNIA", "CA"), ("COLORADO", "CO"), ("CONNECTICUT", "CT"),
    ("DELAWARE", "DE"), ("DISTRICT OF COLUMBIA", "DC"), ("FLORIDA", "FL"),
    ("GEORGIA", "GA"), ("HAWAII", "HI"), ("IDAHO", "ID"), ("ILLINOIS", "IL"),
    ("INDIANA", "IN"), ("IOWA", "IA"), ("KANSAS", "KS"), ("KENTUCKY", "KY"),
    ("LOUISIANA", "LA"), ("MAINE", "ME"), ("MARYLAND", "MD"),
    ("MASSACHUSETTS", "MA"), ("MICHIGAN", "MI"), ("MINNESOTA", "MN"),
    ("MISSISSIPPI", "MS"), ("MISSOURI", "MO"), ("MONTANA", "MT"),
    ("NEBRASKA", "NE"), ("NEVADA", "NV"), ("NEW HAMPSHIRE", "NH"),
    ("NEW JERSEY", "NJ"), ("NEW MEXICO", "NM"), ("NEW YORK", "NY"),
    ("NORTH CAROLINA", "NC"), ("NORTH DAKOTA", "ND"), ("OHIO", "OH"),
    ("OKLAHOMA", "OK"), ("OREGON", "OR"), ("PENNSYLVANIA", "PA"),
    ("RHODE ISLAND", "RI"), ("SOUTH CAROLINA", "SC"), ("SOUTH DAKOTA", "SD"),
    ("TENNESSEE", "TN"), ("TEXAS", "TX"), ("UTAH", "UT"), ("VERMONT", "VT"),
    ("VIRGINIA", "VA"), ("WASHINGTON", "WA"), ("WEST VIRGINIA", "WV"),
    ("WISCONSIN", "WI"), ("WYOMING", "WY"),
    ("VIRGIN ISLANDS", "VI"), ("GUAM", "GU"), ("ARMED FORCES IN EUROPE", "AE"),
    ("PALAU", "PW"), ("PUERTO RICO", "PR"), ("NORTHERN MARIANAS", "MP"),
)
# ---------------------------------------------------------------------------


def suffix_pattern(suffixes=AREA_SUFFIXES) -> str:
    """Anchored regex for trailing area words, e.g. ``\\s+(COUNTY|PARISH)$``."""
    return r"\s+(" + "|".join(suffixes) + r")$"


def strip_suffix(c: Column | str, suffixes=AREA_SUFFIXES) -> Column:
    """Upper-case and drop one trailing area word (F1, F2)."""
    c = F.col(c) if isinstance(c, str) else c
    if not suffixes:
        return F.upper(c)
    return F.regexp_replace(F.upper(c), suffix_pattern(suffixes), "")


def strip_non_word(c: Column | str) -> Column:
    """Remove every non-word character (F3, the intended ``\\W`` strip)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"\W", "")


def normalize_name(c: Column | str, suffixes=AREA_SUFFIXES) -> Column:
    """Matching key for a place name: upper, suffix-stripped, non-word-free."""
    return strip_non_word(strip_suffix(c, suffixes))


def int_flag(c: Column | str) -> Column:
    """0/1 integer -> boolean; anything else, null included, is false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c == F.lit(1), F.lit(False))


def code_table(spark: SparkSession, pairs=STATE_CODES,
               name_col: str = "name", code_col: str = "code") -> DataFrame:
    """The fixed lookup list as a DataFrame (57 rows; bound fixed by definition)."""
    return spark.createDataFrame(list(pairs), f"{name_col} string, {code_col} string")


def map_code(df: DataFrame, col: str, lookup: DataFrame | None = None,
             out: str = "code", pass_codes: bool = True,
             name_col: str = "name", code_col: str = "code") -> DataFrame:
    """Name -> code via a broadcast lookup join.

    Unknown names give null; with ``pass_codes`` a value that already is a
    code passes through.  Null input gives null.  No Python UDF and no driver
    side map: the lookup list has a bound fixed by definition, so it is
    broadcast explicitly.
    """
    spark = df.sparkSession
    lookup = lookup if lookup is not None else code_table(spark, name_col=name_col, code_col=code_col)
    names = lookup.select(F.upper(F.col(name_col)).alias("__lk_key"),
                          F.col(code_col).alias("__lk_code"))
    if pass_codes:
        codes = lookup.select(F.col(code_col).alias("__lk_key"),
                              F.col(code_col).alias("__lk_code"))
        names = names.unionByName(codes).dropDuplicates(["__lk_key"])
    key = F.upper(F.col(col))
    out_df = (df.withColumn("__lk_in", key)
                .join(names, F.col("__lk_in") == F.col("__lk_key"), "left")
                .withColumn(out, F.col("__lk_code"))
                .drop("__lk_in", "__lk_key", "__lk_code"))
    return out_df


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Distinct, lower-cased character n-grams of a string (M1 + M2).

    Strings shorter than ``n`` give an empty array (never a reversed range).
    """
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    L = F.length(c)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(L - (n - 1), F.lit(1))),
                        lambda i: F.substring(c, i, n))
    return F.when(L >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def words(c: Column | str) -> Column:
    """Lower-cased whitespace tokens of a whole text (empty tokens dropped)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), r"\s+"), lambda w: F.length(w) > 0)
