"""Golden edge cases (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import value_for_year, week_index, year_index
from ledgerlens.functions.geo import geohash
from ledgerlens.functions.text import char_ngrams, map_code, normalize_name, strip_suffix
from ledgerlens.operators import aggregate as agg
from ledgerlens.operators import resolve as rs
from ledgerlens.operators.history import history


def col_values(df, c=0):
    return [r[c] for r in df.collect()]


def test_non_word_strip(spark):
    df = spark.createDataFrame([("DE WITT",), ("DEWITT",), ("De-Witt",)], "n string")
    assert col_values(df.select(normalize_name("n", suffixes=())), 0) == ["DEWITT"] * 3


def test_suffix_strip_anchored(spark):
    df = spark.createDataFrame([("Juneau City and Borough",), ("Bronx County",), ("County Line",),
                                ("WAYNE",)], "n string")
    assert col_values(df.select(strip_suffix("n")), 0) == ["JUNEAU", "BRONX", "COUNTY LINE", "WAYNE"]


def test_short_names_have_no_grams(spark):
    df = spark.createDataFrame([("LA",), ("",), ("abc",)], "n string")
    assert col_values(df.select(char_ngrams("n")), 0) == [[], [], ["abc"]]


def _dim(spark, rows):
    d = spark.createDataFrame(rows, "dim_id long, dim_state string, dim_name string")
    return rs.prepare_dim(d, "dim_id", "dim_state", "dim_name")


def test_fuzzy_strict_bound_ties_and_blocks(spark):
    # 'abcde' has grams abc bcd cde; 'abcdx' shares 2 of 4 distinct -> 0.5
    dim = _dim(spark, [(1, "S", "abcdefgh"), (2, "S", "abcdefgh"), (3, "T", "abcdefgi")])
    keys = spark.createDataFrame([("S", "abcdefgi"), ("T", "abcdefgh"), ("S", "ab")],
                                 "st string, nm string")
    out = {(r.st, r.nm): (r.dim_id, r.dist) for r in
           rs.resolve_fuzzy(keys, dim, "st", "nm").collect()}
    # abcdefgi vs abcdefgh: grams 6 each, 5 shared -> 1 - 5/7 = 0.2857 >= 0.25 -> no match
    assert out[("S", "abcdefgi")] == (None, None)
    assert out[("T", "abcdefgh")] == (None, None)
    assert out[("S", "ab")] == (None, None)
    keys2 = spark.createDataFrame([("S", "abcdefghs")], "st string, nm string")
    r = rs.resolve_fuzzy(keys2, dim, "st", "nm").collect()[0]
    # two equal candidates -> the smaller id wins; 1 - 6/7
    assert r.dim_id == 1 and abs(r.dist - (1 - 6 / 7)) < 1e-12


def test_distance_exactly_at_bound_is_not_matched(spark):
    # grams of 'abcdef': abc bcd cde def (4); 'abcdefg' adds efg (5): 1 - 4/5 = 0.2
    # 'abcd' (abc bcd) vs 'abcde' (abc bcd cde): 1 - 2/3; choose a pair at exactly 0.25:
    # A = 4 grams, B = A + 1 extra gram -> 1 - 4/5 = 0.2; A = 3 grams subset of 4 -> 0.25
    dim = _dim(spark, [(1, "S", "abcdef")])          # abc bcd cde def
    keys = spark.createDataFrame([("S", "abcde")], "st string, nm string")  # abc bcd cde
    r = rs.resolve_fuzzy(keys, dim, "st", "nm").collect()[0]
    assert r.dim_id is None




def test_week_and_year_index(spark):
    ds = [dt.date(2006, 1, 1), dt.date(2006, 1, 7), dt.date(2006, 1, 8), dt.date(2005, 12, 31),
          dt.date(2012, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    got = df.select(week_index("d"), year_index("d")).collect()
    assert [r[0] for r in got] == [0, 0, 1, 0, 365, None]
    assert [r[1] for r in got] == [0, 0, 0, -1, 6, None]


def test_population_outside_years_is_null(spark):
    df = spark.createDataFrame([(y,) for y in (-1, -2, 0, 6, 7)], "yi long")
    cols = [F.lit(100 + i).cast("long") for i in range(7)]
    assert col_values(df.select(value_for_year("yi", cols)), 0) == [None, None, 100, 106, None]


def test_zero_or_null_population_rate(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, None), (5.0, 2)], "n double, p long")
    assert col_values(df.select(agg.rate("n", "p")), 0) == [None, None, 2.5]


def test_null_strength_weight_and_group(spark):
    df = spark.createDataFrame([("a", None, 2.0), ("a", None, 3.0), ("a", 2.0, 1.0)],
                               "k string, w double, q double")
    out = {r.w: r for r in agg.period_agg(df, {"k": "k", "w": "w"}, "q", "w").collect()}
    assert out[None].normalized_pill_count == 5.0 and out[None].order_count == 2.0
    assert out[2.0].normalized_pill_count == 2.0


def test_history_right_padding(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(16)], "g long, t long, v double")
    h = {r.t: r.history for r in history(df, ["g"], "t", "v", n=13).collect()}
    assert h[0] == [0.0] * 13
    assert h[2] == [0.0, 1.0] + [0.0] * 11
    assert h[15] == [float(i) for i in range(2, 15)]
    hl = {r.t: r.history for r in history(df, ["g"], "t", "v", n=13, pad="left").collect()}
    assert hl[2] == [0.0] * 11 + [0.0, 1.0]


def test_unknown_state_codes(spark):
    df = spark.createDataFrame([("ATLANTIS",), ("TX",), (None,), ("new york",)], "s string")
    out = map_code(df, "s", out="c").collect()
    assert {(r.s, r.c) for r in out} == {("ATLANTIS", None), ("TX", "TX"), (None, None),
                                         ("new york", "NY")}


def test_bad_csv_row_fails(spark, tmp_path):
    from ledgerlens.sources.csv import scan_csv
    p = tmp_path / "bad.csv"
    p.write_text("a,b\n1,2.5\n2,oops\n")
    with pytest.raises(Exception):
        scan_csv(spark, str(p), "a int, b double").collect()


def test_geohash_cells(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (42.6, -5.6), (40.7128, -74.0060),
                                (90.0, 180.0), (-90.0, -180.0)], "lat double, lon double")
    got = col_values(df.select(geohash("lat", "lon", 3)), 0)
    assert got[:3] == ["u4p", "ezs", "dr5"]
    assert got[3] == "zzz" and got[4] == "000"
    assert col_values(df.select(geohash("lat", "lon", 5)), 0)[0] == "u4pru"


def test_blank_keys_carry_or_drop(spark):
    from ledgerlens.plans import resolve_queries as rq
    d = "/root/testdata/sf0.001"
    carry = rq.resolved(spark, d, carry_blank_keys=True)
    drop = rq.resolved(spark, d, carry_blank_keys=False)
    n_fact = spark.read.parquet(f"{d}/lineitem.parquet").count()
    assert carry.count() == n_fact
    blanks = carry.where(F.col("buyer_county") == "").count()
    assert blanks > 0
    # blank keys found by the crosswalk stage only when carried
    assert carry.where((F.col("buyer_county") == "") & (F.col("match_stage") == "crosswalk")).count() > 0
    assert drop.where(F.col("buyer_county") == "").count() == 0
    assert drop.count() == n_fact - blanks


def test_empty_input_keeps_schema(spark):
    from ledgerlens.operators import dashboard as db
    df = spark.createDataFrame([], "k string, q double, ts timestamp, lat double, lon double")
    assert db.top_n(df, "k", "q").count() == 0
    assert db.geo_grid(df, "lat", "lon", "q").count() == 0
    assert db.date_histogram(df, "ts", "q", "k").count() == 0
    assert history(df.withColumn("t", F.lit(1)), ["k"], "t", "q").count() == 0
    assert agg.weighted_entropy(df, "k", "q").collect()[0][0] is None


def test_untyped_header_scan_is_all_strings(spark, tmp_path):
    from ledgerlens.sources.csv import scan_csv
    p = tmp_path / "u.csv"
    p.write_text("a,b\n1,2.5\n2,x\n")
    df = scan_csv(spark, str(p))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    assert df.count() == 2


def test_read_drifted_both_ways(spark, tmp_path):
    from ledgerlens.sources.tables import read_drifted
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "k long, v string").write.parquet(a)
    spark.createDataFrame([(2,)], "k long").write.parquet(b)
    for merge in (False, True):
        rows = sorted(tuple(r) for r in read_drifted(spark, [a, b], merge_schema=merge)
                      .select("k", "v").collect())
        assert rows == [(1, "x"), (2, None)]


def test_history_range_frame_uses_true_lags(spark):
    # weeks 0, 1, 5, 20: a range frame of 13 weeks sees only values within 13 weeks
    df = spark.createDataFrame([(0, w, float(w)) for w in (0, 1, 5, 20)], "g long, t long, v double")
    h = {r.t: r.history for r in history(df, ["g"], "t", "v", n=13, frame="range", pad="left").collect()}
    assert h[5] == [0.0] * 8 + [0.0, 1.0, 0.0, 0.0, 0.0]   # weeks 0 and 1 are lags 5 and 4
    many = spark.createDataFrame([(0, 1, 1.0)] * 20 + [(0, 3, 5.0)], "g long, t long, v double")
    h2 = {r.t: r.history for r in history(many, ["g"], "t", "v", n=3, frame="range").collect()}
    assert h2 == {1: [0.0, 0.0, 0.0], 3: [0.0, 20.0, 0.0]}   # every value of a week counts
    assert h[20] == [0.0] * 13          # week 5 is 15 weeks back: outside the frame
    hr = {r.t: r.history for r in history(df, ["g"], "t", "v", n=13).collect()}
    assert hr[20] == [0.0, 1.0, 5.0] + [0.0] * 10   # row frame: the 3 previous rows


def test_colliding_dimension_names_do_not_fan_out(spark):
    dim = spark.createDataFrame([(7, "S", "De Witt County"), (3, "S", "DEWITT"), (9, "S", "Other")],
                                "dim_id long, dim_state string, dim_name string")
    xw = spark.createDataFrame([("z1", "S", "de-witt"), ("z2", "S", "nowhere")],
                               "zip string, xw_state string, xw_county string")
    fact = spark.createDataFrame([("S", "DE WITT", "z0"), ("S", "", "z1"), ("S", "", "z1"),
                                  ("S", "zz", "z2")], "st string, cty string, zp string")
    r = rs.resolve_cascade(fact, dim, xw, "st", "cty", "zp", materialize=False)
    rows = sorted((x.cty, x.zp, x.dim_id, x.match_stage) for x in r.collect())
    assert len(rows) == 4
    assert rows == [("", "z1", 3, "crosswalk"), ("", "z1", 3, "crosswalk"),
                    ("DE WITT", "z0", 3, "exact"), ("zz", "z2", None, None)]
