"""Small unit checks of helpers not covered by the query tests."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerlens.functions.geo import in_bbox
from ledgerlens.functions.text import int_flag, map_code
from ledgerlens.operators import dashboard as db
from ledgerlens.operators import profile as pf


def test_auto_interval_ladder():
    assert db.auto_interval(7 * 365, 100) == 30
    assert db.auto_interval(50, 100) == 1
    assert db.auto_interval(500, 100) == 7
    assert db.auto_interval(10 ** 6, 100) == 365


def test_bbox_wraps_the_date_line(spark):
    pts = spark.createDataFrame([(0.0, 175.0), (0.0, -170.0), (0.0, 10.0), (0.0, 100.0),
                                 (70.0, 10.0)], "lat double, lon double")
    got = [(r.lat, r.lon) for r in pts.where(in_bbox("lat", "lon", 60, -190, -40, 20)).collect()]
    assert got == [(0.0, 175.0), (0.0, -170.0), (0.0, 10.0)]
    everything = pts.where(in_bbox("lat", "lon", 90, -200, -90, 200)).count()
    assert everything == 5


def test_int_flag(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (2,)], "f int")
    assert [r[0] for r in df.select(int_flag("f")).collect()] == [True, False, False, False]


def test_map_code_with_custom_lookup(spark):
    lk = spark.createDataFrame([("Ontario", "ON"), ("Quebec", "QC")], "name string, code string")
    df = spark.createDataFrame([("ontario",), ("QC",), ("Yukon",)], "s string")
    out = {r.s: r.c for r in map_code(df, "s", lookup=lk, out="c").collect()}
    assert out == {"ontario": "ON", "QC": "QC", "Yukon": None}
    strict = {r.s: r.c for r in map_code(df, "s", lookup=lk, out="c", pass_codes=False).collect()}
    assert strict["QC"] is None


def test_ordered_values_and_describe(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", None)], "k string, x double")
    assert [r.k for r in pf.ordered_values(df, "k").collect()] == ["a", "b"]
    d = pf.describe(df, ["x"]).collect()[0]
    assert (d.n, d.mean, d.min, d.max) == (2, 2.0, 1.0, 3.0)


def test_selector_filter_of_keys_is_a_semi_join(spark):
    df = spark.range(0, 50).withColumn("k", F.col("id").cast("string"))
    values = [str(i) for i in range(0, 50, 2)]
    short = db.selector_filter(df, "k", values)
    long = db.selector_filter(df, "k", spark.createDataFrame([(v,) for v in values], "v string"))
    assert short.count() == long.count() == 25
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_sample_tsv_writes_header_and_rows(spark, tmp_path):
    from ledgerlens.sources.csv import scan_csv
    from ledgerlens.sources.sinks import write_sample_tsv
    df = spark.range(0, 2000).withColumn("v", F.col("id") * 2)
    p = str(tmp_path / "s")
    write_sample_tsv(df, p, ["id"], 200)
    back = scan_csv(spark, p, "id long, v long", sep="\t")
    assert back.count() == 200
    assert len([f for f in os.listdir(p) if f.startswith("part-")]) == 1
    assert back.where(F.col("v") != F.col("id") * 2).count() == 0


def test_jobs_cli_rejects_unknown_job():
    from ledgerlens.plans import jobs
    with pytest.raises(SystemExit):
        jobs.main(["jobs", "nope"])


def test_job_options_take_their_declared_types():
    from ledgerlens.plans import jobs
    got = jobs.parse_options(jobs.resolve, ["fact=/f", "carry_blank_keys=False"])
    assert got == {"fact": "/f", "carry_blank_keys": False}
    assert jobs.parse_options(jobs.window, ["n=7"]) == {"n": 7}
    assert jobs.parse_options(jobs.train, ["trees=5,6"]) == {"trees": (5, 6)}
    assert jobs.parse_options(jobs.cluster, ["ks=2,3"])["ks"] == (2, 3)
    for bad in (["nosuch=1"], ["carry_blank_keys=maybe"], ["fact"]):
        with pytest.raises(SystemExit):
            jobs.parse_options(jobs.resolve, bad)


def test_ledger_follows_its_input(spark, tmp_path):
    import shutil

    from ledgerlens.plans import fixtures as fx
    d = str(tmp_path / "sf")
    # the given tables are read-only: bytes are copied, modes are not
    for folder, _, names in os.walk(SMALL):
        there = os.path.join(d, os.path.relpath(folder, SMALL))
        os.makedirs(there, exist_ok=True)
        for name in names:
            shutil.copyfile(os.path.join(folder, name), os.path.join(there, name))
    first = fx.tx(spark, d).count()
    assert fx.data_signature(spark, d) == fx.data_signature(spark, d)
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    shutil.rmtree(f"{d}/lineitem.parquet", ignore_errors=True)
    (tmp_path / "sf" / "lineitem.parquet").unlink(missing_ok=True)
    li.where("l_orderkey % 2 = 0").write.parquet(f"{d}/lineitem.parquet")
    assert 0 < fx.tx(spark, d).count() < first


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from ledgerlens.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        checkpoint_dir(fake)
