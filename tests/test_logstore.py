"""The log-structured keyed table: against a plain model over random batches,
replays, tombstones, growth, compaction, vacuum, look-ups and drift."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.session import children, scratch_path
from ledgerlens.streaming import logstore

SCHEMA = "k string, t long, v long, dead boolean"
SMALL_LOG = {"fanout": 2, "buckets": 1, "bucket_rows": 40}


def apply(model, batch):
    """Greatest by (t, dead, v) per key; null keys are keys."""
    for k, t, v, dead in batch:
        if k not in model or (t, dead, v) > model[k]:
            model[k] = (t, dead, v)


def rows_of(df):
    return sorted(((r.k, r.t, r.v) for r in df.collect()), key=str)


def live(model):
    return sorted(((k, t, v) for k, (t, dead, v) in model.items() if not dead), key=str)


def batches(n, size, seed):
    draw = random.Random(seed)
    for _ in range(n):
        # late rows, repeated keys, a key that holds a third of all, a null key
        yield [(draw.choice([None, "hot", "hot", *(f"k{draw.randint(0, 90)}" for _ in range(3))]), draw.randint(0, 50), draw.randint(0, 9), draw.random() < 0.2) for _ in range(size)]


def upsert(spark, target, batch, batch_id=None, **layout):
    df = spark.createDataFrame(batch, SCHEMA)
    return logstore.upsert(spark, target, df, "k", ["t"], batch_id, deleted=F.col("dead"), **layout)


def test_random_batches_against_a_model(spark):
    target, model = scratch_path(spark, "log"), {}
    for i, batch in enumerate(batches(7, 60, 1)):
        assert upsert(spark, target, batch, ("s", i), **SMALL_LOG)
        apply(model, batch)
        if i in (0, 3, 6):
            assert rows_of(logstore.read(spark, target)) == live(model)
    state = logstore.newest(spark, target)
    tiers = [s.tier for s in state.segments]
    assert max(tiers) >= 2 and all(tiers.count(t) < 2 for t in tiers)
    assert max(s.buckets for s in state.segments) > 1
    # a replayed epoch is passed over, and writes nothing
    assert not upsert(spark, target, [("new", 99, 1, False)], ("s", 6), **SMALL_LOG)
    assert logstore.newest(spark, target) == state
    # another stream's epochs count by themselves
    assert upsert(spark, target, [("new", 99, 1, False)], ("other", 0), **SMALL_LOG)
    apply(model, [("new", 99, 1, False)])
    keys = ["hot", "new", "k1", "k2", "never"]
    assert rows_of(logstore.lookup(spark, target, keys)) == [r for r in live(model) if r[0] in keys]
    logstore.compact(spark, target, F.col("t") < 10, bucket_rows=40)
    (only,) = logstore.newest(spark, target).segments
    assert only.rows == len(live(model)) + sum(dead and t >= 10 for t, dead, _ in model.values())
    logstore.compact(spark, target, F.lit(True), bucket_rows=40)
    assert rows_of(logstore.read(spark, target)) == live(model)
    (only,) = logstore.newest(spark, target).segments
    assert only.rows == len(live(model)) and spark.read.parquet(only.path).where(logstore.DELETED).count() == 0
    before = len(children(spark, target + "/data"))
    assert logstore.vacuum(spark, target) > 0 and len(children(spark, target + "/data")) == 1 < before
    assert rows_of(logstore.read(spark, target)) == live(model)


def test_batches_cost_what_they_hold(spark):
    target = scratch_path(spark, "log-cost")
    first = [(f"k{i}", 0, i, False) for i in range(2000)]
    upsert(spark, target, first, ("s", 0))
    for i in range(1, 4):
        upsert(spark, target, [(f"k{j * 97 % 2000}", i, 0, False) for j in range(20)], ("s", i), fanout=8)
    log = {r.version: (r.appended, r.merged) for r in logstore.manifests(spark, target).collect()}
    assert log == {0: (2000, 0), 1: (20, 0), 2: (20, 0), 3: (20, 0)}
    got = logstore.read(spark, target)
    assert got.count() == 2000 and got.where("t = 3").count() == 20
    # an earlier version is still there
    assert logstore.read(spark, target, version=0).where("t > 0").count() == 0


def test_late_and_deleted(spark):
    target = scratch_path(spark, "log-late")
    upsert(spark, target, [("a", 5, 1, False), ("b", 5, 1, False), ("c", 5, 1, True)], ("s", 0))
    upsert(spark, target, [("a", 3, 9, False), ("b", 5, 1, True), ("c", 4, 1, False)], ("s", 1))
    # a late row loses, a removal at the same time wins, a late row does not bring a removed key back
    assert rows_of(logstore.read(spark, target)) == [("a", 5, 1)]
    upsert(spark, target, [("b", 6, 2, False)], ("s", 2))
    assert rows_of(logstore.read(spark, target)) == [("a", 5, 1), ("b", 6, 2)]


def test_drift_empty_batches_and_misuse(spark):
    target = scratch_path(spark, "log-drift")
    with pytest.raises(FileNotFoundError):
        logstore.read(spark, target)
    assert logstore.vacuum(spark, target) == 0
    upsert(spark, target, [("a", 1, 1, False)], ("s", 0))
    upsert(spark, target, [], ("s", 1))
    wide = spark.createDataFrame([("b", 2, 2, False, "x")], SCHEMA + ", extra string")
    logstore.upsert(spark, target, wide, "k", ["t"], ("s", 2), deleted=F.col("dead"))
    got = {r.k: r.extra for r in logstore.read(spark, target).collect()}
    assert got == {"a": None, "b": "x"}
    with pytest.raises(ValueError):
        logstore.upsert(spark, target, wide, "t", ["k"])
    # leftovers of a failed commit are no version
    spark.range(1).write.parquet(target + "/data/half-written")
    assert logstore.newest(spark, target).version == 2 and logstore.read(spark, target).count() == 2


def test_scratch_can_be_cleared(spark):
    from ledgerlens.session import clear_scratch, cut_lineage, scratch_used
    before = scratch_used(spark)
    cut_lineage(spark.range(3), "gone-soon")
    assert clear_scratch(spark, before) >= 1 and scratch_used(spark) <= before
