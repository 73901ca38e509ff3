"""What the fixes of round 4 rest on; the rows are made here."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir, children


def _near_docs():
    random.seed(11)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(random.choice(["a", "b", "c"]) for _ in range(random.randint(2, 9)))) for i in range(40)]
    for k in range(40):
        own = list(base)
        for i in random.sample(range(60), random.randint(0, 4)):
            own[i] = f"x{k}_{i}"
        docs.append((100 + k, " ".join(own[random.randint(0, 5):])))
    return docs + [(200, None), (201, " \n"), (202, docs[50][1].upper()), (203, "z"), (204, docs[50][1] + "\n")]


def _links(docs, n):
    words = {i: (t or "").lower().split() for i, t in docs}
    sets = {i: {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()} for i, w in words.items()}
    return sets, {a: {b for b in sets if b != a and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])} for a in sets}


@pytest.mark.parametrize("sliced", [False, True])
def test_near_duplicates_in_slices_leave_no_tables(spark, monkeypatch, sliced):
    """every link is found when sets are dealt out in slices, to parts of
    groups, after a comparison of 16 bits a token; the sets, postings and pairs
    are gone from the scratch folder, and only the result is left."""
    from ledgerlens.operators import neardup
    if sliced:
        monkeypatch.setattr(neardup, "SLICE_BYTES", 1)
        monkeypatch.setattr(neardup.meetings, "__defaults__", (7,))
    docs = _near_docs()
    df = spark.createDataFrame(docs, "id long, text string")
    sets, links = _links(docs, 3)
    before = set(children(spark, checkpoint_dir(spark)))
    got = {r.doc: r for r in neardup.exact_links(df, "id", "text", 3).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(v) for i, v in links.items()}
    for r in got.values():
        reached, todo = {r.doc}, [r.doc]
        while todo:
            todo += (new := links[todo.pop()] - reached)
            reached |= new
        a, b = sets[r.doc], sets[min(reached)]
        assert r.representative == min(reached) and abs(r.dist - (1 - len(a & b) / len(a | b) if a else 0)) < 1e-9
    whole = {r.doc: r.representative for r in neardup.exact_near_duplicates(df, "id", "text", 3).collect()}
    assert whole == {i: r.representative for i, r in got.items() if r.representative != i}
    left = {x.rpartition("-")[0] for x in set(children(spark, checkpoint_dir(spark))) - before}
    assert left == {"neardup-found"}


def test_kept_tables_pass_to_the_context_around(spark):
    """what a step keeps lives until the step around it ends."""
    from ledgerlens.session import DROP_SHUFFLES, cut_lineage, passing_tables
    old, before = spark.conf.get(DROP_SHUFFLES, None), set(children(spark, checkpoint_dir(spark)))

    def left():
        return [x.rpartition("-")[0] for x in children(spark, checkpoint_dir(spark)) if x not in before]
    with passing_tables(spark) as keep:
        with passing_tables(spark) as inner:
            gone, stays = cut_lineage(spark.range(3), "r04-gone"), inner(cut_lineage(spark.range(4), "r04-stays"))
        assert stays.count() == 4 and left() == ["r04-stays"]
        out = keep(cut_lineage(stays.where("id > 0"), "r04-out"))
    assert left() == ["r04-out"] and out.agg(F.sum("id")).first()[0] == 6 and spark.conf.get(DROP_SHUFFLES, None) == old and gone is not None


def _labelled(spark, n):
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(0, n, 1, 4).select(*((F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(1000)) / 1000).alias(f"x{i}") for i in range(4)))
    rows = rows.withColumn("y", F.col("x0") * 3 + F.col("x1") * F.col("x2"))
    return VectorAssembler(inputCols=["x0", "x1", "x2", "x3"], outputCol="features").transform(rows).select("features", "y")


def test_forest_folds_and_choice_as_cross_validator(spark, monkeypatch):
    """One pool over all folds makes the fits that CrossValidator makes,
    with its metrics and its choice, over rows that are persisted once."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from pyspark.sql.classic.dataframe import DataFrame

    from ledgerlens.operators import ml
    df = _labelled(spark, 400)
    rf = RandomForestRegressor(labelCol="y", seed=1)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [2, 4]).addGrid(rf.maxDepth, [2, 3]).build()
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=3, seed=42, parallelism=4)
    want = cv.fit(df)
    persisted, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, level: persisted.append(level) or persist(self, level))
    got = ml.cross_validated(cv, df)
    assert all(abs(a - b) < 1e-9 for a, b in zip(want.avgMetrics, got.avgMetrics, strict=True))
    assert got.bestModel.toDebugString.partition("\n")[2] == want.bestModel.toDebugString.partition("\n")[2]
    assert len(persisted) == 1


def test_sweep_leaves_the_memory_to_the_blocks(spark, monkeypatch):
    """rows that the sweep persists lie on disk only."""
    from pyspark import StorageLevel
    from pyspark.sql.classic.dataframe import DataFrame

    from ledgerlens.operators import ml
    levels, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, level: levels.append(level) or persist(self, level))
    out = ml.kmeans_sweep(_labelled(spark, 200).withColumn("y", F.round("y")), (2, 3), "y")
    assert levels == [StorageLevel.DISK_ONLY] and [r.k for r in out.collect()] == [2, 3]
