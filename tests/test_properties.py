"""Properties: conservation, subset/recall of approximate joins, identities,
determinism, replay idempotence."""

import hashlib
import math

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import MEDIUM, SMALL
from ledgerlens.functions.keys import add_surrogate_key, hash_split
from ledgerlens.operators import resolve as rs

Q = E.queries()


def test_cascade_conserves_rows_and_stages_are_disjoint(spark):
    from ledgerlens.plans import resolve_queries as rq
    r = rq.resolved(spark, MEDIUM)
    n_fact = spark.read.parquet(f"{MEDIUM}/lineitem.parquet").count()
    assert r.count() == n_fact
    by = {row.match_stage: row.n for row in r.groupBy("match_stage").agg(F.count("*").alias("n")).collect()}
    assert sum(by.values()) == n_fact
    assert set(by) == {"exact", "fuzzy", "crosswalk", None}
    # stage counts at the part level match the fixture description
    keys = r.select("buyer_zip", "match_stage").distinct()
    per = {row.match_stage: row.n for row in keys.groupBy("match_stage").agg(F.count("*").alias("n")).collect()}
    assert per == {"exact": 800, "fuzzy": 400, "crosswalk": 400, None: 400}


def test_fuzzy_best_is_minimum(spark):
    pairs = Q["fuzzy_pairs"](spark, MEDIUM)
    best = Q["resolve_fuzzy"](spark, MEDIUM)
    mins = pairs.groupBy("buyer_state", "buyer_county").agg(F.min("dist").alias("m"))
    j = best.join(mins, ["buyer_state", "buyer_county"])
    assert j.where(F.col("dist") != F.col("m")).count() == 0
    assert j.count() == best.count()


def test_lsh_is_subset_of_exact_with_recall(spark):
    exact = {(r.buyer_state, r.buyer_county, r.dim_id) for r in Q["fuzzy_pairs"](spark, MEDIUM).collect()}
    best_exact = {(r.buyer_state, r.buyer_county) for r in Q["resolve_fuzzy"](spark, MEDIUM).collect()}
    lsh = Q["resolve_fuzzy_lsh"](spark, MEDIUM).collect()
    assert {(r.buyer_state, r.buyer_county, r.dim_id) for r in lsh} <= exact
    recall = len({(r.buyer_state, r.buyer_county) for r in lsh}) / len(best_exact)
    assert recall >= 0.9


def test_doc_near_dup_lsh_subset_of_exact(spark):
    exact = {r.doc_id: r.representative for r in Q["doc_near_dup_exact"](spark, SMALL).collect()}
    lsh = {r.doc_id: r.representative for r in Q["doc_near_dup"](spark, SMALL).collect()}
    # groups of the approximate join are parts of the exact ones
    assert all(exact.get(a, a) == exact.get(b, b) for a, b in lsh.items())
    assert len(exact) > 0 and len(lsh) >= 0.9 * len(exact)


def test_weighted_entropy_bounds_and_value(spark):
    v = Q["weighted_entropy"](spark, MEDIUM).collect()[0][0]
    assert abs(v - 1.2162408523339914) < 1e-8
    assert 0 <= v <= math.log(10)


def test_kmeans_cost_identity_and_sweep(spark):
    c = Q["kmeans_cost"](spark, SMALL).collect()[0]
    assert c.equals_training_cost and c.nearest_centre
    sweep = sorted(Q["kmeans_sweep"](spark, SMALL).collect(), key=lambda r: r.k)
    assert [r.k for r in sweep] == [20, 40, 60, 80, 100]   # the recorded k list
    assert sweep[0].cost >= sweep[-1].cost
    assert all(r.weighted_entropy >= 0 for r in sweep)


def test_feature_matrix_and_scale(spark):
    fm = Q["feature_matrix"](spark, SMALL)
    stats = fm.agg(F.min("nnz"), F.max("nnz"), F.countDistinct("n_slots")).collect()[0]
    assert stats[2] == 1 and 10 <= stats[0] <= stats[1] <= 14
    assert Q["feature_scale"](spark, SMALL).first()["others_unit"]


def test_squared_distances_sparse_and_dense(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from ledgerlens.operators import ml
    draw = np.random.default_rng(1)
    rows = []
    for i in range(40):
        x = draw.normal(size=6) * (draw.random(6) < 0.5)
        rows.append((i, Vectors.dense(x) if i % 2 else Vectors.sparse(6, {int(j): float(x[j]) for j in np.flatnonzero(x)})))
    df = spark.createDataFrame(rows, ["id", "features"])
    model = ml.fit_kmeans(df, 3)
    centers = model.clusterCenters()
    got = {r.id: (r.cluster, r.sq_dist) for r in ml.squared_distances(model, model.transform(df)).collect()}
    for i, v in rows:
        assert abs(got[i][1] - ((v.toArray() - centers[got[i][0]]) ** 2).sum()) < 1e-9
    assert abs(ml.kmeans_cost(model, df).first()["cost"] * 40 - model.summary.trainingCost) < 1e-9


def test_forest_beats_mean_and_importances(spark):
    rows = {r.split: r for r in Q["rf_predict"](spark, SMALL).collect()}
    test = Q["rf_train"](spark, SMALL)
    mean = test.agg(F.avg("pill_count_per_capita")).collect()[0][0]
    base = test.agg(F.sqrt(F.avg((F.col("pill_count_per_capita") - F.lit(mean)) ** 2))).collect()[0][0]
    assert rows["test"].rmse <= base * 1.05
    imp = Q["feature_importance"](spark, SMALL).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-6


def test_profile_distinct_within_tolerance(spark):
    rows = Q["profile_distinct"](spark, SMALL).collect()
    assert len(rows) == 22 and all(r.within_tolerance and r.halves_equal_whole for r in rows)


def test_stored_profile_grows_by_merging(spark):
    from ledgerlens.operators import sketches as sk
    from ledgerlens.session import scratch_path
    o = spark.read.parquet(f"{MEDIUM}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    o = o.withColumn("hole", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")))
    path, folded = scratch_path(spark, "prof"), scratch_path(spark, "prof2")
    for i in range(3):
        sk.append_profile(o.where(F.col("o_orderkey") % 3 == i), path, ["o_custkey", "hole", "o_orderstatus"], "year")
    whole = {r.column_name: r for r in sk.read_profile(spark, path).collect()}
    n = o.count()
    assert {r.n_rows for r in whole.values()} == {n} and whole["hole"].n_nulls == o.where("hole is null").count()
    exact = o.agg(F.countDistinct("o_custkey")).first()[0]
    assert abs(whole["o_custkey"].approx_distinct - exact) <= 0.06 * exact and whole["o_orderstatus"].approx_distinct == 3
    sk.compact_profile(spark, path, folded)
    years = o.select("year").distinct().count()
    assert spark.read.parquet(folded).count() == 3 * years < spark.read.parquet(path).count()
    assert {r.column_name: r for r in sk.read_profile(spark, folded).collect()} == whole
    one = o.agg(F.min("year")).first()[0]
    part = {r.column_name: r for r in sk.read_profile(spark, path, [one]).collect()}
    assert part["o_custkey"].n_rows == o.where(F.col("year") == one).count()


def test_bottom_k_is_exact_and_merges(spark):
    from ledgerlens.functions.keys import bottom_k
    df = spark.range(0, 5000).selectExpr("id div 2 as id", "cast(id as string) as v")
    want = sorted((hashlib.md5(str(i // 2).encode()).hexdigest(), i // 2, str(i)) for i in range(5000))[:301]
    got = sorted((r.h, r.id, r.v) for r in bottom_k(df.repartition(13), ["id"], 301, out="h").collect())
    assert got == want
    halves = [bottom_k(df.where(f"v % 2 = {i}"), ["id"], 301) for i in (0, 1)]
    assert sorted((r.h, r.id, r.v) for r in bottom_k(halves[0].unionByName(halves[1]), ["id"], 301, out="h").collect()) == want
    assert bottom_k(df, ["id"], 9000).count() == 5000 and bottom_k(df.limit(0), ["id"], 5).count() == 0


def test_hash_split_and_surrogate_key_independent_of_partitioning(spark):
    o = spark.read.parquet(f"{MEDIUM}/orders.parquet")
    sums = set()
    for n in (2, 7, 31):
        a, _ = hash_split(o.repartition(n), ["o_orderkey"], 0.7)
        sums.add((a.count(), a.agg(F.sum("o_orderkey")).collect()[0][0]))
    assert len(sums) == 1
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    ids = [sorted(r.row_id for r in add_surrogate_key(li.repartition(n)).collect()) for n in (2, 9)]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(ids[0])


def test_surrogate_key_hot_group_is_split(spark):
    df = spark.range(0, 5000).select(F.lit("same").alias("v"))
    out = add_surrogate_key(df, chunk=1000)
    ids = [r.row_id for r in out.collect()]
    assert len(ids) == 5000 and len(set(ids)) == 5000


def test_stream_replay_changes_nothing(spark):
    from ledgerlens.plans import stream_queries as sq
    from ledgerlens.session import scratch_path
    from ledgerlens.streaming import ingest as ig
    src = sq.write_event_json(spark, SMALL)
    target = scratch_path(spark, "replay")
    for _ in range(2):  # second run: fresh checkpoint, same files, same target
        s = ig.ingest_json(spark, src, sq.EVENT_DOC_SCHEMA, id_col="doc_id", lat="lat", lon="lon")
        ig.upsert_stream(s, target, "doc_id", ["ts", "value", "event_id"], scratch_path(spark, "ck"))
        cur = ig.read_current(spark, target)
        snap = sorted(tuple(r) for r in cur.select("doc_id", "event_id", "value").collect())
        if _ == 0:
            first = snap
    assert snap == first
    n_events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    assert len(first) == 9 * n_events // 10


def test_unreadable_manifest_raises(spark, tmp_path):
    from ledgerlens.streaming import logstore
    bad = tmp_path / "t" / "manifest" / "version=000000000000"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        logstore.newest(spark, str(tmp_path / "t"))
    assert logstore.newest(spark, str(tmp_path / "none")) is None


def test_surrogate_key_tells_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("N", "1:x"), ("N1:", "x"), ("1:N", None)]
    out = add_surrogate_key(spark.createDataFrame(rows + rows[:1], "p string, q string")).collect()
    assert len({r.row_id for r in out}) == len(rows) + 1


def test_split_counts_match_cascade(spark):
    s = {r.has_match: r.n_rows for r in Q["split_counts"](spark, SMALL).collect()}
    c = Q["resolve_cascade"](spark, SMALL).groupBy("has_match").agg(F.sum("n_rows").alias("n")).collect()
    assert s == {r.has_match: r.n for r in c}


def _brute_groups(docs, shingle, percent):
    def sh(t):
        w = t.lower().split()
        return {" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {" ".join(w)} if w else set()
    sets = {i: sh(t or "") for i, t in docs}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {k: lo if v == hi else v for k, v in group.items()}
    return {i: (g, round(1 - len(sets[i] & sets[g]) / len(sets[i] | sets[g]), 6)) for i, g in group.items() if i != g}


@pytest.mark.parametrize("part_ids", [3, 1000])
def test_exact_near_duplicates_against_brute_force(spark, part_ids, monkeypatch):
    """Chains, copies, templates that share most shingles without linking, hot
    keys split into parts; nulls, empty and short texts."""
    import random

    from ledgerlens.operators import neardup
    monkeypatch.setattr(neardup.linked, "__defaults__", (75, part_ids))
    random.seed(7)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(random.choice(["alpha", "beta", "gamma"]) for _ in range(random.randint(3, 9)))) for i in range(60)]
    for k in range(40):
        own = list(base)
        for i in random.sample(range(60), random.randint(0, 3)):
            own[i] = f"x{k}_{i}"
        docs.append((100 + k, " ".join(own[random.randint(0, 6):])))
    docs += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "A  b"), (205, "a"), (206, docs[0][1]), (207, docs[70][1] + "\n")]
    df = spark.createDataFrame(docs, "id long, text string").withColumn("n", F.lit("x")).withColumn("key", F.lit("y"))
    got = {r.doc: (r.representative, round(r.dist, 6)) for r in neardup.exact_near_duplicates(df, "id", "text").collect()}
    assert got == _brute_groups(docs, 5, 75)
    near = neardup.near_duplicates(df, "id", "text").collect()
    assert all(got.get(r.doc, (r.doc,))[0] == got.get(r.representative, (r.representative,))[0] for r in near) and len(near) >= 0.9 * len(got)
    assert neardup.exact_near_duplicates(df.limit(0), "id", "text").collect() == [] == neardup.near_duplicates(df.limit(0), "id", "text").collect()


def test_components_of_long_chains(spark):
    from ledgerlens.operators.graph import components
    chain = [(i, i + 1) for i in range(0, 400) if i % 100 != 99] + [(1000, 5), (2000, 2001), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: i // 100 * 100 for i in range(0, 400)} | {400: 400, 1000: 0, 2000: 2000, 2001: 2000}
    assert got == {k: v for k, v in want.items() if k != 400} | ({400: 400} if 400 in got else {})


def test_results_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            outs.append({name: sorted(repr(tuple(r)) for r in Q[name](spark, SMALL).collect())
                         for name in ("resolve_cascade", "nested_terms", "history_window",
                                      "doc_near_dup_exact")})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert outs[0] == outs[1]


def test_best_match_window_equals_aggregate(spark):
    pairs = Q["fuzzy_pairs"](spark, MEDIUM)
    keys = ["buyer_state", "buyer_county"]
    a = sorted(tuple(r) for r in rs.best_match(pairs, keys).collect())
    w = sorted(tuple(r) for r in rs.best_match(pairs, keys, method="window").collect())
    assert a == w and len(a) > 0


def test_cascade_with_lsh_fuzzy_stage(spark):
    from ledgerlens.plans import fixtures as fx
    t = fx.tx(spark, MEDIUM)
    dim, xw = fx.name_dim(spark, MEDIUM), fx.crosswalk(spark, MEDIUM)
    args = (t, dim, xw, "buyer_state", "buyer_county", "buyer_zip")
    exact = rs.resolve_cascade(*args)
    lsh = rs.resolve_cascade(*args, fuzzy="lsh")
    assert lsh.count() == exact.count()
    fz = lambda r: {(x.buyer_zip, x.dim_id) for x in r.where(F.col("match_stage") == "fuzzy")
                    .select("buyer_zip", "dim_id").distinct().collect()}
    a, b = fz(lsh), fz(exact)
    assert a <= b and len(a) >= 0.9 * len(b)


def _points(spark, n=400):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(n, numPartitions=3).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 101).cast("double").alias("b"),
                                                ((F.col("id") % 7) * 3 + F.col("id") * 37 % 101).cast("double").alias("y"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_forest_keeps_places_of_rows_and_grows_the_same_trees(spark):
    """node ids are kept between levels; the forest is the one grown without."""
    from pyspark.ml.regression import RandomForestRegressor
    from ledgerlens.operators import ml
    df = _points(spark)
    best = ml.train_forest(df, "y", trees=(3,), depths=(2, 5), folds=2).bestModel
    assert best.getCacheNodeIds()
    plain = RandomForestRegressor(labelCol="y", featuresCol="features", seed=42, numTrees=3, maxDepth=best.getMaxDepth()).fit(df)
    trees = [t.toDebugString.split("\n", 1)[1] for t in best.trees]
    assert trees == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]


def test_sweep_fits_by_blocks_with_the_same_result(spark):
    """the sweep's fits run on blocks and give what they give row by row."""
    from ledgerlens.operators import ml
    df, models = _points(spark), {}
    out = {r["k"]: r for r in ml.kmeans_sweep(df, (2, 5), label="a", save=models.__setitem__).collect()}
    for k, model in models.items():
        assert model.getSolver() == "block"
        plain = ml.fit_kmeans(ml.dealt(df.select("features", "a")).persist(), k, solver="row")
        assert abs(out[k]["cost"] * 400 - plain.summary.trainingCost) <= 1e-9 * plain.summary.trainingCost
