"""Steps that must stay bounded as tables grow, and whole results of the joins
on pairs; every test builds its own rows."""

import gzip
import random
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.session import children, scratch_path


def _sets(docs, shingle):
    def one(t):
        w = (t or "").lower().split()
        return {" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {" ".join(w)} if w else set()
    return {i: one(t) for i, t in docs}


@pytest.mark.parametrize("shingle", [3, 5])
def test_every_link_between_documents_is_counted(spark, shingle, monkeypatch):
    from ledgerlens.operators import neardup
    monkeypatch.setattr(neardup.all_links, "__defaults__", (75, 7))
    random.seed(3)
    base = [f"w{i}" for i in range(50)]
    docs = [(i, " ".join(random.choice(["a", "b", "c"]) for _ in range(random.randint(2, 9)))) for i in range(40)]
    for k in range(30):
        own = list(base)
        for i in random.sample(range(50), random.randint(0, 2)):
            own[i] = f"x{k}_{i}"
        docs.append((100 + k, " ".join(own[random.randint(0, 5):])))
    docs += [(200, None), (201, " \n"), (202, docs[50][1].upper()), (203, "z")]
    sets = _sets(docs, shingle)
    links = {a: {b for b in sets if b != a and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])} for a in sets}
    df = spark.createDataFrame(docs, "id long, text string")
    got = {r.doc: r for r in neardup.exact_links(df, "id", "text", shingle).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(v) for i, v in links.items()}
    for i, r in got.items():
        reached, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - reached)
            reached |= new
        assert r.representative == min(reached)
        g = r.representative
        assert abs(r.dist - (1 - len(sets[i] & sets[g]) / len(sets[i] | sets[g]) if sets[i] else 0)) < 1e-9


def test_only_sets_that_may_link_are_verified(spark, monkeypatch):
    """Long texts with a passage in common, but not alike: they share keys, yet
    no token set is sent to meet another."""
    from ledgerlens.operators import neardup
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(k, passage + " " + " ".join(f"t{k}_{i}" for i in range(60))) for k in range(20)] + [(50, "t0_0 " * 3)]
    met, cut = [], neardup.cut_lineage

    def spy(df, name="stage"):
        out = cut(df, name)
        if name in ("neardup-met", "neardup-shared"):
            met.append((name, out.count()))
        return out
    monkeypatch.setattr(neardup, "cut_lineage", spy)
    # as for shingles too rare to be followed by the sketch of a large table
    monkeypatch.setattr(neardup, "frequent_tokens", lambda sets: [])
    sets, _ = neardup.collapsed(neardup.shingle_hashes(spark.createDataFrame(docs, "id long, text string"), "id", "text"))
    assert neardup.all_links(neardup.prefix_postings(sets), sets).count() == 0
    assert [n for name, n in met if name == "neardup-shared"][0] > 0
    assert [n for name, n in met if name == "neardup-met"] == [0]


def test_files_of_a_segment_do_not_multiply_with_its_buckets(spark):
    from ledgerlens.streaming import logstore
    target = scratch_path(spark, "log-files")
    layout = {"fanout": 2, "buckets": 1, "bucket_rows": 5}
    for i in range(2):
        rows = spark.range(i * 400, i * 400 + 500).select(F.col("id").cast("string").alias("k"), F.lit(i).cast("long").alias("t"), F.col("id").alias("v"))
        logstore.upsert(spark, target, rows, "k", ["t"], ("s", i), **layout)
    (only,) = logstore.newest(spark, target).segments
    assert only.buckets >= 128 and only.rows == 900
    files = [x for x in children(spark, only.path) if x.endswith(".parquet")]
    assert 1 <= len(files) <= 16 and not [x for x in children(spark, only.path) if x.startswith(logstore.BUCKET)]
    # a file holds whole buckets, in order
    for f in files:
        rows = spark.read.parquet(f"{only.path}/{f}").select(logstore.BUCKET, logstore.HASH).collect()
        assert [r[1] for r in rows] == sorted(r[1] for r in rows) and all(r[1] * only.buckets >> logstore.HASH_BITS == r[0] for r in rows)
    assert {(r.k, r.t) for r in logstore.lookup(spark, target, ["3", "450", "899", "none"]).collect()} == {("3", 0), ("450", 1), ("899", 1)}
    assert logstore.read(spark, target).count() == 900


def test_stored_rows_are_read_in_bounded_parts(spark, monkeypatch):
    from ledgerlens.operators import ml
    from ledgerlens.session import cut_lineage
    name = "spark.sql.files.minPartitionNum"
    monkeypatch.setattr(ml, "PART_ROWS", 1000)
    old, cost = spark.conf.get(name, None), spark.conf.get("spark.sql.files.openCostInBytes")
    t = cut_lineage(spark.range(30000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).coalesce(1), "fine", **{"parquet.block.size": "65536"})
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        with ml.fine_splits(spark, 30000):
            again = spark.read.parquet(t.inputFiles()[0])
            sizes = [r["count"] for r in again.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert ml.partitions(again) >= 30
        assert max(sizes) < 6000 and sum(sizes) == 30000
        with ml.fine_splits(spark, 500):
            assert spark.conf.get(name, None) == old
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert spark.conf.get(name, None) == old


def test_exact_distinct_reads_columns_apart(spark):
    from ledgerlens.operators import sketches as sk
    df = spark.createDataFrame([(1, "a", 0.0, None), (1, None, -0.0, None), (2, "b", 0.0, None)], "i long, s string, x double, none string")
    out = sk.exact_distinct(df)
    assert {r.column_name: r.exact_distinct for r in out.collect()} == {"i": 2, "s": 2, "x": 2}
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()


def test_split_files_are_compressed_well(spark):
    from ledgerlens.sources.sinks import read_split, write_split
    df = spark.range(1000).select("id", (F.col("id") % 2 == 0).alias("even"))
    path = write_split(df, "even", scratch_path(spark, "split"))
    assert all(f.endswith(".zstd.parquet") or ".zstd." in f for f in read_split(spark, path, "even").inputFiles())
    assert read_split(spark, path, "even").where("even").count() == 500


@pytest.fixture
def ledger_tables(spark, tmp_path):
    """Small ledger tables with null keys and texts, repeated keys, and rows that meet none."""
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "R0"), (1, "R1")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0), (1, "N1", 1), (2, "N2", 7)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"c{i}", i % 3, 1.0 * i, "S\"é\\" if i % 2 else None) for i in range(9)] + [(1, "again", 0, 0.0, "T"), (None, "x", 1, 0.0, "S")]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"red  ink {i}", f"b{i % 2}", None if i == 4 else f"t{i}", i * 2, 1.5) for i in range(6)] + [(2, "twice", "b9", "t9", None, 2.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(i, None if i == 5 else i % 11, "O", 2.0, None, "1") for i in range(14)] + [(3, 1, "F", 2.0, None, "2")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(None if i == 7 else i % 16, i % 7, None if i % 5 == 0 else i, i % 4, None if i == 8 else i / 3, 1e10 / (i + 1), 0.0, 0.0, "N", "O",
                       None if i == 9 else datetime(1994 + i % 10, 1 + i % 12, 28)) for i in range(60)] * 2),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def no_broadcast(spark):
    """As for tables too large to be broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.set(n, v) if v else spark.conf.unset(n)


def _under(df, what):
    """The parts of the plan that feed an operator whose line has ``what``."""
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in df._jdf.queryExecution().executedPlan().toString().splitlines()]
    for i, (depth, line) in enumerate(lines):
        if what in line:
            below = next((j for j in range(i + 1, len(lines)) if lines[j][0] <= depth), len(lines))
            yield "\n".join(x for _, x in lines[i + 1:below])


def test_exported_documents_are_whole_without_broadcasts(spark, ledger_tables, no_broadcast):
    import duckdb

    import __spark_entry__ as E
    from oracle_check import rows_of
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ledger_tables}/{t}.parquet/*.parquet')")
    for name in ("export_json_roundtrip", "export_documents"):
        want = con.execute(E.oracle_sql()[name])
        cols = [c[0] for c in want.description]
        got = E.queries()[name](spark, ledger_tables).select(*cols).collect()
        want = want.fetchall()
        assert len(got) == len(want) > 40 and rows_of(cols, got) == rows_of(cols, want)


def test_lines_are_not_shuffled_by_customer_for_the_ledger(spark, ledger_tables, no_broadcast):
    from ledgerlens.plans import fixtures as fx
    plan = fx.tx_plan(spark, ledger_tables)
    by_part, = _under(plan, "Exchange hashpartitioning(l_partkey")
    assert "l_quantity" in by_part and "n_name" not in by_part and "r_name" not in by_part
    by_customer = list(_under(plan, "Exchange hashpartitioning(o_custkey"))
    assert by_customer and not any("l_quantity" in x for x in by_customer)


def test_texts_of_documents_are_made_after_their_shuffle(spark, ledger_tables, no_broadcast):
    from ledgerlens.plans.dashboard_queries import docs
    plan = docs(spark, ledger_tables)
    by_customer = list(_under(plan, "Exchange hashpartitioning(cust_key"))
    assert any("quantity" in x for x in by_customer) and not any("concat" in x for x in by_customer)
    assert "concat_ws" in plan._jdf.queryExecution().executedPlan().toString()


def test_export_goes_through_the_ledger_once(spark, ledger_tables):
    """No table of all the ledger's columns is written for it; one that is there is read."""
    import __spark_entry__ as E
    from ledgerlens.plans import fixtures as fx
    from oracle_check import rows_of
    export, before = E.queries()["export_json_roundtrip"], dict(fx._LEDGERS)
    first = export(spark, ledger_tables).collect()
    assert fx._LEDGERS == before
    rows = fx.tx(spark, ledger_tables)
    assert fx.tx_once(spark, ledger_tables).inputFiles() == rows.inputFiles()
    assert rows_of(rows.columns, rows.collect()) == rows_of(rows.columns, fx.tx_plan(spark, ledger_tables).collect())
    again = export(spark, ledger_tables)
    assert rows_of(again.columns, first) == rows_of(again.columns, again.collect())


def test_gzip_json_files_are_bounded_and_fast(spark):
    from ledgerlens.sources.sinks import write_json_gz
    df = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("the same words again and again").alias("y")).coalesce(1)
    path = write_json_gz(df, scratch_path(spark, "json-gz"), rows_per_file=2000)
    files = [f"{path}/{x}" for x in children(spark, path) if x.endswith(".json.gz")]
    raw = [open(f, "rb").read() for f in files]
    assert sorted(gzip.decompress(x).count(b"\n") for x in raw) == [1000, 2000, 2000]
    # the fastest level packs less than the usual one
    assert all(len(x) > 1.02 * len(zlib.compress(gzip.decompress(x), 6)) for x in raw)
    assert spark.read.schema(df.schema).json(path).exceptAll(df).count() == 0 and spark.read.json(path).count() == 5000
