"""The path-to-path jobs chained end to end on fixture tables."""

from pyspark.sql import functions as F

from conftest import SMALL
from ledgerlens.plans import fixtures as fx
from ledgerlens.plans import jobs
from ledgerlens.session import scratch_path


def test_job_chain(spark):
    def put(df, name):
        p = scratch_path(spark, name)
        df.write.parquet(p)
        return p
    fact = put(fx.tx(spark, SMALL), "fact")
    dim = put(fx.name_dim(spark, SMALL), "dim")
    xw = put(fx.crosswalk(spark, SMALL), "xw")
    pop = put(fx.pop_wide(spark, SMALL), "pop")
    coords = put(fx.geo(spark, SMALL), "geo")
    res = jobs.resolve(spark, fact, dim, xw, scratch_path(spark, "resolved"))
    from ledgerlens.sources.sinks import read_split
    r = read_split(spark, res, "has_match")
    assert r.count() == spark.read.parquet(fact).count()
    agg = jobs.aggregate(spark, res, pop, scratch_path(spark, "agg"))
    win = jobs.window(spark, agg, scratch_path(spark, "win"))
    assert spark.read.parquet(win).count() > 0
    model = jobs.train(spark, win, scratch_path(spark, "model"), trees=(5,), depths=(3,), folds=2)
    pred = jobs.predict(spark, win, model, scratch_path(spark, "pred"))
    assert {r.split for r in spark.read.parquet(pred).select("split").distinct().collect()} == {"train", "test"}
    out = scratch_path(spark, "report")
    rep = jobs.report(spark, pred, out, model=model, windowed=win)
    assert spark.read.parquet(rep).count() > 0
    n_scored = spark.read.parquet(pred).count()
    assert 0 < spark.read.parquet(out + "/anomalies").count() < n_scored
    assert {r.n for r in spark.read.parquet(out + "/describe").collect()} == {n_scored}
    imp = spark.read.parquet(out + "/importances").collect()
    assert abs(sum(r.importance for r in imp) - 1) < 1e-9 and "week_index" in {r.feature for r in imp}
    prep, models = scratch_path(spark, "prep"), scratch_path(spark, "models")
    cl = jobs.cluster(spark, res, pop, scratch_path(spark, "cluster"), ks=(3, 5), prep=prep, models=models)
    from ledgerlens.operators.ml import load_pipeline
    rows = spark.read.parquet(prep)
    back = load_pipeline(models + "/5").transform(rows)
    assert back.where("category <> category_converted").count() == 0 and back.agg(F.max("cluster")).first()[0] <= 4
    assert [r.k for r in spark.read.parquet(cl).orderBy("k").collect()] == [3, 5]
    ex = jobs.export(spark, res, pop, coords, scratch_path(spark, "export"))
    docs = spark.read.json(ex)
    n = docs.count()
    assert n == r.where(F.col("has_match")).count()
    target = jobs.load(spark, ex, scratch_path(spark, "index"), scratch_path(spark, "ck"), docs.schema)
    from ledgerlens.streaming.ingest import read_current
    cur = read_current(spark, target)
    assert cur.count() == docs.select("doc_id").distinct().count()
    assert "location" in cur.columns


def test_stage1_from_compressed_text(spark):
    """bzip2 TSV with header, null tokens and broken records -> numbered, filled
    rows and a quarantine -> the cascade with a CSV crosswalk."""
    cols = ["order_key", "buyer_state", "buyer_county", "buyer_zip", "tx_date", "quantity"]
    t = fx.tx(spark, SMALL).select(*cols)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols}
    text["buyer_county"] = F.when(F.col("buyer_county") == "", "null").otherwise(F.col("buyer_county"))
    text["tx_date"] = F.when(F.col("order_key") % 7 == 0, "99999999").otherwise(F.date_format("tx_date", "MMddyyyy"))
    text["quantity"] = F.when(F.col("order_key") % 11 == 0, "many").otherwise(text["quantity"])
    src, good, bad = (scratch_path(spark, n) for n in ("stage1-text", "stage1-good", "stage1-bad"))
    t.select(*(v.alias(c) for c, v in text.items())).write.option("sep", "\t").option("header", "true").option("compression", "bzip2").csv(src)
    schema = "order_key long, buyer_state string, buyer_county string, buyer_zip string, tx_date date, quantity double"
    assert jobs.stage1(spark, src, schema, good, bad) == good
    ok, no = spark.read.parquet(good), spark.read.parquet(bad)
    broken = (F.col("order_key") % 7 == 0) | (F.col("order_key") % 11 == 0)
    assert ok.count() == t.where(~broken).count() and no.count() == t.where(broken).count()
    assert ok.select("row_id").distinct().count() == ok.count()
    assert ok.where("buyer_county is null").count() == 0 and ok.where("buyer_county = ''").count() == t.where(~broken).where("buyer_county = ''").count()
    assert ok.agg(F.sum("quantity")).first()[0] == t.where(~broken).agg(F.sum("quantity")).first()[0]
    why = {r.reason: r["count"] for r in no.groupBy("reason").count().collect()}
    assert set(why) == {"unreadable: tx_date", "unreadable: quantity", "unreadable: tx_date, quantity"}
    assert all(r.file.endswith(".bz2") and r.line for r in no.select("file", "line").limit(20).collect())
    dim, xw = scratch_path(spark, "stage1-dim"), scratch_path(spark, "stage1-xw")
    fx.name_dim(spark, SMALL).write.parquet(dim)
    fx.crosswalk(spark, SMALL).write.option("header", "true").csv(xw)
    res = jobs.resolve(spark, good, dim, xw, scratch_path(spark, "stage1-resolved"), xwalk_schema="zip string, xw_state string, xw_county string, decommissioned int")
    from ledgerlens.sources.sinks import read_split
    stages = {r.match_stage: r["count"] for r in read_split(spark, res, "has_match").groupBy("match_stage").count().collect()}
    assert sum(stages.values()) == ok.count() and {"exact", "fuzzy", "crosswalk"} <= set(stages)
