"""User-level jobs (E1-E9): the operators composed into path-to-path steps.

Each job reads Parquet (``stage1`` and the crosswalk also delimited text) from
paths, runs one plan and writes Parquet/JSON, like the reference's command-line programs, but with
column names and thresholds as parameters (``Cols``) instead of constants.
User-supplied tables (population, coordinates) carry no size guarantee, so
their joins are left to the optimizer and AQE's runtime broadcast check.

    python -m ledgerlens.plans.jobs stage1   src=... schema=... good=... bad=...
    python -m ledgerlens.plans.jobs resolve  fact=... dim=... xwalk=... out=...
    python -m ledgerlens.plans.jobs agg      resolved=... pop=... out=...
    python -m ledgerlens.plans.jobs window   agg=... out=...
    python -m ledgerlens.plans.jobs train    windowed=... model=...
    python -m ledgerlens.plans.jobs predict  windowed=... model=... out=...
    python -m ledgerlens.plans.jobs report   predictions=... out=...
    python -m ledgerlens.plans.jobs cluster  resolved=... pop=... out=... ks=4,8
    python -m ledgerlens.plans.jobs export   resolved=... pop=... coords=... out=...
    python -m ledgerlens.plans.jobs load     src=... target=... checkpoint=...
"""

from __future__ import annotations

import inspect
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import value_for_year, week_index, year_index
from ledgerlens.functions.keys import hash_split
from ledgerlens.operators import aggregate as agg
from ledgerlens.operators import dashboard as db
from ledgerlens.operators import ml
from ledgerlens.operators import profile as pf
from ledgerlens.operators import resolve as rs
from ledgerlens.operators.history import history, to_vector
from ledgerlens.operators.nulls import drop_nulls, fill_nulls
from ledgerlens.session import cut_lineage
from ledgerlens.sources.csv import scan_csv, scan_quarantined
from ledgerlens.sources.sinks import read_split, write_json_gz, write_parquet, write_split
from ledgerlens.streaming import ingest as ig


@dataclass
class Cols:
    """Column names of the ledger, the place dimension and the crosswalk."""
    state: str = "buyer_state"
    county: str = "buyer_county"
    zip: str = "buyer_zip"
    date: str = "tx_date"
    qty: str = "quantity"
    strength: str = "strength"
    item: str = "category"          # the drug name in the reference
    dim_id: str = "dim_id"
    dim_state: str = "dim_state"
    dim_name: str = "dim_name"
    xw_key: str = "zip"
    xw_state: str = "xw_state"
    xw_name: str = "xw_county"
    pop_key: str = "nation_key"     # key joining a ledger row to its population row
    pop_cols: list = field(default_factory=lambda: [f"pop_y{i}" for i in range(7)])
    epoch: str = "1995-01-01"
    flag: str = "has_match"
    doc_id: str = "doc_id"


def stage1(spark: SparkSession, src: str, schema, good: str, bad: str, c: Cols = Cols(), sep: str = "\t", null_token: str = "null",
           date_format: str = "MMddyyyy", row_id: str = "row_id") -> str:
    """The delimited ledger (plain, gzip or bzip2) with its types; records
    that fit are numbered, blank places filled and written to ``good``, all
    others with file and reason to ``bad``.  ``good`` is what ``resolve`` reads."""
    scan_quarantined(spark, src, schema, good, bad, sep=sep, null_token=null_token, date_format=date_format, row_id=row_id,
                     fill={c.state: "", c.county: ""})
    return good


def resolve(spark: SparkSession, fact: str, dim: str, xwalk: str, out: str,
            c: Cols = Cols(), carry_blank_keys: bool = True, fuzzy: str = "exact", xwalk_schema: str = "") -> str:
    """The three-stage cascade, written once split by the match flag
    (``fuzzy="lsh"`` for the MinHash fuzzy stage).  With ``xwalk_schema`` the
    crosswalk is header CSV of that schema, scanned strictly, else Parquet."""
    crosswalk = scan_csv(spark, xwalk, xwalk_schema) if xwalk_schema else spark.read.parquet(xwalk)
    r = rs.resolve_cascade(spark.read.parquet(fact), spark.read.parquet(dim),
                           crosswalk, c.state, c.county, c.zip,
                           dim_id=c.dim_id, dim_block=c.dim_state, dim_name=c.dim_name,
                           carry_blank_keys=carry_blank_keys, flag=c.flag,
                           xw_key=c.xw_key, xw_block=c.xw_state, xw_name=c.xw_name,
                           fuzzy=fuzzy)
    return write_split(r, c.flag, out)


def weekly_from(resolved: DataFrame, pop: DataFrame, c: Cols = Cols()) -> DataFrame:
    """Matched rows only (the flag partition prunes the rest), population
    of the row's year, weekly aggregate and per-capita rate."""
    m = resolved.where(F.col(c.flag))
    j = m.join(pop, c.pop_key) if pop is not None else m
    yi = year_index(c.date, c.epoch)
    keys = {c.pop_key: c.pop_key, c.item: c.item, "week_index": week_index(c.date, c.epoch),
            "year_index": yi, "population": value_for_year(yi, c.pop_cols),
            "dosage_strength": c.strength}
    w = agg.period_agg(j, keys, c.qty, c.strength)
    return w.withColumn("pill_count_per_capita", agg.rate("pill_count", "population"))


def aggregate(spark: SparkSession, resolved: str, pop: str, out: str, c: Cols = Cols()) -> str:
    return write_parquet(weekly_from(read_split(spark, resolved, c.flag),
                                     spark.read.parquet(pop), c), out)


def window(spark: SparkSession, agg_path: str, out: str, c: Cols = Cols(), n: int = 13) -> str:
    """E5: drop incomplete rows, lag list of the rate, as an ML vector."""
    a = drop_nulls(spark.read.parquet(agg_path))
    h = history(a, [c.pop_key, c.item], "week_index", "pill_count_per_capita", n=n,
                tie_break=("year_index", "dosage_strength"), out="history")
    return write_parquet(to_vector(h, "history"), out)


def _split(df: DataFrame, c: Cols):
    return hash_split(df, [c.pop_key, c.item, "week_index", "year_index", "dosage_strength"], 0.7)


def train(spark: SparkSession, windowed: str, model: str, c: Cols = Cols(), trees=(50, 100),
          depths=(7, 11), folds: int = 5) -> str:
    """E7 train: features + cross-validated forest on the 70 % split, saved."""
    from pyspark.ml import Pipeline
    tr, _ = _split(drop_nulls(spark.read.parquet(windowed)), c)
    cats = [c.item, c.pop_key]
    tr = tr.withColumn(c.pop_key, F.col(c.pop_key).cast("string"))
    feats = ml.feature_pipeline(cats, ["week_index", "year_index", "population", "dosage_strength"],
                                vector_cols=["history"], max_categories=4).fit(tr)
    cv = ml.train_forest(feats.transform(tr), "pill_count_per_capita", trees=trees, depths=depths,
                         folds=folds)
    pm = Pipeline(stages=[feats, cv.bestModel]).fit(tr)
    return ml.save_model(pm, model)


def predict(spark: SparkSession, windowed: str, model: str, out: str, c: Cols = Cols()) -> str:
    """E7 predict: score both splits with the saved pipeline, one table with a
    split label."""
    m = ml.load_pipeline(model)
    w = drop_nulls(spark.read.parquet(windowed)).withColumn(c.pop_key, F.col(c.pop_key).cast("string"))
    tr, te = _split(w, c)
    p = (m.transform(tr).withColumn("split", F.lit("train"))
         .unionByName(m.transform(te).withColumn("split", F.lit("test"))))
    keep = [x for x in p.columns if x not in ("features", "assembled", "history")
            and not x.endswith("_one_hot")]
    return write_parquet(p.select(*keep), out)


def report(spark: SparkSession, predictions: str, out: str, c: Cols = Cols(), n: int = 100, model: str = "", windowed: str = "") -> str:
    """E7 stats + report: RMSE per split, the anomalies outside +/- 1 stddev
    and their ranking by count per key, descriptive statistics of label and
    prediction; with the saved ``model`` and its ``windowed`` input also the
    named importances."""
    p = spark.read.parquet(predictions)
    y, yhat = "pill_count_per_capita", "pill_count_per_capita_prediction"
    a = spark.read.parquet(write_parquet(agg.anomalies(p, y, yhat), out + "/anomalies"))
    write_parquet(pf.describe(p, [y, yhat]), out + "/describe")
    if model:
        m = ml.load_pipeline(model)
        # one row carries the slots' names
        row = drop_nulls(spark.read.parquet(windowed)).limit(1).withColumn(c.pop_key, F.col(c.pop_key).cast("string"))
        forest = next(s for s in m.stages if hasattr(s, "featureImportances"))
        write_parquet(ml.importances(forest, m.transform(row), "features").coalesce(1), out + "/importances")
    write_parquet(p.groupBy("split").agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2))).alias("rmse")),
                  out + "/rmse")
    return write_parquet(agg.rank_anomalies(a, c.pop_key, y, yhat, n=n), out + "/ranked")


def cluster(spark: SparkSession, resolved: str, pop: str, out: str, ks=(20, 40), c: Cols = Cols(),
            cats=("segment", "category", "region"), label: str | None = None, prep: str = "", models: str = "") -> str:
    """Clustering prep (project, calendar, population, fill nulls; kept as
    a table at ``prep`` if given), one encoded matrix, KMeans sweep -> metrics
    table (k, cost, weighted entropy); ``models`` keeps a pipeline per k, from
    raw rows to clusters and decoded categories."""
    r = read_split(spark, resolved, c.flag).where(F.col(c.flag))
    r = r.join(spark.read.parquet(pop), c.pop_key)
    yi = year_index(c.date, c.epoch)
    rows = r.select(*cats, week_index(c.date, c.epoch).alias("week_index"),
                    value_for_year(yi, c.pop_cols).alias("population"), c.strength, c.qty)
    rows = fill_nulls(rows, {**{x: "N/A" for x in cats}, c.strength: 0.0, "week_index": 0,
                             "population": 0, c.qty: 0.0})
    rows = spark.read.parquet(write_parquet(rows, prep)) if prep else cut_lineage(rows, "cluster-prep")
    encoder = ml.feature_pipeline(list(cats), ["week_index", c.strength, "population", c.qty], scale=True).fit(rows)

    def save(k, model):
        if models:
            ml.save_model(ml.cluster_model(encoder, model, list(cats)), f"{models}/{k}")

    return write_parquet(ml.kmeans_sweep(encoder.transform(rows), ks, label=label or c.qty, save=save), out)


def export(spark: SparkSession, resolved: str, pop: str, coords: str, out: str, c: Cols = Cols(),
           coord_key: str = "cust_key", id_cols=("order_key", "line_no", "part_key", "supp_key")) -> str:
    """Matched rows + population + coordinates, gzip line JSON, with a
    document id that is the md5 of the row's identifying columns."""
    from ledgerlens.functions.keys import row_text
    r = read_split(spark, resolved, c.flag).where(F.col(c.flag))
    if isinstance(id_cols, str):
        id_cols = id_cols.split(",")
    r = r.withColumn(c.doc_id, F.md5(row_text(list(id_cols))))
    r = r.join(spark.read.parquet(pop), c.pop_key)
    r = r.withColumn("population", value_for_year(year_index(c.date, c.epoch), c.pop_cols)) \
         .drop(*c.pop_cols)
    e = db.export_documents(r, spark.read.parquet(coords), coord_key)
    return write_json_gz(e, out)


def load(spark: SparkSession, src: str, target: str, checkpoint: str, schema,
         c: Cols = Cols(), order=None, lat: str = "latitude", lon: str = "longitude") -> str:
    """Stream the exported files into a keyed, versioned target (latest
    per document id by ``order``, default the transaction date)."""
    s = ig.ingest_json(spark, src, schema, id_col=c.doc_id, lat=lat, lon=lon)
    ig.upsert_stream(s, target, c.doc_id, list(order or (c.date,)), checkpoint)
    return target


JOBS = {"stage1": stage1, "resolve": resolve, "agg": aggregate, "window": window, "train": train,
        "predict": predict, "report": report, "cluster": cluster, "export": export, "load": load}


def parse_options(job, words) -> dict:
    """``key=value`` words as the job's parameters declare them: by the type of
    the default, comma lists for sequences; an unknown name is an error."""
    known = inspect.signature(job).parameters
    out = {}
    for word in words:
        name, eq, text = word.partition("=")
        if not eq or name not in known or name in ("spark", "c"):
            raise SystemExit(f"unknown option {word!r} of {job.__name__}")
        default = known[name].default
        if isinstance(default, bool):
            if text.lower() not in ("true", "false"):
                raise SystemExit(f"{name} takes true or false")
            out[name] = text.lower() == "true"
        elif isinstance(default, (int, float)):
            out[name] = type(default)(text)
        elif isinstance(default, (tuple, list)):
            kind = type(default[0]) if default else str
            out[name] = tuple(kind(x) for x in text.split(",") if x)
        else:
            out[name] = text
    return out


def main(argv) -> None:
    from ledgerlens.session import get_session
    if len(argv) < 2 or argv[1] not in JOBS:
        raise SystemExit(f"usage: jobs <{'|'.join(JOBS)}> key=value ...")
    kwargs = parse_options(JOBS[argv[1]], argv[2:])
    spark = get_session()
    JOBS[argv[1]](spark, **kwargs)


if __name__ == "__main__":
    main(sys.argv)
