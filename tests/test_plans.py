"""Plan shape: no Python UDFs, no cartesian products, pushed filters, pruned
reads, bounded dimensions broadcast."""

import pytest

import __spark_entry__ as E
from conftest import SMALL

Q = E.queries()
# queries whose plans are built without running side jobs first
PLAN_QUERIES = sorted(n for n in list(E.oracle_sql()) + ["rf_predict"]
                      if n not in {"split_counts", "export_json_roundtrip", "sample_extract",
                                   "csv_strict_roundtrip", "schema_drift_union", "json_ingest",
                                   "stream_upsert", "json_broken_lines", "stream_second_load",
                                   "stream_compacted", "stream_log_costs", "sample_bottom_k", "quarantine_scan", "kmeans_models"}
                      and not n.startswith("op"))  # the numbered operators have tests of their own


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan_text(Q[name](spark, SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns(spark):
    from ledgerlens.plans import fixtures as fx
    p = plan_text(fx.tx_plan(spark, SMALL).select("quantity"))
    # lineitem is read for quantity and the join keys only
    line = [ln for ln in p.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert line and "l_tax" not in line[0] and "l_shipdate" not in line[0]
    # the written ledger is read for the needed columns only
    p = plan_text(Q["kpi_total"](spark, SMALL))
    line = [ln for ln in p.splitlines() if "ledger-" in ln and "ReadSchema" in ln]
    assert line and "buyer_county" not in line[0] and "quantity" in line[0]


def test_time_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    from ledgerlens.operators import dashboard as db
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    f = db.time_range(li, "l_shipdate", "1996-01-01 08:00:00", "1997-01-01 08:00:00")
    p = plan_text(f.select("l_quantity"))
    assert "PushedFilters" in p and "l_shipdate" in p.split("PushedFilters")[1][:300]


def test_bounded_dimensions_broadcast(spark):
    from ledgerlens.plans import fixtures as fx
    p = plan_text(fx.tx_plan(spark, SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
