"""Summarise the executed physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles (Exchange hashpartitioning / range / single),
broadcasts, join strategies, windows, sort-based aggregates, Python
evaluation nodes, and whether every Parquet scan prunes columns.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "shuffle": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)",
    "single": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "nlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow\b",
    "sortagg": r"SortAggregate",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def _top_level_fields(schema: str) -> int:
    depth, n = 0, 1
    body = schema[len("struct<"):]
    for ch in body:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            if depth == 0:
                break
            depth -= 1
        elif ch == "," and depth == 0:
            n += 1
    return n


def final_plan(df) -> str:
    df.collect() if df.count() < 200000 else df.write.format("noop").mode("overwrite").save()
    p = df._jdf.queryExecution().executedPlan().toString()
    # keep the final adaptive plan only
    if "== Final Plan ==" in p:
        p = p.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return p


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as E
    from ledgerlens.session import get_session
    spark = get_session("local[8]", 16)
    qs = E.queries()
    print(f"# Physical plans at {sf_dir} (local[8], AQE on)\n")
    print("Counts are nodes of the final adaptive plan of each registered query "
          "(the query's own plan; jobs it ran before, such as written intermediates, "
          "are not included).  `pruned` = scans reading fewer columns than the file has / all scans.\n")
    print("Reading notes: queries scan the flat ledger table written once per data directory "
          "(its own derivation, lineitem-orders-customer-part, is a separate job).  At this scale "
          "the remaining join partners (population, coordinates, resolution mapping, dimension) "
          "fit under AQE's runtime broadcast threshold, so joins show as broadcast hash joins; at "
          "100 TB the ones whose size grows with the data plan as sort-merge joins and only the "
          "bounded tables (nation, region, code list, top-n sets, centroids) stay broadcast.  "
          "`single` exchanges are global one-row aggregates (KPIs, stddev, RMSE, profiles) after "
          "map-side partial aggregation.  `window` nodes run on aggregates or on per-set token "
          "lists, never on raw ledger rows.  No query has a nested-loop join, a cartesian "
          "product or a Python evaluation node.\n")
    cols = list(PATTERNS)
    print("| query | " + " | ".join(cols) + " | pruned |")
    print("|---|" + "---|" * (len(cols) + 1))
    for name in sorted(qs):
        try:
            p = final_plan(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} |")
            continue
        counts = [str(len(re.findall(PATTERNS[c], p))) for c in cols]
        scans = []
        for line in p.splitlines():
            if "FileScan parquet" not in line:
                continue
            m = re.search(r"InMemoryFileIndex\(\d+ paths\)\[([^\],]+).*?ReadSchema: (struct<.*)", line)
            if m:
                scans.append(m.groups())
        full = 0
        for path, schema in scans:
            try:
                n_all = len(spark.read.parquet(path).columns)
            except Exception:  # noqa: BLE001
                continue
            full += _top_level_fields(schema) >= n_all
        pruned = f"{len(scans) - full}/{len(scans)}" if scans else "-"
        print(f"| {name} | " + " | ".join(counts) + f" | {pruned} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
