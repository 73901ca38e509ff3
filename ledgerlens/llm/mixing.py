"""Mixing sources to target weights by entropy balancing.

For every source the document rates r minimise the relative entropy
``sum r ln r - r + 1`` to one copy each, subject to ``sum r * size = target``
and ``r <= max_copies``.  The solution is an exponential tilt,
``r = min(max_copies, exp(lambda * size / mean size))``; lambda is the root of
the convex dual's gradient and comes from Newton steps.  Documents of one source and size have
one rate, so a step reads the (source, size) counts, not the documents.

Rates become copies: each document gets its whole part, and one copy more if
a hash of its id, less the rate's fraction, lies under the source's threshold.
The threshold is where the words taken come nearest the target; two rounds of
histograms find it, so a source is never sorted or brought into one task.

Defined cases: null text has size 0 and is never taken; a null source is a
source of its own, ordered last; repeated rows get equal copies; an empty
table gives an empty result; other columns of the input pass through
``mixed`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, unit_hash, word_count

CELLS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float], max_copies: float) -> DataFrame:
    """(source, source_size, target) from (source, size, n).

    Sources in code point order, null last, weigh ``weights`` in turn.  They
    share all words by weight; none gets more than ``max_copies`` times its
    own, the excess being shared again: target = min(cap, weight * level) for
    the one level at which the targets add up.  The windows hold a row per
    source."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"),
                                      F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", max_copies * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) - filled) / weight_left
    per = per.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)
    per = per.withColumn("open", open_level.getField("level"))
    return per.select("source", "source_size", "n_docs", "cap",
                      F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("open"), F.col("cap"))).alias("target"))


def solve_tilts(sizes: DataFrame, targets: DataFrame, max_copies: float, tolerance: float = 1e-7, most_steps: int = 60) -> DataFrame:
    """(source, source_size, target, mean, tilt): Newton on the logarithm of the
    dual's gradient, kept inside a bracket.  A source at its cap or with target 0 needs none (tilt null)."""
    mean = F.col("source_size") / F.col("n_docs")
    state = targets.select("source", "source_size", "target", "cap",
                           F.when(F.col("n_docs") > 0, mean).otherwise(1.0).alias("mean"),
                           ((F.col("target") <= 0) | (F.col("target") >= F.col("cap") * (1 - 1e-12))).alias("done"))
    state = stored(state.withColumns({"tilt": F.lit(0.0), "lo": -745.0 * F.col("mean"), "hi": F.log(F.lit(float(max_copies))) * F.col("mean")}), "mix-state")
    for _ in range(most_steps):
        if not state.where("not done").limit(1).count():
            break
        x = F.col("size") / F.col("mean")
        below = F.col("tilt") * x < F.log(F.lit(float(max_copies)))
        words = F.col("n") * F.col("size") * F.when(below, F.exp(F.col("tilt") * x)).otherwise(float(max_copies))
        moving = sizes.join(state.where("not done").select(F.col("source").alias("s"), "tilt", "mean"), F.col("source").eqNullSafe(F.col("s")))
        sums = moving.groupBy("s").agg(F.sum(words).alias("got"),
                                       F.sum(F.when(below, words * x).otherwise(0.0)).alias("slope"))
        new = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        off = F.log(F.col("got") / F.col("target"))
        lo = F.when(off < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(off > 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - off * F.col("got") / F.col("slope"))
        step = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        there = F.col("done") | (F.abs(off) < tolerance)
        state = stored(new.select("source", "source_size", "target", "cap", "mean", there.alias("done"),
                                  F.when(there, F.col("tilt")).otherwise(step).alias("tilt"), lo.alias("lo"), hi.alias("hi")), "mix-state")
    at_cap = F.col("target") >= F.col("cap") * (1 - 1e-12)
    return state.select("source", "source_size", "target", "mean", (at_cap & (F.col("target") > 0)).alias("full"),
                        F.when(~at_cap & (F.col("target") > 0), F.round("tilt", 9)).alias("tilt"))


def _rate(size: Column, max_copies: float) -> Column:
    power = F.col("tilt") * size / F.col("mean")
    full = F.col("full") | (power >= F.log(F.lit(float(max_copies))))
    return F.when(size <= 0, 0.0).when(full, float(max_copies)).otherwise(F.coalesce(F.exp(power), F.lit(0.0)))


def _cells(size: Column, key: Column, max_copies: float) -> dict[str, Column]:
    """Rate, its whole part and the two histogram cells of a document."""
    rate = _rate(size, max_copies)
    whole = F.floor(rate).cast("long")
    height = (unit_hash(key) / float(1 << 40) - (rate - F.floor(rate)) + 1) * (CELLS / 2)
    cell = F.floor(height)
    return {"rate": rate, "whole": whole, "cell": cell.cast("int"), "part": F.floor((height - cell) * CELLS).cast("int")}


def thresholds(rows: DataFrame, tilts: DataFrame, max_copies: float) -> DataFrame:
    """Adds (cell, part) to the sources: a document whose cells lie below gets one copy more than its rate's whole part."""
    j = rows.join(tilts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    j = j.select("s", "size", *[c.alias(n) for n, c in _cells(F.col("size"), F.col("key"), max_copies).items()])
    extra = F.when(F.col("whole") < max_copies, F.col("size")).otherwise(0)
    coarse = stored(j.groupBy("s", "cell").agg(F.sum(extra).alias("w"), F.sum(F.col("whole") * F.col("size")).alias("base")), "mix-cells")
    need = coarse.groupBy("s").agg(F.sum("base").alias("base")).join(tilts.select(F.col("source").alias("t"), "target"), F.col("s").eqNullSafe(F.col("t")))
    need = need.select("t", (F.col("target") - F.col("base")).alias("need"))
    run = Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    at = coarse.withColumn("upto", F.sum("w").over(run)).join(need, F.col("s").eqNullSafe(F.col("t"))).where("upto >= need")
    at = at.groupBy("t").agg(F.min(F.struct("cell", (F.col("need") - F.col("upto") + F.col("w")).alias("left"))).alias("x"))
    at = stored(at.select("t", F.col("x.cell").alias("at"), "x.left"), "mix-at")
    fine = j.join(at, F.col("s").eqNullSafe(F.col("t")) & (F.col("cell") == F.col("at")))
    fine = fine.groupBy("t", "part").agg(F.sum(extra).alias("w"), F.first("left").alias("left"))
    run = Window.partitionBy("t").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    fine = fine.withColumn("upto", F.sum("w").over(run))
    best = fine.groupBy("t").agg(F.min(F.struct(F.abs(F.col("upto") - F.col("left")).alias("off"), "part")).alias("x"), F.first("left").alias("left"))
    best = best.select(F.col("t").alias("b"), F.when(F.abs(F.col("left")) <= F.col("x.off"), -1).otherwise(F.col("x.part")).alias("last_part"))
    out = tilts.join(at, F.col("source").eqNullSafe(F.col("t")), "left").join(best, F.col("source").eqNullSafe(F.col("b")), "left")
    # no cell reaches the need: everything below the top is taken
    return stored(out.select("source", "source_size", "target", "mean", "full", "tilt", F.coalesce("at", F.lit(CELLS)).alias("last_cell"),
                             F.coalesce("last_part", F.lit(-1)).alias("last_part")), "mix-plan")


def plan_mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
             weights: Sequence[float] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """Fit the mix: one row per source with target, tilt and threshold."""
    rows = stored(docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")), "mix-rows")
    return plan_rows(rows, weights, max_copies)


def plan_rows(rows: DataFrame, weights: Sequence[float] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """As :func:`plan_mix`, from (key, source, size)."""
    sizes = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = source_targets(sizes, weights, max_copies)
    return thresholds(rows, solve_tilts(sizes, targets, max_copies), max_copies)


def copies_of(size: Column, key: Column, max_copies: int = 3) -> tuple[Column, Column]:
    """(rate, copies) on rows that carry their source's plan."""
    c = _cells(size, key, max_copies)
    below = (c["cell"] < F.col("last_cell")) | ((c["cell"] == F.col("last_cell")) & (c["part"] <= F.col("last_part")))
    return c["rate"], F.when(size <= 0, 0).otherwise(F.least(c["whole"] + below.cast("long"), F.lit(max_copies))).cast("long")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: Sequence[float] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """Per document: key, source, size, source_size, target, rate, copies, taken."""
    rows = stored(docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")), "mix-rows")
    plan = plan_rows(rows, weights, max_copies).withColumnRenamed("source", "s")
    rate, copies = copies_of(F.col("size"), F.col("key"), max_copies)
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
                .select(F.col("key").alias(key), "source", "size", "source_size", "target", rate.alias("rate"), copies.alias("copies"))
                .withColumn("taken", F.col("copies") * F.col("size")))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
          weights: Sequence[float] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """The mixed corpus itself: the rows of ``docs``, each as often as the mix takes it."""
    plan = plan_mix(docs, text, source, key, weights, max_copies)
    plan = plan.select(*[F.col(c).alias(c if c in ("mean", "full", "tilt", "last_cell", "last_part") else f"__{c}") for c in plan.columns])
    inner = docs.select(F.struct(*docs.columns).alias("row"))
    size = word_count(F.col(f"row.{text}"))
    j = inner.join(plan, F.col(f"row.{source}").cast("string").eqNullSafe(F.col("__source"))).withColumn("size", size)
    _, copies = copies_of(F.col("size"), F.col(f"row.{key}"), max_copies)
    # no filter on the copies: pushed below, it would count the words again for each use of the size
    return j.withColumn("copies", copies).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
