"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text gives five statistics, transformed towards symmetry: log words, log
mean word length, and the log shares of symbols, repeated lines and repeated
words.  For every group the estimator seeks the three quarters of the vectors
whose covariance has the least determinant: two robust starts (median and
median deviation, by summed and by largest standardised deviation), then
concentration steps, each a histogram of Mahalanobis distances that finds the
quarter to leave out, and one grouped sum of products.  The start with the
smaller determinant wins, one reweighting follows, and a text is rejected if
its squared distance exceeds ``CUTOFF``.

Groups are (language, source); one with fewer than ``LEAST_GROUP`` usable texts
takes the estimates of its language, and failing that of all texts; failing
that too, nothing is rejected.  A variance floor for each statistic keeps
statistics that are constant in a group (often the repeats) from rejecting
small differences.  Only built-in functions are used; groups are only ever
aggregated, so a large one costs no more in one task than its partial sums.

Defined cases: null and empty texts have all counts 0 and fail the base rule;
null language or source is a group value of its own; repeated rows count each
time; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, stored

LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
DIM = 5
COVER = 0.75
LEAST_GROUP = 100
STEPS = 4
#: standard deviations that are always allowed for, by statistic
FLOORS = (0.3, 0.05, 0.4, 0.8, 0.8)
#: chi-square with 5 degrees of freedom: quantile of 0.975 (reweighting) and the rejection limit (beyond 0.99999)
REWEIGHT, CUTOFF = 12.8325, 40.0
#: makes the covariance of the central three quarters, and of 97.5 %, consistent for normal vectors
CENTRAL_FACTOR, REWEIGHT_FACTOR = 1.4125, 1.0529
#: groups (counted) whose estimates are broadcast; beyond that rows meet them by (group, slice)
MOST_BROADCAST, SLICES = 100_000, 64
#: histogram cells of a doubling of the distance
CELLS = 64


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) to the rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    made = docs.withColumns({"__words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), "__lines": lines,
                             "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
                             "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long")})
    made = made.withColumn("n_words", F.size("__words").cast("long"))
    made = made.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")).drop("__lines")
    words = F.col("__words")
    triples = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                          lambda x, i: F.struct(F.concat_ws(" ", x, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))
    made = made.withColumn("__sorted", F.sort_array(triples)).drop("__words")
    ordered = F.col("__sorted")
    same = lambda x, j: F.coalesce(F.get(ordered, j).getField("w") == x.getField("w"), F.lit(False))
    places = F.transform(ordered, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), F.array(x.getField("i"), x.getField("i") + 1, x.getField("i") + 2)))
    covered = F.flatten(F.filter(places, lambda x: x.isNotNull()))
    return made.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).drop("__sorted")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [F.log(words), F.log(chars / words), F.log1p(200 * F.col("n_symbols") / chars), F.log1p(100 * F.col("n_dup_lines") / words),
            F.log1p(100 * F.col("n_repeat_words") / words)]


Z = [f"z{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def _groups() -> list[Column]:
    """Group names, finest first."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("g_lang", "g_source"))
    return [F.concat_ws("\n", F.lit("0"), lang, source), F.concat_ws("\n", F.lit("1"), lang), F.lit("2")]


def _whitening(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Means, inverse Cholesky factor and log determinant from counts, sums and sums of products, column by column."""
    n = F.col("n")
    made = sums.select(*keys, "n", *[F.round(F.col(f"s{i}") / n, 9).alias(f"m{i}") for i in range(DIM)], *[F.col(f"p{i}{j}") / n for i, j in PAIRS])
    made = made.toDF(*keys, "n", *[f"m{i}" for i in range(DIM)], *[f"p{i}{j}" for i, j in PAIRS])
    a = {(i, j): factor * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)) for i, j in PAIRS}
    for j in range(DIM):
        made = made.withColumn(f"c{j}{j}", F.sqrt(F.greatest(a[j, j] - sum((F.col(f"c{j}{k}") * F.col(f"c{j}{k}") for k in range(j)), F.lit(0.0)), F.lit(FLOORS[j] ** 2 / 100))))
        made = made.withColumns({f"c{i}{j}": (a[i, j] - sum((F.col(f"c{i}{k}") * F.col(f"c{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"c{j}{j}") for i in range(j + 1, DIM)} or {"__": F.lit(0)})
    for i in range(DIM):
        made = made.withColumns({f"w{i}{i}": 1 / F.col(f"c{i}{i}")})
        made = made.withColumns({f"w{i}{j}": -sum((F.col(f"c{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"c{i}{i}") for j in range(i)} or {"__": F.lit(0)})
    return made.select(*keys, "n", *[f"m{i}" for i in range(DIM)], *[F.round(f"w{i}{j}", 9).alias(f"w{i}{j}") for i, j in PAIRS],
                       sum((F.log(F.col(f"c{i}{i}")) for i in range(DIM)), F.lit(0.0)).alias("logdet"))


def distance() -> Column:
    """Squared Mahalanobis distance of z under m and w."""
    off = [F.col(f"z{i}") - F.col(f"m{i}") for i in range(DIM)]
    return sum((F.pow(sum((F.col(f"w{i}{j}") * off[j] for j in range(i + 1)), F.lit(0.0)), F.lit(2)) for i in range(DIM)), F.lit(0.0))


def _products() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(z).alias(f"s{i}") for i, z in enumerate(Z)], *[F.sum(F.col(Z[i]) * F.col(Z[j])).alias(f"p{i}{j}") for i, j in PAIRS]]


def _met(rows: DataFrame, groups: DataFrame, on: list[str], few: bool) -> DataFrame:
    """Rows with what belongs to their group, without bringing a group into one task."""
    if few:
        return rows.join(F.broadcast(groups), on)
    rows = rows.withColumn("slice", F.pmod(F.xxhash64(*Z), F.lit(SLICES)))
    groups = groups.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    return rows.join(groups, [*on, "slice"]).drop("slice")


def _central(rows: DataFrame, d2: Column, few: bool) -> DataFrame:
    """Rows of each (g, start) within the distance that covers three quarters."""
    rows = rows.withColumn("cell", F.floor(CELLS * F.log2(1 + d2)).cast("int"))
    cells = rows.groupBy("g", "start", "cell").agg(F.count(F.lit(1)).alias("k"))
    by = Window.partitionBy("g", "start")
    upto = F.sum("k").over(by.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumns({"upto": upto, "all": F.sum("k").over(by)}).where(F.col("upto") >= F.ceil(COVER * F.col("all")))
    last = stored(cells.groupBy("g", "start").agg(F.min("cell").alias("last")), "mcd-last")
    return _met(rows, last, ["g", "start"], few).where("cell <= last")


def estimate(rows: DataFrame) -> DataFrame:
    """(g, n, m*, w*) from (g, z*): the reweighted minimum-covariance-determinant estimates."""
    rows = stored(rows.select("g", *Z), "mcd-rows")
    centre = rows.groupBy("g").agg(*[F.median(F.round(z, 2)).alias(f"m{i}") for i, z in enumerate(Z)])
    centre = stored(centre, "mcd-centre")
    few = centre.count() <= MOST_BROADCAST
    spread = _met(rows, centre, ["g"], few).groupBy("g").agg(*[F.median(F.round(F.abs(F.col(z) - F.col(f"m{i}")), 2)).alias(f"d{i}") for i, z in enumerate(Z)])
    start = stored(centre.join(spread, "g").select("g", *[f"m{i}" for i in range(DIM)], *[F.greatest(1.4826 * F.col(f"d{i}"), F.lit(FLOORS[i])).alias(f"d{i}") for i in range(DIM)]), "mcd-start")
    off = [F.pow((F.col(z) - F.col(f"m{i}")) / F.col(f"d{i}"), F.lit(2)) for i, z in enumerate(Z)]
    both = _met(rows, start, ["g"], few).withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    first = _central(both, F.when(F.col("start") == 0, sum(off[1:], off[0])).otherwise(F.greatest(*off)), few)
    fit = stored(_whitening(first.groupBy("g", "start").agg(*_products()), ["g", "start"], CENTRAL_FACTOR), "mcd-fit")
    for _ in range(STEPS):
        near = _central(_met(rows, fit, ["g"], few).select("g", "start", *Z, distance().alias("d2")), F.col("d2"), few)
        fit = stored(_whitening(near.groupBy("g", "start").agg(*_products()), ["g", "start"], CENTRAL_FACTOR), "mcd-fit")
    least = fit.groupBy("g").agg(F.min(F.struct("logdet", "start")).alias("x")).select("g", F.col("x.start").alias("start"))
    fit = stored(fit.join(least, ["g", "start"]).drop("start"), "mcd-best")
    near = _met(rows, fit, ["g"], few).where(distance() <= REWEIGHT)
    return _whitening(near.groupBy("g").agg(*_products()), ["g"], REWEIGHT_FACTOR).drop("logdet")


def fit(measured: DataFrame) -> DataFrame:
    """Estimates of the groups with enough texts from rows with z*, g_lang, g_source and base_failed."""
    used = measured.where("not base_failed").select(F.explode(F.array(*_groups())).alias("g"), *Z)
    return stored(estimate(used).where(F.col("n") >= LEAST_GROUP), "mcd-groups")


def judge(measured: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds d2 (null without estimates) and kept."""
    marks = ["m%d" % i for i in range(DIM)] + ["w%d%d" % p for p in PAIRS]
    keys = _groups()
    found = measured.withColumns({f"__g{k}": g for k, g in enumerate(keys)})
    few = groups.count() <= MOST_BROADCAST
    for k in range(len(keys)):
        own = groups.where(F.col("g").startswith(str(k))).select(F.col("g").alias(f"__g{k}"), F.struct(*marks).alias(f"__e{k}"))
        found = found.join(F.broadcast(own) if few else own, f"__g{k}", "left")
    est = F.coalesce(*[F.col(f"__e{k}") for k in range(len(keys))])
    found = found.withColumn("__e", est).withColumns({m: F.col(f"__e.{m}") for m in marks}).withColumn("d2", distance())
    return found.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).drop(
        *marks, "__e", *[f"__{x}{k}" for k in range(len(keys)) for x in "ge"])


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds the statistics, base_failed, the vector z* and the group columns."""
    made = statistics(docs, text).withColumns({"g_lang": F.col(lang).cast("string"), "g_source": F.col(source).cast("string"), "base_failed": base_failed()})
    return made.withColumns(dict(zip(Z, vector(), strict=True)))


def rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id") -> DataFrame:
    """Per row: key, the statistics, base_failed, kept, d2."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    measured = stored(measure(slim).drop("text"), "mcd-measured")
    return judge(measured, fit(measured)).select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")
