"""Name normalisation, code lookup and entity-resolution queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import backfill, value_for_year, week_index, year_index
from ledgerlens.functions.text import (AREA_SUFFIXES, STATE_CODES, int_flag, map_code,
                                       normalize_name)
from ledgerlens.operators import aggregate as agg
from ledgerlens.operators import neardup
from ledgerlens.operators import resolve as rs
from ledgerlens.operators.history import explode_slots, history
from ledgerlens.operators.nulls import drop_nulls
from ledgerlens.plans import fixtures as fx
from ledgerlens.plans.registry import register
from ledgerlens.session import cut_lineage, scratch_path
from ledgerlens.sources.tables import table

KEYS = ("buyer_state", "buyer_county", "buyer_zip")

# ------------------------------------------------------------ SQL fragments

_SUFFIX_RE = r"\s+(" + "|".join(AREA_SUFFIXES) + r")$"


def _norm_sql(expr: str) -> str:
    return (f"regexp_replace(regexp_replace(upper({expr}), '{_SUFFIX_RE}', ''), "
            r"'\W', '', 'g')")


def _fact_key_sql(expr: str) -> str:
    return rf"regexp_replace(upper({expr}), '\W', '', 'g')"


def _grams_sql(expr: str, n: int = 3) -> str:
    s = f"lower({expr})"
    return (f"list_distinct(list_transform(range(1, length({s}) - {n - 2}), "
            f"lambda i: substr({s}, i::INTEGER, {n})))")


DIMP_SQL = f"""
SELECT dim_id, dim_state, dim_name, dim_population, clean_name,
       regexp_replace(clean_name, '\\W', '', 'g') AS match_key
FROM (SELECT *, regexp_replace(upper(dim_name), '{_SUFFIX_RE}', '') AS clean_name FROM name_dim)
"""

KEYS_SQL = "SELECT DISTINCT buyer_state, buyer_county, buyer_zip FROM tx"

EXACT_SQL = f"""
SELECT k.buyer_state, k.buyer_county, k.buyer_zip, d.dim_id
FROM keys k LEFT JOIN (SELECT dim_state, match_key, min(dim_id) AS dim_id FROM dimp
                       GROUP BY 1, 2) d
  ON k.buyer_state = d.dim_state AND {_fact_key_sql('k.buyer_county')} = d.match_key
"""

FZ_IN_SQL = """
SELECT buyer_state, buyer_county, buyer_zip FROM exact
WHERE dim_id IS NULL AND coalesce(buyer_state, '') <> '' AND coalesce(buyer_county, '') <> ''
"""

BLANK_SQL = """
SELECT buyer_state, buyer_county, buyer_zip FROM exact
WHERE dim_id IS NULL AND NOT (coalesce(buyer_state, '') <> '' AND coalesce(buyer_county, '') <> '')
"""

_STRIP_COUNTY = r"regexp_replace(buyer_county, '\W', '', 'g')"

PAIRS_SQL = f"""
SELECT n.buyer_state, n.buyer_county, d.dim_id,
       1.0 - CAST(len(list_intersect(n.g, d.g)) AS DOUBLE)
           / CAST(len(n.g) + len(d.g) - len(list_intersect(n.g, d.g)) AS DOUBLE) AS dist
FROM (SELECT DISTINCT buyer_state, buyer_county,
             {_grams_sql(_STRIP_COUNTY)} AS g FROM fz_in) n
JOIN (SELECT dim_id, dim_state, {_grams_sql('match_key')} AS g FROM dimp) d
  ON n.buyer_state = d.dim_state
WHERE len(n.g) > 0 AND len(d.g) > 0
"""

BEST_SQL = """
SELECT buyer_state, buyer_county, dim_id, dist FROM (
  SELECT *, row_number() OVER (PARTITION BY buyer_state, buyer_county ORDER BY dist, dim_id) AS rn
  FROM pairs WHERE dist < 0.25) WHERE rn = 1
"""

XWD_SQL = f"""
SELECT x.zip, min(d.dim_id) AS dim_id FROM crosswalk x JOIN dimp d
  ON x.xw_state = d.dim_state AND {_norm_sql('x.xw_county')} = d.match_key
GROUP BY x.zip
"""

MAPPING_SQL = """
SELECT buyer_state, buyer_county, buyer_zip, dim_id, 'exact' AS match_stage
FROM exact WHERE dim_id IS NOT NULL
UNION ALL
SELECT f.buyer_state, f.buyer_county, f.buyer_zip, b.dim_id, 'fuzzy'
FROM fz_in f JOIN best b ON f.buyer_state = b.buyer_state AND f.buyer_county = b.buyer_county
UNION ALL
SELECT r.buyer_state, r.buyer_county, r.buyer_zip, xd.dim_id,
       CASE WHEN xd.dim_id IS NOT NULL THEN 'crosswalk' END
FROM (SELECT * FROM fz_in f WHERE NOT EXISTS (
        SELECT 1 FROM best b WHERE b.buyer_state = f.buyer_state AND b.buyer_county = f.buyer_county)
      UNION ALL SELECT * FROM blank) r
LEFT JOIN xwd xd ON r.buyer_zip = xd.zip
"""

RESOLVED_SQL = """
SELECT t.*, m.dim_id, m.match_stage, m.dim_id IS NOT NULL AS has_match
FROM tx t LEFT JOIN mapping m
  ON t.buyer_state IS NOT DISTINCT FROM m.buyer_state
 AND t.buyer_county IS NOT DISTINCT FROM m.buyer_county
 AND t.buyer_zip IS NOT DISTINCT FROM m.buyer_zip
"""


def _ctes(**extra):
    base = dict(tx=fx.TX_SQL, name_dim=fx.NAME_DIM_SQL, crosswalk=fx.CROSSWALK_SQL,
                dimp=DIMP_SQL, keys=KEYS_SQL, exact=EXACT_SQL, fz_in=FZ_IN_SQL, blank=BLANK_SQL,
                pairs=PAIRS_SQL, best=BEST_SQL, xwd=XWD_SQL, mapping=MAPPING_SQL,
                resolved=RESOLVED_SQL)
    base.update(extra)
    return base


def _sql(body: str, *needed: str) -> str:
    allc = _ctes()
    order = list(allc)
    # include every CTE up to the last needed one (they depend on each other in order)
    last = max(order.index(n) for n in needed)
    return fx.with_ctes(body, **{k: allc[k] for k in order[: last + 1]})


# ------------------------------------------------------------- Spark inputs


def _inputs(spark: SparkSession, d: str):
    t = fx.tx(spark, d)
    dim = cut_lineage(rs.prepare_dim(fx.name_dim(spark, d), "dim_id", "dim_state", "dim_name"))
    xw = fx.crosswalk(spark, d)
    return t, dim, xw


def _keys(t: DataFrame) -> DataFrame:
    """Distinct place keys of the ledger, written once to the checkpoint
    folder: every stage reads them, none should re-derive them from the fact."""
    return cut_lineage(t.select(*KEYS).distinct())


# ------------------------------------------------------------------ queries


@register("normalize_dim", sql=_sql(
    "SELECT dim_id, dim_state, clean_name, match_key FROM dimp", "dimp"))
def normalize_dim(spark: SparkSession, d: str) -> DataFrame:
    dim = rs.prepare_dim(fx.name_dim(spark, d), "dim_id", "dim_state", "dim_name")
    return dim.select("dim_id", "dim_state", "clean_name", "match_key")


@register("normalize_crosswalk", sql=fx.with_ctes(f"""
SELECT zip, xw_state, {_norm_sql('xw_county')} AS county_key,
       coalesce(decommissioned = 1, FALSE) AS decommissioned
FROM crosswalk
""", crosswalk=fx.CROSSWALK_SQL))
def normalize_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """P6 + F1-F3 on the crosswalk: 0/1 flag to boolean, county name to key."""
    x = fx.crosswalk(spark, d)
    return x.select("zip", "xw_state", normalize_name("xw_county").alias("county_key"),
                    int_flag("decommissioned").alias("decommissioned"))


_CODES_VALUES = ", ".join(f"('{n}', '{c}')" for n, c in STATE_CODES)
_CODES_IDX_VALUES = ", ".join(f"({i}, '{n}', '{c}')" for i, (n, c) in enumerate(STATE_CODES))
_STATE_IN_SQL = f"""
SELECT c_custkey, CASE c_custkey % 4
    WHEN 0 THEN lower(s.name) WHEN 1 THEN s.code WHEN 2 THEN 'ATLANTIS' ELSE NULL END AS state_in
FROM customer JOIN (VALUES {_CODES_IDX_VALUES}) s(i, name, code)
  ON c_custkey % {len(STATE_CODES)} = s.i
"""


@register("code_lookup", sql=f"""
WITH codes AS (SELECT * FROM (VALUES {_CODES_VALUES}) v(name, code)),
lk AS (SELECT upper(name) AS k, code FROM codes UNION SELECT code AS k, code FROM codes),
si AS ({_STATE_IN_SQL})
SELECT CAST(si.c_custkey AS BIGINT) AS c_custkey, si.state_in, lk.code AS state_code
FROM si LEFT JOIN lk ON upper(si.state_in) = lk.k
""")
def code_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Each customer carries a state written one of four ways (full name in
    lower case, code, unknown name, null); map it to a code (F4, T8)."""
    c = table(spark, d, "customer")
    codes = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate(STATE_CODES)],
                                  "i long, name string, code string")
    # the code list has a fixed bound (57 rows): explicit broadcast
    j = c.join(F.broadcast(codes), (c.c_custkey % len(STATE_CODES)) == codes.i)
    m = c.c_custkey % 4
    state_in = (F.when(m == 0, F.lower("name")).when(m == 1, F.col("code"))
                 .when(m == 2, F.lit("ATLANTIS")).otherwise(F.lit(None).cast("string")))
    si = j.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), state_in.alias("state_in"))
    return map_code(si, "state_in", out="state_code")


@register("resolve_exact", sql=_sql("""
SELECT t.buyer_state, t.buyer_county, e.dim_id, count(*) AS n_rows, sum(t.quantity) AS sum_qty
FROM tx t JOIN exact e ON t.buyer_state = e.buyer_state AND t.buyer_county = e.buyer_county
 AND t.buyer_zip = e.buyer_zip
GROUP BY 1, 2, 3
""", "exact"))
def resolve_exact(spark: SparkSession, d: str) -> DataFrame:
    t, dim, _ = _inputs(spark, d)
    m = rs.resolve_exact(_keys(t), dim, "buyer_state", "buyer_county")
    j = t.join(m, list(KEYS))
    return j.groupBy("buyer_state", "buyer_county", "dim_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("sum_qty"))


@register("resolve_fuzzy", sql=_sql(
    "SELECT buyer_state, buyer_county, dim_id, round(dist, 6) AS dist FROM best", "best"))
def resolve_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Best trigram match per dirty name left over by the exact stage."""
    t, dim, _ = _inputs(spark, d)
    ex = rs.resolve_exact(_keys(t), dim, "buyer_state", "buyer_county")
    rest = ex.where(F.col("dim_id").isNull()).drop("dim_id").where(
        (F.coalesce("buyer_state", F.lit("")) != "") & (F.coalesce("buyer_county", F.lit("")) != ""))
    best = rs.best_match(rs.fuzzy_candidates(rest, dim, "buyer_state", "buyer_county"),
                         ["buyer_state", "buyer_county"])
    return best.withColumn("dist", F.round("dist", 6))


@register("fuzzy_pairs", sql=_sql(
    "SELECT buyer_state, buyer_county, dim_id, round(dist, 6) AS dist FROM pairs WHERE dist < 0.25",
    "pairs"))
def fuzzy_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every qualifying (dirty name, dimension row) pair (J4x before W1)."""
    t, dim, _ = _inputs(spark, d)
    ex = rs.resolve_exact(_keys(t), dim, "buyer_state", "buyer_county")
    rest = ex.where(F.col("dim_id").isNull()).drop("dim_id").where(
        (F.coalesce("buyer_state", F.lit("")) != "") & (F.coalesce("buyer_county", F.lit("")) != ""))
    p = rs.fuzzy_candidates(rest, dim, "buyer_state", "buyer_county")
    return p.withColumn("dist", F.round("dist", 6))


@register("resolve_crosswalk", sql=_sql("""
SELECT k.buyer_state, k.buyer_county, k.buyer_zip, xd.dim_id
FROM keys k LEFT JOIN xwd xd ON k.buyer_zip = xd.zip
""", "xwd"))
def resolve_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    t, dim, xw = _inputs(spark, d)
    return rs.resolve_crosswalk(_keys(t), xw, dim, "buyer_zip")


@register("anti_remainder", sql=_sql("""
SELECT f.buyer_state, f.buyer_county, f.buyer_zip, b.dim_id, TRUE AS has_match
FROM fz_in f JOIN best b ON f.buyer_state = b.buyer_state AND f.buyer_county = b.buyer_county
UNION ALL
SELECT f.buyer_state, f.buyer_county, f.buyer_zip, NULL, FALSE FROM fz_in f
WHERE NOT EXISTS (SELECT 1 FROM best b
                  WHERE b.buyer_state = f.buyer_state AND b.buyer_county = f.buyer_county)
""", "best"))
def anti_remainder(spark: SparkSession, d: str) -> DataFrame:
    """Stage-2 output: fuzzy matches plus the rows with no match (NOT EXISTS),
    combined without a distinct because the branches are disjoint (J5, O3)."""
    t, dim, _ = _inputs(spark, d)
    ex = rs.resolve_exact(_keys(t), dim, "buyer_state", "buyer_county")
    fz_in = ex.where(F.col("dim_id").isNull()).drop("dim_id").where(
        (F.coalesce("buyer_state", F.lit("")) != "") & (F.coalesce("buyer_county", F.lit("")) != ""))
    fz_in = cut_lineage(fz_in, "fuzzy-input")
    # read by the match and by the anti-join: computed once
    best = cut_lineage(rs.best_match(rs.fuzzy_candidates(fz_in, dim, "buyer_state", "buyer_county"),
                                     ["buyer_state", "buyer_county"]), "fuzzy-best")
    matched = fz_in.join(best, ["buyer_state", "buyer_county"]).select(
        *KEYS, "dim_id", F.lit(True).alias("has_match"))
    rest = rs.remainder(fz_in, best, ["buyer_state", "buyer_county"]).select(
        *KEYS, F.lit(None).cast("bigint").alias("dim_id"), F.lit(False).alias("has_match"))
    return matched.unionByName(rest)


def resolved(spark: SparkSession, d: str, carry_blank_keys: bool = True) -> DataFrame:
    return rs.resolve_cascade(fx.tx(spark, d), fx.name_dim(spark, d), fx.crosswalk(spark, d), "buyer_state",
                              "buyer_county", "buyer_zip", carry_blank_keys=carry_blank_keys)


@register("resolve_cascade", sql=_sql("""
SELECT match_stage, has_match, count(*) AS n_rows,
       count(DISTINCT buyer_zip) AS n_keys, sum(quantity) AS sum_qty
FROM resolved GROUP BY 1, 2
""", "resolved"))
def resolve_cascade(spark: SparkSession, d: str) -> DataFrame:
    r = resolved(spark, d)
    return r.groupBy("match_stage", "has_match").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("buyer_zip").alias("n_keys"),
        F.sum("quantity").alias("sum_qty"))


@register("resolve_cascade_rows", sql=_sql("""
SELECT order_key, line_no, part_key, tx_date, quantity, buyer_state, buyer_county, buyer_zip,
       dim_id, match_stage, has_match FROM resolved
""", "resolved"))
def resolve_cascade_rows(spark: SparkSession, d: str) -> DataFrame:
    """The cascade's row-level output (all fact rows, resolved or not)."""
    r = resolved(spark, d)
    return r.select("order_key", "line_no", "part_key", "tx_date", "quantity", *KEYS,
                    "dim_id", "match_stage", "has_match")


@register("reconcile_counts", sql=_sql("""
SELECT 'fact' AS "table", count(*) AS n_rows FROM tx
UNION ALL SELECT 'exact', count(*) FROM resolved WHERE match_stage = 'exact'
UNION ALL SELECT 'fuzzy', count(*) FROM resolved WHERE match_stage = 'fuzzy'
UNION ALL SELECT 'crosswalk', count(*) FROM resolved WHERE match_stage = 'crosswalk'
UNION ALL SELECT 'unmatched', count(*) FROM resolved WHERE match_stage IS NULL
""", "resolved"))
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    """Fact vs stage row counts (A22); the cascade conserves rows."""
    t = fx.tx(spark, d)
    r = resolved(spark, d)
    # one pass over the resolved table for all stage counts, one over the fact
    by_stage = r.groupBy(F.coalesce("match_stage", F.lit("unmatched")).alias("table")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return agg.reconcile_counts({"fact": t}).unionByName(by_stage)


@register("split_counts", sql=_sql("""
SELECT has_match, count(*) AS n_rows, sum(quantity) AS sum_qty FROM resolved GROUP BY 1
""", "resolved"))
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    """K1 + P2 + A19: one write of the resolved table partitioned by the flag
    (one computation, no cache), then count and sum per flag from the files."""
    from ledgerlens.sources.sinks import read_split, write_split
    path = scratch_path(spark, "split")
    write_split(resolved(spark, d), "has_match", path)
    back = read_split(spark, path, "has_match")
    return agg.split_counts(back, "has_match", "quantity")


@register("split_matched_only", sql=_sql("""
SELECT match_stage, count(*) AS n_rows, sum(quantity) AS sum_qty FROM resolved
WHERE has_match GROUP BY 1
""", "resolved"))
def split_matched_only(spark: SparkSession, d: str) -> DataFrame:
    """P2 over the K1 split: reading only ``has_match=true`` prunes the other
    directory entirely (partition filter, no data read)."""
    from ledgerlens.sources.sinks import read_split, write_split
    path = scratch_path(spark, "split")
    write_split(resolved(spark, d), "has_match", path)
    back = read_split(spark, path, "has_match").where(F.col("has_match"))
    return back.groupBy("match_stage").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum("quantity").alias("sum_qty"))


@register("disjunctive_join", sql=_sql(f"""
SELECT k.buyer_state, k.buyer_county, k.buyer_zip, min(d.dim_id) AS dim_id
FROM keys k
LEFT JOIN crosswalk x ON k.buyer_zip = x.zip
LEFT JOIN dimp d ON k.buyer_state = d.dim_state
  AND ({_fact_key_sql('k.buyer_county')} = d.match_key OR {_norm_sql('x.xw_county')} = d.match_key)
GROUP BY 1, 2, 3
""", "keys"))
def disjunctive_join(spark: SparkSession, d: str) -> DataFrame:
    t, dim, xw = _inputs(spark, d)
    return rs.disjunctive_match(_keys(t), xw, dim, "buyer_state", "buyer_county", "buyer_zip")


@register("resolve_fuzzy_lsh")
def resolve_fuzzy_lsh(spark: SparkSession, d: str) -> DataFrame:
    """MinHash LSH route of the fuzzy stage (approximate; checked as a subset
    of ``resolve_fuzzy`` with a recall bound in the tests)."""
    t, dim, _ = _inputs(spark, d)
    ex = rs.resolve_exact(_keys(t), dim, "buyer_state", "buyer_county")
    rest = ex.where(F.col("dim_id").isNull()).drop("dim_id").where(
        (F.coalesce("buyer_state", F.lit("")) != "") & (F.coalesce("buyer_county", F.lit("")) != ""))
    names = rest.select("buyer_state", "buyer_county").distinct()
    return rs.resolve_fuzzy_lsh(names, dim, "buyer_state", "buyer_county").withColumn(
        "dist", F.round("dist", 6))


@register("fuzzy_lsh_check", sql=_sql("""
SELECT CAST(count(*) AS BIGINT) AS n_exact, TRUE AS no_false_match, TRUE AS recall_reached FROM best
""", "best"))
def fuzzy_lsh_check(spark: SparkSession, d: str) -> DataFrame:
    """J4 against J4x over all names: every match of the MinHash route is a
    qualifying pair with its exact distance, and at least nine tenths of the
    names that have a match find one."""
    lsh, exact = cut_lineage(resolve_fuzzy_lsh(spark, d), "lsh"), cut_lineage(fuzzy_pairs(spark, d), "fuzzy-pairs")
    keys = ["buyer_state", "buyer_county"]
    false = lsh.join(exact, [*keys, "dim_id", "dist"], "left_anti").agg(F.count(F.lit(1))).scalar()
    found = lsh.agg(F.count(F.lit(1))).scalar()
    best = exact.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_exact"))
    return best.select("n_exact", (false == 0).alias("no_false_match"), (10 * found >= 9 * F.col("n_exact")).alias("recall_reached"))


@register("doc_near_dup")
def doc_near_dup(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate documents by banded MinHash over word 5-shingles of the
    whole texts: per document its class, named by the smallest id, and their
    distance (approximate: ``doc_near_dup_check`` holds it against the exact
    groups)."""
    docs = table(spark, d, "documents")
    near = neardup.near_duplicates(docs, "doc_id", "text").withColumnRenamed("doc", "doc_id").dropDuplicates(["doc_id", "representative"])
    return docs.select("doc_id").join(near, "doc_id", "left").select(
        "doc_id", F.coalesce("representative", "doc_id").alias("representative"), F.round(F.coalesce("dist", F.lit(0.0)), 6).alias("dist"))


_NEAR_SQL = """
sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) END AS sh
       FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: length(x) > 0) AS w
             FROM documents)),
member AS (SELECT doc_id, sh, min(doc_id) OVER (PARTITION BY list_sort(sh)) AS rep FROM sh WHERE len(sh) > 0),
tok AS (SELECT doc_id, len(sh) AS s, unnest(sh) AS t FROM member WHERE doc_id = rep),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tok a JOIN tok b ON a.t = b.t AND a.doc_id <> b.doc_id
          GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(a.s) + any_value(b.s) - count(*))),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
grp AS (SELECT m.doc_id, m.sh, least(m.rep, coalesce(min(r.b), m.rep)) AS representative
        FROM member m LEFT JOIN reach r ON r.a = m.rep GROUP BY m.doc_id, m.sh, m.rep),
near AS (SELECT g.doc_id, g.representative, len(list_intersect(g.sh, m.sh)) AS common, len(g.sh) + len(m.sh) AS total
         FROM grp g JOIN member m ON m.doc_id = g.representative WHERE g.doc_id <> g.representative)
"""


@register("doc_near_dup_exact", sql="""
WITH RECURSIVE sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh
       FROM (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: length(x) > 0) AS w
             FROM documents)),
member AS (SELECT doc_id, sh, CASE WHEN len(sh) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(sh)) END AS rep FROM sh),
class AS (SELECT rep, count(*) AS size FROM member GROUP BY 1),
tok AS (SELECT doc_id, len(sh) AS s, unnest(sh) AS t FROM member WHERE doc_id = rep),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tok a JOIN tok b ON a.t = b.t AND a.doc_id <> b.doc_id
          GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(a.s) + any_value(b.s) - count(*))),
others AS (SELECT p.a AS rep, sum(c.size) AS n FROM pairs p JOIN class c ON c.rep = p.b GROUP BY 1),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least_of AS (SELECT a AS rep, min(b) AS b FROM reach GROUP BY 1),
grp AS (SELECT m.doc_id, m.sh, least(m.rep, coalesce(l.b, m.rep)) AS representative, c.size - 1 + coalesce(o.n, 0) AS n_links
        FROM member m JOIN class c USING (rep) LEFT JOIN others o USING (rep) LEFT JOIN least_of l USING (rep))
SELECT CAST(g.doc_id AS BIGINT) AS doc_id, CAST(g.representative AS BIGINT) AS representative,
       CASE WHEN len(g.sh) = 0 THEN 0.0 ELSE round(1.0 - CAST(len(list_intersect(g.sh, m.sh)) AS DOUBLE)
            / CAST(len(g.sh) + len(m.sh) - len(list_intersect(g.sh, m.sh)) AS DOUBLE), 6) END AS dist,
       CAST(g.n_links AS BIGINT) AS n_links
FROM grp g JOIN member m ON m.doc_id = g.representative
""")
def doc_near_dup_exact(spark: SparkSession, d: str) -> DataFrame:
    """Every link between documents by word 3-shingle similarity of 0.75 or more,
    by the prefix-filtered set-similarity join: per document its class (the
    smallest id that links reach), their distance, and its number of links."""
    docs = table(spark, d, "documents")
    return neardup.exact_links(docs, "doc_id", "text", shingle=3).select(F.col("doc").alias("doc_id"), "representative", F.round("dist", 6).alias("dist"), "n_links")


@register("doc_near_dup_check", sql=f"""
WITH RECURSIVE {_NEAR_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_exact, TRUE AS no_false_group, TRUE AS recall_reached FROM near
""")
def doc_near_dup_check(spark: SparkSession, d: str) -> DataFrame:
    """Banded MinHash against the exact groups over all documents: no group
    joins documents that the exact ones keep apart, and at least nine tenths of
    the documents with a representative have one."""
    docs = table(spark, d, "documents")
    whole = neardup.exact_near_duplicates(docs, "doc_id", "text").select(F.col("doc").alias("doc_id"), "representative")
    lsh, exact = cut_lineage(doc_near_dup(spark, d).where("doc_id <> representative"), "lsh-groups"), cut_lineage(whole, "exact-groups")
    group = exact.select("doc_id", F.col("representative").alias("g"))
    both = (lsh.join(group, "doc_id", "left").withColumn("g", F.coalesce("g", "doc_id"))
               .join(group.select(F.col("doc_id").alias("representative"), F.col("g").alias("h")), "representative", "left")
               .withColumn("h", F.coalesce("h", "representative")))
    false, found = both.where("g <> h").agg(F.count(F.lit(1))).scalar(), lsh.agg(F.count(F.lit(1))).scalar()
    return exact.agg(F.count(F.lit(1)).alias("n_exact")).select("n_exact", (false == 0).alias("no_false_group"),
                                                                (10 * found >= 9 * F.col("n_exact")).alias("recall_reached"))


# ------------------------------------------------------- resolved chain

RESOLVED_HISTORY_SQL = _sql(f"""
SELECT dim_id, category, week_index, year_index, strength, round(rate, 9) AS rate,
       {', '.join(f"coalesce(h[{i + 1}], 0.0) AS h{i + 1}" for i in range(13))}
FROM (SELECT *, list_transform(coalesce(hl, []), lambda x: round(x, 9)) AS h FROM (
  SELECT *, list(rate) OVER (PARTITION BY dim_id, category ORDER BY week_index, year_index, strength
                             ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING) AS hl
  FROM (SELECT *, pill_count / population AS rate FROM (
    SELECT m.dim_id, t.category, CAST(date_diff('day', DATE '{fx.TX_EPOCH}', t.tx_date) // 7 AS BIGINT) AS week_index,
           CAST(year(t.tx_date) - year(DATE '{fx.TX_EPOCH}') AS BIGINT) AS year_index,
           CASE WHEN year(t.tx_date) - year(DATE '{fx.TX_EPOCH}') BETWEEN 0 AND 6
                THEN d.dim_population + greatest(4, year(t.tx_date) - year(DATE '{fx.TX_EPOCH}')) END AS population,
           t.strength, sum(t.quantity) AS pill_count
    FROM tx t JOIN mapping m ON t.buyer_state IS NOT DISTINCT FROM m.buyer_state
      AND t.buyer_county IS NOT DISTINCT FROM m.buyer_county AND t.buyer_zip IS NOT DISTINCT FROM m.buyer_zip
    JOIN dimp d ON d.dim_id = m.dim_id
    GROUP BY ALL))
  WHERE strength IS NOT NULL AND population IS NOT NULL AND rate IS NOT NULL AND week_index IS NOT NULL))
""", "mapping")


def place_dim(spark: SparkSession, d: str) -> DataFrame:
    """The place dimension with a population per year, the first four years
    copied from the fifth (P8)."""
    years = fx.name_dim(spark, d).withColumns({c: F.col("dim_population") + i for i, c in enumerate(fx.POP_COLS)})
    return backfill(years, fx.POP_COLS[:4], fx.POP_COLS[4])


def resolved_weekly(spark: SparkSession, d: str) -> DataFrame:
    """J9 -> A1: the ledger by week, item, strength and *matched place*, with
    the rate per head of that place's population in the row's year.

    The ledger is summed by raw key first; only those sums meet the cascade's
    key-level mapping, which carries the place's populations, and are summed
    again by place.  No fact row is joined."""
    t = fx.tx(spark, d)
    places = rs.place_mapping(t, place_dim(spark, d), fx.crosswalk(spark, d), *KEYS, dim_cols=("dim_state", "clean_name", *fx.POP_COLS))
    places = cut_lineage(places.where(F.col("dim_id").isNotNull()), "places")
    keys = {**{k: k for k in KEYS}, "category": "category", "week_index": week_index("tx_date", fx.TX_EPOCH),
            "year_index": year_index("tx_date", fx.TX_EPOCH), "strength": "strength"}
    sums = rs.join_mapping(agg.period_agg(t, keys, qty="quantity", weight="strength"), places, KEYS, "inner")
    sums = sums.withColumn("population", value_for_year("year_index", fx.POP_COLS))
    by = ["dim_id", "dim_state", "clean_name", "category", "week_index", "year_index", "population", "strength"]
    weekly = sums.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("order_count", "pill_count", "normalized_pill_count")))
    return weekly.withColumn("rate", agg.rate("pill_count", "population"))


@register("resolved_weekly_history", sql=RESOLVED_HISTORY_SQL)
def resolved_weekly_history(spark: SparkSession, d: str) -> DataFrame:
    """J9 -> A1 -> A2 -> W2 in one chain: messy names resolved, rates by
    matched place and week, each with its 13 previous ones."""
    h = history(drop_nulls(resolved_weekly(spark, d)), ["dim_id", "category"], "week_index", "rate", n=13,
                tie_break=("year_index", "strength"), out="history")
    h = h.select("dim_id", "category", "week_index", "year_index", "strength", F.round("rate", 9).alias("rate"),
                 F.transform("history", lambda x: F.round(x, 9)).alias("history"))
    return explode_slots(h, "history", 13)


@register("calendar_lags", sql=_sql(f"""
SELECT w.dim_id, w.week_index, round(w.q, 6) AS quantity, {', '.join(f"round(coalesce(l{i}.q, 0.0), 6) AS h{14 - i}" for i in range(1, 14))}
FROM byweek w {' '.join(f"LEFT JOIN byweek l{i} ON l{i}.dim_id = w.dim_id AND l{i}.week_index = w.week_index - {i}" for i in range(1, 14))}
""", "mapping").replace("\nSELECT w.dim_id", f""", byweek AS (
  SELECT m.dim_id, CAST(date_diff('day', DATE '{fx.TX_EPOCH}', t.tx_date) // 7 AS BIGINT) AS week_index, sum(t.quantity) AS q
  FROM tx t JOIN mapping m ON t.buyer_state IS NOT DISTINCT FROM m.buyer_state
   AND t.buyer_county IS NOT DISTINCT FROM m.buyer_county AND t.buyer_zip IS NOT DISTINCT FROM m.buyer_zip
  WHERE m.dim_id IS NOT NULL GROUP BY 1, 2)
SELECT w.dim_id""", 1))
def calendar_lags(spark: SparkSession, d: str) -> DataFrame:
    """W2 with true calendar lags (T4): weekly quantity per matched place and
    the quantities exactly 13 .. 1 weeks before, 0 where there was none."""
    weeks = resolved_weekly(spark, d).groupBy("dim_id", "week_index").agg(F.sum("pill_count").alias("quantity"))
    h = history(cut_lineage(weeks, "place-weeks"), ["dim_id"], "week_index", "quantity", n=13, frame="range", out="history")
    h = h.select("dim_id", "week_index", F.round("quantity", 6).alias("quantity"), F.transform("history", lambda x: F.round(x, 6)).alias("history"))
    return explode_slots(h, "history", 13)
