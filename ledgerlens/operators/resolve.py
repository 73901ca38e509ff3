"""Entity resolution: exact, fuzzy (trigram Jaccard) and crosswalk matching of
dirty place names against a reference dimension, and the three-stage cascade
(J1, J2, J4, J4x, J5-J7, J9, W1, M1-M4, O3, P3, P5).

Scale design
------------
A ledger has billions of rows but only as many distinct (state, county, zip)
keys as there are places.  Every stage therefore resolves the *distinct keys*
(``select(keys).distinct()``: partial aggregation, so a key that holds a
third of all rows costs one row per map task) and the resulting key -> match
mapping is joined back to the fact once.  That final join is an equi-join on
the keys; AQE measures the mapping at run time and broadcasts it when small,
and splits skewed fact partitions (skew join) otherwise.

The fuzzy stage is an exact set-similarity join: candidates come from an
equi-join on (block, token) restricted to each set's *prefix* under a global
rare-first token order.  Two sets with Jaccard similarity >= t must share a
token among their first ``|A| - ceil(t |A|) + 1`` tokens, so no pair is lost,
and no block is ever expanded into all of its pairs.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.keys import row_text
from ledgerlens.functions.text import (AREA_SUFFIXES, char_ngrams, normalize_name,
                                       strip_non_word, strip_suffix)
from ledgerlens.session import cut_lineage


def prepare_dim(dim: DataFrame, dim_id: str, dim_block: str, dim_name: str,
                suffixes=AREA_SUFFIXES) -> DataFrame:
    """Dimension with its clean display name and match key."""
    return dim.withColumn("clean_name", strip_suffix(dim_name, suffixes)) \
              .withColumn("match_key", strip_non_word("clean_name"))


def fact_key(name_col: str):
    """Match key of a fact-side name: upper-cased, non-word characters removed."""
    return normalize_name(name_col, suffixes=())


# --------------------------------------------------------------------- exact


def resolve_exact(keys: DataFrame, dim: DataFrame, block: str, name: str,
                  dim_id: str = "dim_id", dim_block: str = "dim_state") -> DataFrame:
    """Left join of distinct keys to the prepared dimension on block and
    normalised name (J1, P5).  Returns ``keys`` + ``dim_id`` (null = no match).
    Dimension rows whose names normalise to the same key are reduced to the
    smallest id first, so a key never fans out into several rows."""
    d = dim.groupBy(F.col(dim_block).alias("__dblock"), F.col("match_key").alias("__dkey")) \
           .agg(F.min(dim_id).alias("__dim_id"))
    k = keys.withColumn("__fkey", fact_key(name))
    j = k.join(d, (k[block] == d["__dblock"]) & (k["__fkey"] == d["__dkey"]), "left")
    return j.select(*keys.columns, F.col("__dim_id").alias(dim_id))


# --------------------------------------------------------------------- fuzzy


def _prefix_len(size_col, t: float):
    return size_col - F.ceil(F.lit(t) * size_col).cast("int") + 1


def jaccard_join(left: DataFrame, right: DataFrame | None, block: str, left_id: str,
                 right_id: str, grams: str, max_dist: float,
                 materialize: bool = True) -> DataFrame:
    """All (left_id, right_id, dist) in the same block with Jaccard distance
    strictly below ``max_dist``.  ``left``/``right``: (id, block, grams array);
    ``right=None`` is a self join returning each pair once (left_id < right_id).

    Exact: prefix filtering never drops a qualifying pair.  The set tables
    are read three times (token frequencies, prefixes, verification), so they
    are first written to the shared checkpoint folder (``materialize``)."""
    t = 1.0 - max_dist  # similarity must exceed t
    lt = left.select(F.col(left_id).alias("__lid"), F.col(block).alias("__b"),
                     F.col(grams).alias("__lg"))
    if materialize:
        lt = cut_lineage(lt)
    if right is None:
        rt = lt.select(F.col("__lid").alias("__rid"), "__b", F.col("__lg").alias("__rg"))
    else:
        rt = right.select(F.col(right_id).alias("__rid"), F.col(block).alias("__b"),
                          F.col(grams).alias("__rg"))
        if materialize:
            rt = cut_lineage(rt)
    # global token frequency (bounded by the distinct-token domain)
    ltok = lt.select(F.explode("__lg").alias("__tok"))
    alltok = ltok if right is None else ltok.unionByName(rt.select(F.explode("__rg").alias("__tok")))
    toks = alltok.groupBy("__tok").agg(F.count(F.lit(1)).alias("__f"))

    # tokens seen once overall sort first and can never be shared: they only
    # use up prefix slots.  Only shared tokens are joined back (an inner join
    # drops the unique ones), and a set's unique count is its size minus the
    # shared tokens it kept.
    shared_f = toks.where(F.col("__f") > 1)

    def prefix(df, idc, gc):
        ex = df.select(idc, "__b", F.size(gc).alias("__s"), F.explode(gc).alias("__tok"))
        shared = ex.join(shared_f, "__tok")
        shared = shared.withColumn(
            "__u", F.col("__s") - F.count(F.lit(1)).over(Window.partitionBy(idc)))
        w = Window.partitionBy(idc).orderBy("__f", "__tok")
        shared = shared.withColumn("__pos", F.row_number().over(w))
        slots = _prefix_len(F.col("__s"), t) - F.col("__u")
        return shared.where(F.col("__pos") <= slots).select(idc, "__b", "__tok")

    lp = prefix(lt, "__lid", "__lg")
    if right is None:
        rp = lp.select(F.col("__lid").alias("__rid"), "__b", "__tok")
        cand = lp.join(rp, ["__b", "__tok"]).where(F.col("__lid") < F.col("__rid"))
    else:
        cand = lp.join(prefix(rt, "__rid", "__rg"), ["__b", "__tok"])
    cand = cand.select("__lid", "__rid").distinct()
    v = cand.join(lt.drop("__b"), "__lid").join(rt.drop("__b"), "__rid")
    inter = F.size(F.array_intersect("__lg", "__rg"))
    union = F.size("__lg") + F.size("__rg") - inter
    # length filter first: |B| >= t|A| and |A| >= t|B| are necessary
    sa, sb = F.size("__lg"), F.size("__rg")
    v = v.where((sb >= F.lit(t) * sa) & (sa >= F.lit(t) * sb))
    v = v.withColumn("dist", F.lit(1.0) - inter.cast("double") / union.cast("double"))
    return v.where(F.col("dist") < F.lit(max_dist)).select(
        F.col("__lid").alias(left_id), F.col("__rid").alias(right_id), "dist")


def fuzzy_candidates(keys: DataFrame, dim: DataFrame, block: str, name: str,
                     dim_id: str = "dim_id", dim_block: str = "dim_state",
                     n: int = 3, max_dist: float = 0.25) -> DataFrame:
    """Every (block, name, dimension row) in the same block with trigram
    Jaccard distance < ``max_dist`` (J4x), computed once per distinct
    (block, name).  Names shorter than ``n`` have no grams and are never
    matched (T6)."""
    names = keys.select(block, name).distinct()
    # the stripped, lower-cased name is its own column so the n-gram lambda
    # reads it instead of re-running the regex for every gram
    k = (names.withColumn("__kid", F.concat_ws("\u0001", block, name))
              .withColumn("__v", F.lower(strip_non_word(name)))
              .withColumn("__g", char_ngrams(F.col("__v"), n)).drop("__v"))
    d = dim.select(F.col(dim_id).alias("__did"), F.col(dim_block).alias(block),
                   char_ngrams(F.col("match_key"), n).alias("__g"))
    pairs = jaccard_join(k.where(F.size("__g") > 0), d.where(F.size("__g") > 0),
                         block, "__kid", "__did", "__g", max_dist)
    return k.select("__kid", block, name).join(pairs, "__kid").select(
        block, name, F.col("__did").alias(dim_id), "dist")


def best_match(pairs: DataFrame, key_cols, dim_id: str = "dim_id", dist: str = "dist",
               method: str = "aggregate") -> DataFrame:
    """One match per key: smallest distance, ties to the smaller dimension id
    (J7, W1).  ``aggregate`` (default) is a ``min(struct)`` aggregate, so
    map-side partial aggregation keeps a hot key cheap and there is no
    per-key sort; ``window`` is the reference's form, ``row_number`` over
    (key) ordered by (distance, id), keeping 1.  Both give the same rows."""
    if method == "window":
        w = Window.partitionBy(*key_cols).orderBy(F.col(dist).asc(), F.col(dim_id).asc())
        return (pairs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
                     .select(*key_cols, dim_id, dist))
    m = pairs.groupBy(*key_cols).agg(F.min(F.struct(F.col(dist), F.col(dim_id))).alias("__m"))
    return m.select(*key_cols, F.col("__m." + dim_id).alias(dim_id), F.col("__m." + dist).alias(dist))


def resolve_fuzzy(keys: DataFrame, dim: DataFrame, block: str, name: str,
                  dim_id: str = "dim_id", dim_block: str = "dim_state",
                  n: int = 3, max_dist: float = 0.25) -> DataFrame:
    """Best fuzzy match per key (null when none): keys + dim_id + dist."""
    best = best_match(fuzzy_candidates(keys, dim, block, name, dim_id, dim_block, n, max_dist),
                      [block, name], dim_id)
    return _left_on_keys(keys, best, [block, name])


def _left_on_keys(keys: DataFrame, mapping: DataFrame, cols) -> DataFrame:
    """Left join on key columns (null-safe); the mapping may derive from
    ``keys`` itself, so its key columns are renamed first."""
    m = mapping.select(*[F.col(c).alias(f"__m_{c}") for c in cols],
                       *[c for c in mapping.columns if c not in cols])
    cond = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in cols]
    return keys.join(m, cond, "left").drop(*[f"__m_{c}" for c in cols])


# ----------------------------------------------------------------- crosswalk


def resolve_crosswalk(keys: DataFrame, xwalk: DataFrame, dim: DataFrame, zip_col: str,
                      xw_key: str = "zip", xw_block: str = "xw_state", xw_name: str = "xw_county",
                      dim_id: str = "dim_id", dim_block: str = "dim_state",
                      suffixes=AREA_SUFFIXES) -> DataFrame:
    """Two-hop left join: key's zip -> crosswalk (state, county) -> dimension
    (J2).  Its county name gets the same normalisation as the dimension;
    at most one dimension row is attached per zip."""
    x = xwalk.select(F.col(xw_key).alias("__xk"), F.col(xw_block).alias("__xb"),
                     normalize_name(xw_name, suffixes).alias("__xkey"))
    d = dim.select(F.col(dim_id).alias("__did"), F.col(dim_block).alias("__db"),
                   F.col("match_key").alias("__dkey"))
    xd = x.join(d, (x["__xb"] == d["__db"]) & (x["__xkey"] == d["__dkey"]))
    # one dimension row per zip (smallest id): no fan-out of the keys
    xd = xd.groupBy("__xk").agg(F.min("__did").alias("__did"))
    j = keys.join(xd, keys[zip_col] == xd["__xk"], "left")
    return j.select(*keys.columns, F.col("__did").alias(dim_id))


# ------------------------------------------------------------------- cascade


def remainder(rows: DataFrame, matched: DataFrame, key_cols) -> DataFrame:
    """Rows of ``rows`` with no row in ``matched`` on ``key_cols`` (J5):
    a left anti join (NOT EXISTS)."""
    m = matched.select(*[F.col(c).alias(f"__m_{c}") for c in key_cols])
    cond = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in key_cols]
    return rows.join(m, cond, "left_anti")


def cascade_mapping(keys: DataFrame, dim: DataFrame, xwalk: DataFrame, block: str, name: str,
                    zip_col: str, dim_id: str = "dim_id", dim_block: str = "dim_state",
                    n: int = 3, max_dist: float = 0.25, carry_blank_keys: bool = True,
                    xw_key: str = "zip", xw_block: str = "xw_state", xw_name: str = "xw_county",
                    suffixes=AREA_SUFFIXES, fuzzy: str = "exact") -> DataFrame:
    """Distinct keys -> (dim_id, match_stage): exact, then fuzzy on what is
    left, then crosswalk on what is still left (J9).  Stages are disjoint by
    construction, so they are combined with ``unionByName`` (no distinct).
    ``carry_blank_keys=False`` drops blank-key rows after the exact stage as
    the reference does (T2); they then appear in no stage at all.
    ``fuzzy="lsh"`` runs the fuzzy stage by MinHash LSH (the reference's
    approximate route) instead of the exact trigram join."""
    cols = keys.columns
    ex = resolve_exact(keys, dim, block, name, dim_id, dim_block)
    s1 = ex.where(F.col(dim_id).isNotNull()).withColumn("match_stage", F.lit("exact"))
    rest1 = ex.where(F.col(dim_id).isNull()).select(*cols)
    nonblank = (F.coalesce(F.col(block), F.lit("")) != "") & (F.coalesce(F.col(name), F.lit("")) != "")
    fz_in = rest1.where(nonblank)
    blank = rest1.where(~nonblank)
    # one row per fuzzy-matched name, read twice below: materialise it once
    if fuzzy == "lsh":
        names = fz_in.select(block, name).distinct()
        best = cut_lineage(resolve_fuzzy_lsh(names, dim, block, name, dim_id, dim_block, n,
                                             max_dist))
    else:
        best = cut_lineage(best_match(
            fuzzy_candidates(fz_in, dim, block, name, dim_id, dim_block, n, max_dist),
            [block, name], dim_id))
    fz = fz_in.join(best, [block, name])
    s2 = fz.select(*cols, dim_id).withColumn("match_stage", F.lit("fuzzy"))
    rest2 = remainder(fz_in, best, [block, name])
    if carry_blank_keys:
        rest2 = rest2.unionByName(blank)
    xw = resolve_crosswalk(rest2, xwalk, dim, zip_col, xw_key, xw_block, xw_name,
                           dim_id, dim_block, suffixes)
    s3 = xw.withColumn("match_stage", F.when(F.col(dim_id).isNotNull(), F.lit("crosswalk")))
    return s1.unionByName(s2).unionByName(s3)


def place_mapping(fact: DataFrame, dim: DataFrame, xwalk: DataFrame, block: str, name: str, zip_col: str, dim_cols=(), dim_id: str = "dim_id",
                  dim_block: str = "dim_state", dim_name: str = "dim_name", carry_blank_keys: bool = True, materialize: bool = True, **kw) -> DataFrame:
    """The cascade's result at key level: one row per distinct key of the fact,
    with the matched place's id, its ``dim_cols`` and the stage."""
    pdim = prepare_dim(dim, dim_id, dim_block, dim_name, kw.get("suffixes", AREA_SUFFIXES))
    keys = fact.select(block, name, zip_col).distinct()
    if materialize:
        # both are read by every stage: write them once to the shared
        # checkpoint folder instead of re-deriving them from the fact
        pdim, keys = cut_lineage(pdim), cut_lineage(keys)
    mapping = cascade_mapping(keys, pdim, xwalk, block, name, zip_col, dim_id, dim_block,
                              carry_blank_keys=carry_blank_keys, **kw)
    if dim_cols:
        attrs = pdim.select(F.col(dim_id).alias("__did"), *dim_cols)
        mapping = mapping.join(attrs, mapping[dim_id] == attrs["__did"], "left").drop("__did")
    return mapping


def join_mapping(rows: DataFrame, mapping: DataFrame, keys, how: str = "left") -> DataFrame:
    """Rows with their key's mapping; null keys match null keys."""
    m = mapping.select(*[F.col(c).alias(f"__m_{c}") for c in keys], *[c for c in mapping.columns if c not in keys])
    cond = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in keys]
    return rows.join(m, cond, how).drop(*[f"__m_{c}" for c in keys])


def resolve_cascade(fact: DataFrame, dim: DataFrame, xwalk: DataFrame, block: str, name: str,
                    zip_col: str, dim_cols=(), dim_id: str = "dim_id", carry_blank_keys: bool = True, flag: str = "has_match", **kw) -> DataFrame:
    """Attach the resolved dimension row to every fact row.

    Output: all fact columns (none projected away, T3), ``dim_id``, the
    requested ``dim_cols``, ``match_stage`` (exact / fuzzy / crosswalk /
    null) and the boolean ``flag``."""
    mapping = place_mapping(fact, dim, xwalk, block, name, zip_col, dim_cols, dim_id, carry_blank_keys=carry_blank_keys, **kw)
    out = join_mapping(fact, mapping, (block, name, zip_col), "left" if carry_blank_keys else "inner")
    return out.withColumn(flag, F.col(dim_id).isNotNull())


def disjunctive_match(keys: DataFrame, xwalk: DataFrame, dim: DataFrame, block: str,
                      name: str, zip_col: str, dim_id: str = "dim_id",
                      dim_block: str = "dim_state", xw_key: str = "zip",
                      xw_name: str = "xw_county", suffixes=AREA_SUFFIXES) -> DataFrame:
    """State equal and (name equal or crosswalk name equal).

    Each side of the OR is an equi-join on (block, name) with a dimension of
    one row per name, so no key meets all names of its block; the smaller id
    of the two is the key's match."""
    x = xwalk.select(F.col(xw_key).alias("__xk"), normalize_name(xw_name, suffixes).alias("__xkey"))
    k = (keys.join(x, keys[zip_col] == x["__xk"], "left")
             .withColumn("__fkey", fact_key(name)))
    d = dim.groupBy(F.col(dim_block).alias("__db"), F.col("match_key").alias("__dkey")).agg(F.min(dim_id).alias("__did"))
    for key, found in (("__fkey", "__by_name"), ("__xkey", "__by_zip")):
        own = d.select(F.col("__db").alias(f"{found}_b"), F.col("__dkey").alias(f"{found}_k"), F.col("__did").alias(found))
        k = k.join(own, (F.col(block) == F.col(f"{found}_b")) & (F.col(key) == F.col(f"{found}_k")), "left")
    return k.groupBy(*keys.columns).agg(F.min(F.least("__by_name", "__by_zip")).alias(dim_id))


# ----------------------------------------------------------------- LSH


def _name_grams(rows: DataFrame, n: int, *keep: str) -> DataFrame:
    """Stored (id, keep.., tokens): distinct character n-grams of ``__v``;
    values shorter than ``n`` have none and are left out (T6)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import NGram, RegexTokenizer
    stages = [RegexTokenizer(pattern="", minTokenLength=0, inputCol="__v", outputCol="__tok"), NGram(n=n, inputCol="__tok", outputCol="__ng")]
    rows = rows.where(F.length("__v") >= n)
    grams = Pipeline(stages=stages).fit(rows).transform(rows)
    return cut_lineage(grams.select("id", *keep, F.array_distinct("__ng").alias("tokens")).where(F.size("tokens") > 0), "name-grams")


def resolve_fuzzy_lsh(keys: DataFrame, dim: DataFrame, block: str, name: str,
                      dim_id: str = "dim_id", dim_block: str = "dim_state", n: int = 3,
                      max_dist: float = 0.25, bands: int = 16, rows: int = 3, seed: int = 42) -> DataFrame:
    """The approximate route: character tokens -> n-grams -> hashing TF ->
    banded MinHash -> candidates that share a band in the same block -> exact
    distance of the n-gram sets below ``max_dist`` -> best per key (J4, M1-M4).

    Its result is a subset of the exact candidates: bands only propose, the
    real sets decide.  A pair at similarity s is proposed with probability
    1 - (1 - s ** rows) ** bands (0.999 at 0.75)."""
    from ledgerlens.operators.neardup import band_postings
    # (block, name) pairs often repeat among keys: each is matched once
    names = keys.select(F.col(block).alias("b"), F.col(name).alias("__n")).distinct()
    names = names.withColumn("id", row_text(["b", "__n"])).withColumn("__v", strip_non_word("__n"))
    k = _name_grams(names, n, "b", "__n")
    d = _name_grams(dim.select(F.col(dim_id).alias("id"), F.col(dim_block).alias("b"), F.col("match_key").alias("__v")), n, "b")
    kp = band_postings(k, bands, rows, seed, by=("b",)).select("key", F.col("id").alias("kid"))
    dp = band_postings(d, bands, rows, seed, by=("b",)).select("key", F.col("id").alias("did"))
    cand = kp.join(dp, "key").select("kid", "did").distinct()
    own = k.select(F.col("id").alias("kid"), "b", "__n", F.col("tokens").alias("tk"))
    other = d.select(F.col("id").alias("did"), F.col("b").alias("db"), F.col("tokens").alias("td"))
    pairs = cand.join(own, "kid").join(other, "did").where(F.col("b") == F.col("db"))
    common = F.size(F.array_intersect("tk", "td"))
    dist = F.lit(1.0) - common.cast("double") / (F.size("tk") + F.size("td") - common).cast("double")
    pairs = pairs.select(F.col("b").alias(block), F.col("__n").alias(name), F.col("did").alias(dim_id), dist.alias("dist")).where(F.col("dist") < max_dist)
    return keys.join(best_match(pairs, [block, name], dim_id), [block, name]).select(*keys.columns, dim_id, "dist")
