"""Near-duplicate documents: banded MinHash and an exact join, both with
groups as their result (J4, J4x, M2-M4 on documents).

Texts become sorted sets of 64-bit shingle hashes; equal sets collapse to one
entry before anything is joined.  Each method makes *postings* (key, id): ids
that share a key are candidates.

* ``band_postings``: MinHash signatures cut into bands; all hashes of a band
  must agree (AND), any band may (OR).  At similarity s a pair meets with
  probability 1 - (1 - s ** rows) ** bands: 0.99 at 0.75, 0.10 at 0.3.
* ``prefix_postings``: every set's rarest ``n - ceil(0.75 n) + 1`` shingles.
  Two sets that link must share one of them under any global order, so none is
  lost.  The order is: not among the corpus's most frequent shingles, then by
  hash; the frequent ones come from one mergeable sketch over all shingles, so
  no table of shingle counts is ever shuffled.

``linked`` verifies candidates on the sets, in two rounds.  First each key's
smallest id meets the others: m copies cost m - 1 candidates and become one
component.  Then only pairs of one key that lie in *different* components meet;
a key with many such ids is dealt into parts and its parts meet two by two, so
no task holds a hot key.  What it returns connects exactly the components that
all links would.  ``all_links`` verifies every candidate and returns every link.
Only pairs that share enough keys are verified, so a set travels for links, not
for chance meetings, and once for all pairs of its group rather than once a pair.

Disk: beside the stored sets, a step's shuffles and tables hold a slice of them
or what shares a key; they are dropped as soon as the step's result is stored.

Document ids are unique.  Null and empty texts, and texts without words, have
no set and are in no group.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.text import words
from ledgerlens.operators.graph import components
from ledgerlens.session import cut_lineage, passing_tables

PERCENT, SHINGLE = 75, 5
#: shingles that the frequency sketch follows and that a set is compared with
FREQUENT, TRACKED = 1000, 16384
#: ids of one key that a task may pair with as many others
PART_IDS = 1000
#: sets of one group of pairs that meet in a task with as many others; bytes of
#: stored sets that are dealt out at once, and the most slices of them
PART_SETS, SLICE_BYTES, SLICES = 256, 32 << 20, 4


def shingle_hashes(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, tokens): sorted distinct hashes of the words' n-grams; a text of
    fewer words has one, of all its words; texts without words are left out."""
    from pyspark.ml.feature import NGram
    w = docs.select(F.col(id_col).alias("id"), words(text_col).alias("__w")).where(F.size("__w") > 0)
    grams = NGram(n=shingle, inputCol="__w", outputCol="__ng").transform(w)
    grams = grams.select("id", F.when(F.size("__w") < shingle, F.array(F.array_join("__w", " "))).otherwise(F.col("__ng")).alias("__ng"))
    return grams.select("id", F.array_sort(F.array_distinct(F.transform("__ng", lambda g: F.xxhash64(g)))).alias("tokens"))


def collapsed(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (id, tokens), id being the smallest of each, and stored
    members (id, rep) of all.  The sets are written once and never shuffled:
    which rows stay is decided on ids and digests, and the rest are left out as
    the sets are read."""
    sets = cut_lineage(sets.withColumn("__d1", F.xxhash64("tokens")).withColumn("__d2", F.xxhash64(F.lit(1), "tokens")), "neardup-sets")
    reps = sets.groupBy("__d1", "__d2").agg(F.min("id").alias("rep"))
    members = cut_lineage(sets.select("id", "__d1", "__d2").join(reps, ["__d1", "__d2"]).select("id", "rep"), "neardup-members")
    copies = cut_lineage(members.where("id <> rep").select("id"), "neardup-copies")
    kept = sets.select("id", "tokens").join(copies, "id", "left_anti")
    # an id that comes twice stays once, and a null one
    twice = cut_lineage(members.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("id").alias("__twice")), "neardup-twice")
    same = F.col("id").eqNullSafe(F.col("__twice"))
    once = cut_lineage(kept.join(twice, same, "left_semi").dropDuplicates(["id"]), "neardup-once")
    return kept.join(twice, same, "left_anti").unionByName(once), members


def band_postings(sets: DataFrame, bands: int = 12, rows: int = 4, seed: int = 42, tokens: str = "tokens", by: tuple = ()) -> DataFrame:
    """(key, id, n, rest) from (id, tokens): a key per band of the MinHash
    signature; ``by``: further columns that must agree."""
    from pyspark.ml.feature import HashingTF, MinHashLSH
    # as wide as the hash family's prime allows: a width is no source of links, as candidates are verified
    tf = HashingTF(inputCol="__t", outputCol="__tf", numFeatures=1 << 30, binary=True)
    hashed = tf.transform(sets.select("id", *by, F.size(tokens).alias("n"), F.col(tokens).cast("array<string>").alias("__t"))).drop("__t")
    if not hashed.limit(1).count():
        return hashed.select(F.lit(0).cast("long").alias("key"), "id", "n", F.col("n").alias("rest"))
    model = MinHashLSH(numHashTables=bands * rows, seed=seed, inputCol="__tf", outputCol="__h").fit(hashed)
    keys = F.array(*(F.xxhash64(F.lit(i), *by, F.slice("__h", i * rows + 1, rows)) for i in range(bands)))
    return model.transform(hashed).select("id", "n", F.col("n").alias("rest"), F.explode(keys).alias("key"))


def prefix_length(n, percent: int = PERCENT):
    return n - F.ceil(n * percent / 100).cast("int") + 1


def frequent_tokens(sets: DataFrame, count: int = FREQUENT) -> list[int]:
    """The most frequent tokens over all sets, from one mergeable sketch.  They
    only decide an order, so that approximate counts lose nothing."""
    top = sets.select(F.explode("tokens").alias("t")).agg(F.expr(f"approx_top_k(t, {count}, {TRACKED})").alias("top")).first()["top"]
    return [r["item"] for r in top or [] if r["count"] > 1]


def prefix_postings(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, id, n, rest) from stored (id, tokens): the prefix of each set and
    the number of tokens after it."""
    often = F.array(*map(F.lit, frequent_tokens(sets))).cast("array<bigint>")
    ordered = F.concat(F.array_except("tokens", often), F.array_intersect("tokens", often))
    n = F.size("tokens")
    return sets.select("id", n.alias("n"), (n - prefix_length(n, percent)).alias("rest"),
                       F.explode(F.slice(ordered, F.lit(1), prefix_length(n, percent))).alias("key"))


@contextmanager
def dealt_by_key(spark):
    """Joins on (key, id) meanwhile use rows as dealt by ``key`` alone."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def meetings(pairs: DataFrame, part_sets: int = PART_SETS) -> DataFrame:
    """Stored (meet, a, b) of stored pairs, a < b: pairs with ids in common get
    one ``meet`` where they can, so that a set goes there once for all of them.
    A group is named by the smallest id that its pairs' ``a`` meets; of a large
    one, parts meet two by two."""
    ends = pairs.select(F.col("a").alias("id"), F.col("a").alias("low")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("low")))
    low = cut_lineage(ends.groupBy("id").agg(F.min("low").alias("group")), "neardup-lows")
    named = cut_lineage(pairs.join(low.withColumnRenamed("id", "a"), "a"), "neardup-named")
    size = named.groupBy("group").agg(F.approx_count_distinct("b").alias("k")).where(F.col("k") > part_sets)
    size = cut_lineage(size, "neardup-group-sizes")
    named = named.join(size, "group", "left").withColumn("parts", F.ceil(F.coalesce("k", F.lit(1)) / part_sets))
    pa, pb = (F.pmod(F.xxhash64(c), F.col("parts")) for c in "ab")
    return cut_lineage(named.select(F.xxhash64("group", F.least(pa, pb), F.greatest(pa, pb)).alias("meet"), "a", "b"), "neardup-meetings")


def slices(df: DataFrame) -> int:
    """In how many slices stored rows are dealt out, by their bytes."""
    stored = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(SLICES, 1 + stored // SLICE_BYTES)


def sliced(df: DataFrame, column: str, i: int, n: int) -> DataFrame:
    """Slice ``i`` of ``n`` of the rows, by the hash of a column."""
    return df.where(F.pmod(F.xxhash64(F.lit(2), column), F.lit(n)) == i) if n > 1 else df


def brought_together(pairs: DataFrame, sets: DataFrame, n: int, result, name: str) -> DataFrame:
    """``result``, stored, of the stored pairs joined with (size, tokens) of both
    ends: ``na``, ``ta``, ``nb``, ``tb``.  Only sets that are in a pair are read,
    in ``n`` slices, and dealt out, a slice at a time, to where their pairs meet."""
    spark, parts = pairs.sparkSession, []
    with passing_tables(spark) as keep:
        pairs = meetings(pairs)
        ends = pairs.select("meet", F.col("a").alias("id")).unionByName(pairs.select("meet", F.col("b").alias("id"))).distinct()
        ends = cut_lineage(ends, "neardup-ids")
        met = [cut_lineage(sliced(sets, "id", i, n).join(sliced(ends, "id", i, n), "id").select("meet", "id", "n", "tokens"), name) for i in range(n)]
        met = reduce(DataFrame.unionByName, met)
        m = slices(met)
        for i in range(m):
            there = sliced(met, "meet", i, m).repartition("meet")
            own = there.select("meet", F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
            other = there.select("meet", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
            # the pairs with one set attached are the large side: streamed past the other sets, not sorted
            both = sliced(pairs, "meet", i, m).join(own, ["meet", "a"]).join(other.hint("shuffle_hash"), ["meet", "b"])
            with dealt_by_key(spark):
                parts.append(keep(cut_lineage(result(both), "neardup-verified")))
    return reduce(DataFrame.unionByName, parts)


def maybe_near(both: DataFrame, percent: int) -> DataFrame:
    """(a, b) that may be ``percent`` alike by 16 bits of each token: values in
    one set of them only come from as many tokens or more in one set only."""
    apart = F.size("ta") + F.size("tb") - 2 * F.size(F.array_intersect("ta", "tb"))
    return both.where((F.col("na") + F.col("nb") - apart) * (100 + percent) >= 2 * percent * (F.col("na") + F.col("nb"))).select("a", "b")


def surely_near(both: DataFrame, percent: int) -> DataFrame:
    """(a, b, dist) that are ``percent`` alike."""
    union = F.col("na") + F.col("nb") - F.col("common")
    near = both.withColumn("common", F.size(F.array_intersect("ta", "tb"))).where(100 * F.col("common") >= percent * union)
    return near.select("a", "b", (F.lit(1.0) - F.col("common") / union).alias("dist"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Stored (a, b, dist) of the pairs whose sets are at least ``percent`` alike
    (0: all pairs).  The pairs are stored first.  Of a large table 16 bits of
    each token are compared before, so that sets travel for few other pairs."""
    n = slices(sets)
    with passing_tables(pairs.sparkSession) as keep:
        pairs = cut_lineage(pairs, "neardup-pairs")
        sets = sets.select("id", F.size("tokens").alias("n"), "tokens")
        if n > 1 and percent:
            short = F.transform("tokens", lambda t: (F.pmod(t, F.lit(65536)) - 32768).cast("short"))
            pairs = brought_together(pairs, sets.withColumn("tokens", F.array_distinct(short)), n, lambda both: maybe_near(both, percent), "neardup-sketches")
        near = brought_together(pairs, sets, n, lambda both: surely_near(both, percent), "neardup-met")
        return keep(cut_lineage(near, "neardup-near"))


def sized(percent: int = PERCENT):
    """Whether two sets of ``na`` and ``nb`` tokens can be ``percent`` alike."""
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def candidates(rows: DataFrame, apart, percent: int = PERCENT, part_ids: int = PART_IDS) -> DataFrame:
    """(a, b) of rows (key, id, n, rest, component, k) that share a key, a < b,
    for which ``apart`` holds and whose keys leave room for enough common
    tokens.  Of two prefixes the one that ends first holds every common token up
    to there, so two sets have at most as many as they share keys and the
    larger ``rest`` together (bands have all their tokens as rest).  ``k``: the
    rows of the key; a key of many is dealt into parts that meet two by two."""
    rows = rows.withColumn("parts", F.ceil(F.col("k") / part_ids).cast("int"))
    part, every = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = rows.select("key", part.alias("p"), every.alias("q"), F.col("id").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra"), F.col("component").alias("ga"))
    right = rows.select("key", every.alias("p"), part.alias("q"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rb"), F.col("component").alias("gb"))
    met = left.join(right, ["key", "p", "q"]).where(F.expr("a < b") & apart).where(sized(percent))
    shared = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("keys"), F.max(F.greatest("ra", "rb")).alias("rest"), F.max(F.col("na") + F.col("nb")).alias("total"))
    return shared.where((F.col("keys") + F.col("rest")) * (100 + percent) >= percent * F.col("total")).select("a", "b")


def sharing(postings: DataFrame) -> DataFrame:
    """Stored (key, id, n, rest, a, na, k) of the k > 1 postings of a key, (a, na)
    being the one of the smallest id.  The postings are shuffled once and never
    stored as a whole."""
    of_key = Window.partitionBy("key")
    rows = postings.select("key", "id", "n", "rest", F.min(F.struct("id", "n")).over(of_key).alias("c"), F.count(F.lit(1)).over(of_key).alias("k"))
    return cut_lineage(rows.where("k > 1").select("key", "id", "n", "rest", F.col("c.id").alias("a"), F.col("c.n").alias("na"), "k"), "neardup-shared")


def linked(postings: DataFrame, sets: DataFrame, percent: int = PERCENT, part_ids: int = PART_IDS) -> DataFrame:
    """Stored links (a, b, dist) among candidates that share a key, enough to
    connect every component of all of them."""
    with passing_tables(sets.sparkSession) as keep:
        shared = sharing(postings).withColumnRenamed("id", "b").withColumnRenamed("n", "nb")
        stars = shared.where("a <> b").where(sized(percent)).select("a", "b").distinct()
        first = cut_lineage(verified(stars, sets, percent), "neardup-links")
        group = components(first).select(F.col("node").alias("id"), "component")
        rest = shared.select("key", F.col("b").alias("id"), F.col("nb").alias("n"), "rest").join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
        rest = cut_lineage(rest, "neardup-rest")
        mixed = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo < hi")
        pairs = candidates(rest.join(mixed.select("key", "k"), "key"), F.expr("ga <> gb"), percent, part_ids)
        return keep(cut_lineage(first.unionByName(verified(pairs, sets, percent)), "neardup-links"))


def all_links(postings: DataFrame, sets: DataFrame, percent: int = PERCENT, part_ids: int = PART_IDS) -> DataFrame:
    """Stored links (a, b, dist), a < b: every one among candidates that share a key."""
    with passing_tables(sets.sparkSession) as keep:
        shared = sharing(postings).withColumn("component", F.col("id"))
        pairs = candidates(shared, F.lit(True), percent, part_ids)
        return keep(cut_lineage(verified(pairs, sets, percent), "neardup-links"))


def groups(members: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Stored (doc, representative, dist) of every document that has one: the smallest
    id of its component, and the distance of the two sets."""
    found = components(links).select(F.col("node").alias("rep"), "component")
    named = cut_lineage(members.join(found, "rep", "left").select("id", "rep", F.coalesce("component", "rep").alias("component")).where("id <> component"), "neardup-groups")
    far = named.where("rep <> component").select(F.col("component").alias("a"), F.col("rep").alias("b")).distinct()
    dist = verified(far, sets, 0).select(F.col("a").alias("component"), F.col("b").alias("rep"), "dist")
    out = named.join(dist, ["component", "rep"], "left").select(F.col("id").alias("doc"), F.col("component").alias("representative"), F.coalesce("dist", F.lit(0.0)).alias("dist"))
    return cut_lineage(out, "neardup-found")


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = 12, rows: int = 4) -> DataFrame:
    """Groups of documents of which at least ``percent`` of the shingles agree,
    by banded MinHash: no false link, some near the threshold may be missed."""
    with passing_tables(docs.sparkSession) as keep:
        sets, members = collapsed(shingle_hashes(docs, id_col, text_col, shingle))
        return keep(groups(members, sets, linked(band_postings(sets, bands, rows), sets, percent)))


def exact_near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The same groups, none missed."""
    with passing_tables(docs.sparkSession) as keep:
        sets, members = collapsed(shingle_hashes(docs, id_col, text_col, shingle))
        return keep(groups(members, sets, linked(prefix_postings(sets, percent), sets, percent)))


def exact_links(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc, representative, dist, n_links) of every document: the smallest id
    that links reach, the distance of the two sets, and how many other documents
    it links with directly, copies included.  Every pair of different sets that
    links is found and verified; copies count by their number."""
    with passing_tables(docs.sparkSession) as keep:
        sets, members = collapsed(shingle_hashes(docs, id_col, text_col, shingle))
        links = all_links(prefix_postings(sets, percent), sets, percent)
        size = cut_lineage(members.groupBy("rep").agg(F.count(F.lit(1)).alias("size")), "neardup-sizes")
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        other = both.join(size.select(F.col("rep").alias("b"), "size"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("size").alias("others"))
        n_links = size.join(other, "rep", "left").select("rep", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
        near = groups(members, sets, links).withColumnRenamed("doc", "id").dropDuplicates(["id", "representative"])
        with_words = keep(cut_lineage(members.join(n_links, "rep").join(near, "id", "left").select(
            F.col("id").alias("doc"), F.coalesce("representative", "id").alias("representative"), F.coalesce("dist", F.lit(0.0)).alias("dist"), "n_links"), "neardup-found"))
    none = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.size(words(text_col)), F.lit(0)).alias("w")).where("w <= 0")
    return with_words.unionByName(none.select("doc", F.col("doc").alias("representative"), F.lit(0.0).alias("dist"), F.lit(0).cast("long").alias("n_links")))
