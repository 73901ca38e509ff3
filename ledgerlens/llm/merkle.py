"""Merkle manifest of a dataset, as SQL over concatenated-level strings.

Every row is a leaf: the hash of its fields.  The leaves of a group (a
language) are numbered in order of their keys and dealt into aligned blocks of
``FAN ** HEIGHT``.  A block keeps each level of its tree as one string of
digests, 64 hex digits a node: the children of node i are the substring of
width ``64 * FAN`` at i, its hash is a digit run of the next level, and what
flanks a node in its parent's substring are its siblings.  The blocks' roots
are the leaves of the next round, until a group has one node left; the groups'
roots form a last tree in the same way.  Paths come back down from round to
round, so a leaf meets its siblings inside its block and nowhere else.

All is built from DataFrame functions.  A row crosses two shuffles as digests
(one sorts, one makes blocks); texts cross none.  Blocks have at most 512
leaves whatever the size of their group, and each round has 1/512 of the rows
of the last.

Defined cases: null fields are ``-``; a null group comes first; null keys come
first; rows of one key are ordered by their leaves, equal leaves are
interchangeable; a group of one leaf has it as its root, with no siblings; an
empty table gives an empty result; texts of any length are hashed whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

FAN, HEIGHT, DIGITS = 8, 3, 64
BLOCK = FAN ** HEIGHT
RUN = FAN * DIGITS
#: more (group, partition) pairs than this are joined, not broadcast
BROADCAST_ROWS = 200_000

PATH = "array<struct<left: string, right: string>>"


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def ordered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """Stored rows with ``rank`` (gapless within ``group``, in the order given)
    and ``total`` (rows of the group).

    Rows are range-sorted by group and order, so a group that holds most rows
    spans many partitions; a row's rank is its place in its partition plus the
    rows that its group has in the partitions before.  The last sort key is
    the row's place in the input, so even equal rows are dealt out."""
    nodes = nodes.withColumn("__place", F.monotonically_increasing_id())
    keys = ["group", *order, "__place"]
    at = F.monotonically_increasing_id()
    rows = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(rows.withColumn("__part", F.spark_partition_id()).withColumn("__at", at).drop("__place"), name)
    sizes = rows.groupBy("group", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
                        .withColumn("total", F.sum("__n").over(Window.partitionBy("group"))).drop("__n"), name + "-sizes")
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    return (rows.join(sizes, ["group", "__part"])
                .withColumn("rank", F.col("__before") + F.col("__at") - F.col("__first"))
                .drop("__part", "__at", "__first", "__before"))


def _parents(level: Column) -> Column:
    """The next level's string: hashes of fixed-width substrings."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def blocks(nodes: DataFrame, carried: list[str], name: str) -> DataFrame:
    """Stored blocks of (group, rank, total, node, carried ..): block, total
    (blocks of the group), levels (of the tree above the nodes), l0 .. l2 (the
    levels as strings), root, members (the carried columns in order)."""
    made = (nodes.groupBy("group", F.expr(f"rank div {BLOCK}").alias("block"))
                 .agg(F.first("total").alias("nodes"), F.array_sort(F.collect_list(F.struct("rank", "node", *carried))).alias("members")))
    made = made.withColumn("l0", F.array_join("members.node", ""))
    # a block of several takes all its levels, a lone one as many as leave one node
    levels = F.lit(HEIGHT)
    for k in reversed(range(HEIGHT)):
        levels = F.when(F.col("nodes") <= FAN ** k, F.lit(k)).otherwise(levels)
    made = made.withColumn("levels", levels)
    for k in range(1, HEIGHT + 1):
        made = made.withColumn(f"l{k}", F.when(F.col("levels") >= k, _parents(F.col(f"l{k - 1}"))))
    made = made.withColumn("root", F.coalesce(*(F.col(f"l{k}") for k in reversed(range(HEIGHT + 1)))))
    keep = [F.transform("members", lambda m: F.struct(*(m[c] for c in carried))).alias("members")] if carried else [F.size("members").alias("size")]
    return stored(made.select("group", "block", F.ceil(F.col("nodes") / BLOCK).cast("long").alias("total"), "levels",
                              *(f"l{k}" for k in range(HEIGHT)), "root", *keep), name)


def _step(run: Column, i: Column) -> Column:
    """What flanks node ``i`` of a parent's substring."""
    return F.struct(F.substring(run, F.lit(1), i * DIGITS).alias("left"), F.substring(run, i * DIGITS + DIGITS + 1, F.lit(RUN)).alias("right"))


def _above(j: Column) -> Column:
    """Path of the block's node j of level 1 to the root of the block."""
    none = F.array().cast(PATH)
    out = none
    for k in range(1, HEIGHT):
        i = F.floor(j / FAN ** (k - 1)).cast("int")
        run = F.substring(F.col(f"l{k}"), F.floor(i / FAN).cast("int") * RUN + 1, F.lit(RUN))
        out = F.concat(out, F.when(F.col("levels") > k, F.array(_step(run, i % FAN)).cast(PATH)).otherwise(none))
    return out


def runs(made: DataFrame) -> DataFrame:
    """Blocks by runs of ``FAN`` nodes: their columns, run (its number in the
    block), digits (the run's nodes), above (path from the run's parent to the block's root)."""
    size = F.size("members") if "members" in made.columns else F.col("size")
    rows = made.withColumn("run", F.explode(F.sequence(F.lit(0), F.ceil(size / FAN).cast("int") - 1)))
    return (rows.withColumn("digits", F.substring(F.col("l0"), F.col("run") * RUN + 1, F.lit(RUN)))
                .withColumn("above", _above(F.col("run"))))


def own_path(i: Column) -> Column:
    """Path of node ``i`` of a run to the root of its block."""
    return F.when(F.col("levels") > 0, F.concat(F.array(_step(F.col("digits"), i)).cast(PATH), F.col("above"))).otherwise(F.array().cast(PATH))


def paths(made: DataFrame, upper: DataFrame | None) -> DataFrame:
    """(group, rank, path) of the nodes that ``made`` blocks, to the group's
    root; ``upper``: (group, rank, path) of the blocks."""
    if upper is None:
        made = made.withColumn("path", F.array().cast(PATH))
    else:
        made = made.join(upper.withColumnRenamed("rank", "block"), ["group", "block"])
    rows = runs(made)
    last = F.length("digits") / DIGITS
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), last.cast("int") - 1)))
    return rows.select("group", (F.col("block") * BLOCK + F.col("run") * FAN + F.col("i")).alias("rank"), F.concat(own_path(F.col("i")), F.col("path")).alias("path"))


def forest(nodes: DataFrame, carried: list[str], name: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Trees of all groups of (group, rank, total, node, carried ..): the first
    round's blocks, the roots (group, root), and the paths (group, rank, path)
    of those blocks (None if all groups have one)."""
    rounds = [blocks(nodes, carried, f"{name}-0")]
    while rounds[-1].where("total > 1").limit(1).count():
        # a group that is down to its root goes on as a block of one node, with no level
        rounds.append(blocks(rounds[-1].select("group", F.col("block").alias("rank"), "total", F.col("root").alias("node")), [], f"{name}-{len(rounds)}"))
    roots = rounds[-1].select("group", "root")
    upper = None
    for made in reversed(rounds[1:]):
        upper = stored(paths(made, upper), f"{name}-paths")
    return rounds[0], roots, upper


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", suspect: dict[str, Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """Per row: key, group, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``fields`` make the leaf.  ``suspect`` replaces fields of the rows that
    ``where`` picks in what is verified against the manifest (nothing: the rows
    as they are)."""
    changed = [F.when(where, suspect[f]).otherwise(F.col(f)) if suspect and f in suspect else F.col(f) for f in fields]
    own = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # bytewise order, null first
    leaves = docs.select(F.col(key).alias("doc"), own.alias("group"), sha(*(field(F.col(f)) for f in fields)).alias("node"),
                         (sha(*map(field, changed)) if suspect else F.lit(None).cast("string")).alias("given"))
    # equal to the leaf mostly: null then, to keep the digest from travelling twice
    leaves = stored(leaves.withColumn("given", F.expr("nullif(given, node)")), "merkle-leaves")
    base, roots, upper = forest(ordered(leaves, ["doc", "node"], "merkle-ranked"), ["doc", "given"], "merkle")
    subroots = ordered(roots.select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("node")), ["name"], "merkle-subroots")
    top, top_root, top_upper = forest(subroots, ["name"], "merkle-top")
    if top_upper is None:
        top = top.withColumn("path", F.array().cast(PATH))
    else:
        top = top.join(top_upper.withColumnRenamed("rank", "block"), ["group", "block"])
    top = runs(top).withColumnRenamed("path", "upper").join(F.broadcast(top_root.withColumnRenamed("root", "all")), "group")
    top = top.select("run", "levels", "digits", "above", "upper", "members", "all",
                     F.explode(F.sequence(F.lit(0), (F.length("digits") / DIGITS).cast("int") - 1)).alias("i"))
    named = stored(top.select(F.get("members", F.col("run") * FAN + F.col("i"))["name"].alias("group"),
                              F.substring("digits", F.col("i") * DIGITS + 1, F.lit(DIGITS)).alias("subroot"),
                              F.concat(own_path(F.col("i")), F.col("upper")).alias("last"), "all"), "merkle-languages")
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    made = base.withColumn("path", F.array().cast(PATH)) if upper is None else base.join(upper.withColumnRenamed("rank", "block"), ["group", "block"])
    rows = runs(made.join(named, "group"))
    rows = rows.select("group", "levels", "digits", "above", F.concat("path", "last").alias("upper"), "subroot", "all",
                       F.posexplode(F.slice("members", F.col("run") * FAN + 1, FAN)).alias("i", "m"))
    rows = rows.select(F.col("m.doc").alias("doc"), "group", F.substring("digits", F.col("i") * DIGITS + 1, F.lit(DIGITS)).alias("leaf"), "m.given",
                       "subroot", "all", F.concat(own_path(F.col("i")), F.col("upper")).alias("path"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    rows = rows.select("doc", "group", "leaf", "subroot", "all", proof.alias("proof_sha256"), fold(F.coalesce("given", "leaf"), F.col("path")).alias("folded_root"))
    return rows.select(F.col("doc").alias(key), F.when(F.col("group") != "", F.expr("substring(group, 2)")).alias(group), "leaf", "subroot",
                       F.col("all").alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.col("all")).alias("verified"))
