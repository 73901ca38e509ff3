"""N-gram Jaccard join with signature trees.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Two documents link when ``100 * intersection >= 75 * union``.

1. Equal sets are one entity, so copies never meet as pairs.
2. Shingles are dealt by hash into token partitions, as packed arrays rather
   than rows; each partition counts in how many entities a shingle occurs and
   sends the shared ones back to their entities.
3. An entity can only link with another through one of its ``n - ceil(0.75 n)
   + 1`` rarest shingles (prefix filter; any global order is exact).  Shared
   prefixes connect entities into blocks; no link crosses a block.
4. Within a block a signature tree joins the sets: entities ordered by size,
   nodes of ``FAN`` children that hold the OR of the bitmaps and the range of
   sizes.  A dual traversal drops node pairs whose sizes differ too much,
   whose largest possible overlap is too small, or whose entities are already
   connected; what is left is verified on the sets.  It returns links enough
   to connect each component, never all pairs of a group.
5. A block of more than ``PART_TOKENS`` shingles is split by hash into parts.
   First each part is joined by itself together with a few centres that all
   parts share; then the entities outside the block's largest component are
   joined with every part.  Both are exact; no part holds the block.

Defined cases: a text without words has an empty set and is its own component
(as is a null text); shorter texts have their word sequence as one shingle; a
null id is returned with a null component; repeated rows are copies; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import components, give_back, stored, text_chunks

WORDS, PERCENT = 5, 75
TASK_TOKENS = 2_000_000
PART_TOKENS = 2_000_000
CENTRES = 16
BITS, FAN = 1024, 8
MOST_WORDS = 400_000
BROADCAST_ROWS = 1_000_000
#: bytes of a group after which its worker gives memory back
LARGE_GROUP = 4 << 20


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return found


_HASHES = _Hashes()
_FACTORS = np.array([xxhash.xxh3_64_intdigest(bytes([i])) | 1 for i in range(WORDS)], np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles."""
    words = (text or b"").lower().split()
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))] if words else [], np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).view(np.uint64)
    n = len(h) - WORDS + 1
    x = h[:n] * _FACTORS[0]
    for i in range(1, WORDS):
        x += h[i:i + n] * _FACTORS[i]
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xff51afd7ed558ccd)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xc4ceb9fe1a85ec53)
    x ^= x >> np.uint64(33)
    return np.unique(x)


def entity(tokens: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _returning(run):
    """Of a group's function: after a large group the worker gives back what it
    took, for the stages that follow."""
    def group(table: pa.Table) -> pa.Table:
        large = table.nbytes > LARGE_GROUP
        try:
            return run(table)
        finally:
            if large:
                give_back()
    return group


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            n, names = [], []
            for _, texts in text_chunks(batch.column(1)):
                for s in map(shingles, texts):
                    n.append(len(s))
                    names.append(entity(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(names, pa.int64())], names=["key", "n", "entity"])
    finally:
        _HASHES.clear()
        give_back()


def _binary(parts) -> pa.Array:
    return pa.array([x.tobytes() for x in parts], pa.binary())


def _deal(partitions: int):
    """Pack the shingles of some texts by token partition: (entity, size, how many) for each text, and 32 bits of each shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for _, texts in text_chunks(batch.column(0)):
                    sets = [s for s in map(shingles, texts) if len(s)]
                    if sets:
                        yield _dealt(sets, partitions)
        finally:
            _HASHES.clear()
            give_back()
    return run


def _dealt(sets: list[np.ndarray], partitions: int) -> pa.RecordBatch:
    names, sizes = np.array([entity(s) for s in sets], np.int64), np.array([len(s) for s in sets], np.int32)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    part = ((tokens >> np.uint64(32)) % np.uint64(partitions)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    low, owner, part = (tokens[order] & np.uint64(0xffffffff)).astype(np.uint32), owner[order], part[order]
    cuts = np.searchsorted(part, np.arange(partitions + 1))
    out = []
    for p in range(partitions):
        if cuts[p] < cuts[p + 1]:
            who, many = np.unique(owner[cuts[p]:cuts[p + 1]], return_counts=True)
            out.append((p, names[who], sizes[who], many.astype(np.int32), low[cuts[p]:cuts[p + 1]]))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *(_binary(x[i] for x in out) for i in range(1, 5))],
                                      names=["part", "entities", "sizes", "many", "low"])


def _joined(column, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column] or [np.empty(0, kind)])


def _shared(buckets: int):
    """Of one token partition: shingles in two entities or more, packed by bucket of the entity, with their frequency class."""
    def run(table: pa.Table) -> pa.Table:
        entities, sizes, many = _joined(table["entities"], np.int64), _joined(table["sizes"], np.int32), _joined(table["many"], np.int32)
        low = _joined(table["low"], np.uint32)
        row = np.repeat(np.arange(len(entities), dtype=np.int32), many)
        order = np.lexsort((entities[row], low))
        low, row = low[order], row[order]
        who = entities[row]
        fresh = np.ones(len(low), bool)
        fresh[1:] = (low[1:] != low[:-1]) | (who[1:] != who[:-1])  # copies of a text count once
        low, row, who = low[fresh], row[fresh], who[fresh]
        first = np.nonzero(np.r_[True, low[1:] != low[:-1]])[0] if len(low) else np.empty(0, np.int64)
        often = np.diff(np.r_[first, len(low)])
        often = np.repeat(often, often)
        keep = often > 1
        low, row, who, often = low[keep], row[keep], who[keep], often[keep]
        grade = np.where(often < 128, often, np.minimum(255, 121 + np.log2(np.maximum(often, 1)).astype(np.int64))).astype(np.uint8)
        bucket = (who % buckets).astype(np.int32)
        order = np.lexsort((low, who, bucket))
        low, row, who, grade, bucket = low[order], row[order], who[order], grade[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        out = []
        for b in range(buckets):
            if cuts[b] < cuts[b + 1]:
                c = slice(cuts[b], cuts[b + 1])
                names, at, counts = np.unique(who[c], return_index=True, return_counts=True)
                out.append((b, names, sizes[row[c][at]], counts.astype(np.int32), low[c], grade[c]))
        part = table["part"][0].as_py() if len(table) else 0
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([part] * len(out), pa.int32()), *(_binary(x[i] for x in out) for i in range(1, 6))],
                        names=["bucket", "part", "entities", "sizes", "many", "low", "grade"])
    return run


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def _prefixes(table: pa.Table) -> pa.Table:
    """Of one bucket of entities: their shared shingles that lie in the prefix, rarest shingles first (those of one entity alone before all)."""
    sizes, many = _joined(table["sizes"], np.int32), _joined(table["many"], np.int32)
    rows = np.repeat(np.arange(len(sizes)), many)
    who, n = _joined(table["entities"], np.int64)[rows], sizes[rows].astype(np.int64)
    parts = np.repeat([x.as_py() for x in table["part"]], [len(x.as_buffer()) // 4 for x in table["low"]]).astype(np.int64)
    token, grade = (parts << 32) | _joined(table["low"], np.uint32).astype(np.int64), _joined(table["grade"], np.uint8)
    order = np.lexsort((token, grade, who))
    who, n, token = who[order], n[order], token[order]
    first = np.nonzero(np.r_[True, who[1:] != who[:-1]])[0] if len(who) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(who)])
    rank, shared = np.arange(len(who)) - np.repeat(first, counts), np.repeat(counts, counts)
    # one more than needed, in case two shingles of an entity agree in the bits that travel
    keep = rank < prefix_length(n) + 1 - (n - shared)
    return pa.table({"token": token[keep], "entity": who[keep]})


class Tree:
    """Signature tree over sets ordered by size: nodes are ranges of ``FAN ** level`` entries."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        bits = np.zeros((len(sets), BITS), bool)
        for i, s in enumerate(sets):
            bits[i, (s & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        slack = self.n - bits.sum(axis=1)
        self.levels = [(packed, self.n, self.n, slack)]
        while len(self.levels[-1][1]) > 1:
            bitmap, low, high, slack = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bitmap, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which node pairs may hold a link, by size range and largest possible overlap.

        Shingles on bits outside the other's bitmap are not common, so an
        overlap is at most the common bits and the shingles that share a bit."""
        bitmap, low, high, slack = self.levels[level]
        sized = (100 * high[a][:, None] >= PERCENT * low[b]) & (100 * high[b] >= PERCENT * low[a][:, None])
        common = np.bitwise_count(bitmap[a][:, None, :] & bitmap[b][None, :, :]).sum(axis=2, dtype=np.int64) + np.minimum(slack[a][:, None], slack[b])
        return sized & ((100 + PERCENT) * common >= PERCENT * (low[a][:, None] + low[b]))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def tree_links(sets: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect every component of the sets beyond ``label`` (equal
    labels: already connected; changed in place)."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, given = [sets[i] for i in order], label
    label = given[order].copy()
    tree, links = Tree(sets), []

    def one(level: int, i: int) -> tuple[int, int]:
        span = FAN ** level
        return i * span, min(len(sets), (i + 1) * span)

    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        (a0, a1), (b0, b1) = one(level, i), one(level, j)
        if (label[a0:a1] == label[a0]).all() and (label[b0:b1] == label[a0]).all():
            continue
        if level == 0:
            if i != j and similar(sets[i], sets[j]):
                links.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
            continue
        below = len(tree.levels[level - 1][1])
        a, b = np.arange(i * FAN, min(below, (i + 1) * FAN)), np.arange(j * FAN, min(below, (j + 1) * FAN))
        may = tree.possible(level - 1, a, b)
        if level == 1:
            may &= label[a][:, None] != label[b]
        x, y = np.nonzero(may)
        pairs = [(level - 1, int(a[p]), int(b[q])) for p, q in zip(x, y, strict=True) if a[p] <= b[q] or i != j]
        # nearest in size last, so taken first: components grow early and prune the rest
        pairs.sort(key=lambda t: -abs(t[1] - t[2]))
        stack.extend(pairs)
    given[order] = label
    return links


def _join_part(table: pa.Table) -> pa.Table:
    """Links within one part; of entities that are there twice (as centres) the first stays."""
    names, at = np.unique(table["entity"].to_numpy(), return_index=True)
    labels = table["label"].to_numpy()[at]
    tokens = [np.frombuffer(table["tokens"][int(i)].as_buffer(), np.uint64) for i in at]
    links = tree_links(tokens, labels.copy()) if len(names) > 1 else []
    return pa.table({"a": pa.array([int(names[i]) for i, _ in links], pa.int64()), "b": pa.array([int(names[j]) for _, j in links], pa.int64())})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                sets = [shingles(t) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array([entity(s) for s in sets], pa.int64()),
                                                  pa.array([len(s) for s in sets], pa.int64()), _binary(sets)], names=["block", "entity", "n", "tokens"])
    finally:
        _HASHES.clear()
        give_back()


def block_links(sets: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """Links (a, b) from stored (block, entity, n, tokens): one row per entity."""
    links = "a long, b long"
    sized = stored(sets.groupBy("block").agg(F.ceil(F.sum("n") / part_tokens).cast("int").alias("parts")), "join-blocks")
    sets = sets.join(sized, "block").withColumn("label", F.col("entity"))
    placed = sets.withColumn("part", F.pmod(F.xxhash64("entity"), F.col("parts")))
    large = sized.where("parts > 1")
    if not large.limit(1).count():
        return stored(placed.groupBy("block", "part").applyInArrow(_returning(_join_part), links), "join-links")
    by_hash = Window.partitionBy("block").orderBy(F.xxhash64("entity"))
    centre = sets.where("parts > 1").select("block", "entity").withColumn("k", F.row_number().over(by_hash)).where(f"k <= {CENTRES}").select("block", "entity")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    centres = sets.join(centre, ["block", "entity"], "left_semi").withColumn("part", everywhere)
    first = stored(placed.unionByName(centres).groupBy("block", "part").applyInArrow(_returning(_join_part), links), "join-links")
    found = components(first).select(F.col("node").alias("entity"), F.col("component").alias("found"))
    again = stored(sets.where("parts > 1").join(found, "entity", "left").withColumn("label", F.coalesce("found", "entity")).drop("found"), "join-again")
    main = again.groupBy("block", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("block").agg(F.max(F.struct("k", "label")).alias("x"), F.count(F.lit(1)).alias("left"))
    again = again.join(main.where("left > 1").select("block", F.col("x.label").alias("main")), "block")
    spread = again.where("label <> main").withColumn("part", everywhere).unionByName(
        again.where("label = main").withColumn("part", F.pmod(F.xxhash64("entity"), F.col("parts"))))
    second = spread.groupBy("block", "part").applyInArrow(_returning(_join_part), links)
    return stored(first.unionByName(second), "join-links")


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", part_tokens: int = PART_TOKENS) -> DataFrame:
    """Per row: key, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    sets = stored(rows.mapInArrow(_describe, "key long, n long, entity long"), "join-sets")
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    parts = 1 + tokens // TASK_TOKENS
    packed = rows.select("text").mapInArrow(_deal(parts), "part int, entities binary, sizes binary, many binary, low binary")
    shared = packed.groupBy("part").applyInArrow(_returning(_shared(parts)), "bucket int, part int, entities binary, sizes binary, many binary, low binary, grade binary")
    prefixes = stored(shared.groupBy("bucket").applyInArrow(_returning(_prefixes), "token long, entity long"), "join-prefixes")
    least = prefixes.groupBy("token").agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    edges = prefixes.join(least, "token").where("entity <> first").select(F.col("entity").alias("a"), F.col("first").alias("b"))
    blocks = stored(components(edges).select(F.col("node").alias("entity"), F.col("component").alias("block")), "join-members")
    chosen = sets.where("key is not null").groupBy("entity").agg(F.min("key").alias("key")).join(blocks, "entity").select("key", "entity", "block")
    chosen = stored(chosen, "join-chosen")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    own = rows.join(chosen.select("key", F.col("entity").alias("wanted"), "block"), "key")
    members = own.select("block", "text").mapInArrow(_sets, "block long, entity long, n long, tokens binary")
    # a repeated id may bring in other texts; only the blocks' entities count, once each
    members = stored(members.join(F.broadcast(blocks) if blocks.count() <= BROADCAST_ROWS else blocks, ["entity", "block"], "left_semi"), "join-texts")
    links = block_links(members, part_tokens)
    named = components(links).select(F.col("node").alias("entity"), F.col("component").alias("linked"))
    rows = stored(sets.join(named, "entity", "left").withColumn("group", F.coalesce("linked", "entity")).select("key", "n", "group"), "join-rows")
    smallest = rows.where("group is not null").groupBy("group").agg(F.min("key").alias("component_id"))
    return (rows.join(smallest, "group", "left")
                .select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id")))
