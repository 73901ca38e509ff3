"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that one shard holds whole.  Groups larger
than ``total / (shards * FINE)`` are packed as they are: there are at most
``shards * FINE`` of them, whatever the input.  The others, each below a
thousandth of a shard, travel in ``shards * BUNDLES`` bundles chosen by a hash
of the text.  These bounded items are sorted by size and enter the bin with
the tightest sufficient room; the smallest capacity for which they fit into
the wanted number of shards is found by bisection.  Everything that grows with
the rows (sizes, digests, slots) stays distributed.

Defined cases: null text counts as empty (16 bytes, one group with empty
texts); repeated rows share a group; a group above the capacity gets the
emptiest shard; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import numbered, stored

FINE = 1000
BUNDLES = 500


class RoomTree:
    """Balanced two-level search tree of (room, bin): sorted leaves of at most
    2 * ``leaf`` entries under one sorted level of their largest entries."""

    def __init__(self, entries: list[tuple[int, int]], leaf: int = 256):
        entries = sorted(entries)
        self.leaf = leaf
        self.leaves = [entries[i:i + leaf] for i in range(0, len(entries), leaf)] or [[]]
        self.tops = [x[-1] if x else (0, 0) for x in self.leaves]

    def add(self, entry: tuple[int, int]) -> None:
        i = min(bisect_left(self.tops, entry), len(self.leaves) - 1)
        insort(self.leaves[i], entry)
        if len(self.leaves[i]) > 2 * self.leaf:
            self.leaves[i:i + 1] = [self.leaves[i][:self.leaf], self.leaves[i][self.leaf:]]
            self.tops.insert(i, self.leaves[i][-1])
            i += 1
        self.tops[i] = self.leaves[i][-1]

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove and return the entry with the least room that is enough."""
        i = bisect_left(self.tops, (room, -1))
        if i == len(self.leaves) or not self.leaves[i]:
            return None
        at = bisect_left(self.leaves[i], (room, -1))
        if at == len(self.leaves[i]):
            return None
        entry = self.leaves[i].pop(at)
        if self.leaves[i]:
            self.tops[i] = self.leaves[i][-1]
        elif len(self.leaves) > 1:
            del self.leaves[i], self.tops[i]
        return entry

    def largest(self) -> tuple[int, int]:
        entry = self.leaves[-1][-1]
        return self.take(entry[0]) if self.leaves[-1][0][0] == entry[0] else self._pop_last()

    def _pop_last(self) -> tuple[int, int]:
        entry = self.leaves[-1].pop()
        self.tops[-1] = self.leaves[-1][-1]
        return entry


def best_fit(sizes: list[int], capacity: int, bins: int | None = None) -> tuple[list[int], int]:
    """Bins of the items, which must come in descending size, and how many
    were needed.  With ``bins`` all of these are open from the start and an
    item that fits nowhere enters the emptiest; without, it opens a new one."""
    tree = RoomTree([(capacity, b) for b in range(bins or 0)])
    placed, used, overflow = [], bins or 0, 0
    for size in sizes:
        found = tree.take(size)
        if found is None and bins is None:
            found, used = (max(capacity, size), used), used + 1
        elif found is None:
            overflow, found = overflow + 1, tree.largest()
        placed.append(found[1])
        tree.add((found[0] - size, found[1]))
    return placed, used if bins is None else overflow


def tightest(sizes: list[int], bins: int, steps: int = 14) -> list[int]:
    """Best-fit-decreasing into ``bins`` shards at the least capacity found."""
    total = sum(sizes)
    low = max(-(-total // bins), sizes[0] if sizes else 1)
    high = low + (sizes[0] if sizes else 0)
    best, _ = best_fit(sizes, high, bins)
    for _ in range(steps):
        if low >= high:
            break
        middle = (low + high) // 2
        placed, overflow = best_fit(sizes, middle, bins)
        if overflow:
            low = middle + 1
        else:
            best, high = placed, middle
    return best


def shard(docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id", overhead: int = 16) -> DataFrame:
    """Per row: key, size, text_crc32, shard, slot (gapless from 0 inside the shard), group digest."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(F.col(key).alias("key"), (F.octet_length(body) + overhead).cast("long").alias("size"),
                              F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.sha2(F.encode(body, "UTF-8"), 256).alias("group")), "shard-rows")
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * (shards * FINE) > total
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * BUNDLES)).cast("string")
    # at most shards * (FINE + BUNDLES) items
    items = (groups.select(F.when(large, F.col("group")).otherwise(bundle).alias("item"), "bytes")
                   .groupBy("item").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "item").collect())
    bins = tightest([r["bytes"] for r in items], shards)
    plan = spark.createDataFrame([(r["item"], int(b)) for r, b in zip(items, bins, strict=True)], "item string, shard int")
    plan = F.broadcast(stored(plan.coalesce(1), "shard-plan"))
    item = rows.join(plan.select(F.col("item").alias("group"), F.col("shard").alias("own")), "group", "left").withColumn("bundle", bundle)
    item = item.join(plan.select(F.col("item").alias("bundle"), F.col("shard").alias("carried")), "bundle", "left")
    placed = stored(item.select("key", "size", "text_crc32", "group", F.coalesce("own", "carried").alias("shard")), "shard-placed")
    return (numbered(placed, ["shard"], [F.col("group"), F.col("key")], "slot")
            .select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "group"))
