"""Phrase collocations by SETM: set-oriented mining over occurrence relations.

The relation R(k) has a row (position, group) for every occurrence of a phrase
of k words.  Texts are laid one after another into blocks, pieces apart, and a
block's rows are sorted by position.  Blocks are persisted as one packed
sequence of group numbers, one table a length: neighbours in the sequence are
neighbours in the text, a 0 stands wherever they are not, so positions need no
column.

1. R(1) holds all words.  Each block counts its distinct ones; a grouped sum
   over blocks gives the frequent groups.
2. Blocks are semi-joined with the frequent groups.  Up to ``BROADCAST_GROUPS``
   of these go to every task as a sorted array; beyond, distinct (block, group)
   rows are joined with them and co-grouped with the blocks.
3. What is left is merge-joined with itself at adjacent positions: the k-gram
   at p and the one at p + 1 make a (k+1)-gram, known by the pair of their
   groups.  Both must be frequent, so nothing infrequent is extended.
4. The new relation is persisted, counted, and so on up to ``longest`` words.

A group that occurs everywhere has one row a block, never one an occurrence;
sums are combined before the shuffle.  Tasks hold one block (``BLOCK_BYTES`` of
text, or one longer text).  Only tables of a counted size are broadcast.

Defined cases: a null language is ``und``, a null text empty; phrases never
cross pieces or texts; overlaps count; repeated rows count each time; of cuts
with equal scores the first counts; ranks are total, as a language's phrases
differ; an empty table gives an empty result; very long texts are blocks of
their own; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored
from ledgerlens.llm.words import coded

BLOCK_BYTES = 8 << 20
BROADCAST_ROWS = 400_000
#: about 50 MB as arrays
BROADCAST_GROUPS = 3_000_000
SLICES, SLICE_ROWS = 16, 1_000_000
FLAT_ROWS = 100_000
#: two numbers below this make one 64-bit key
ONE_KEY = 1 << 31
#: ends of pieces become line feeds, the two spaces become one
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n\n ")

FIRST = "sequence binary, langs array<string>, totals array<long>, owner array<int>, words array<binary>, counts array<long>"
NEXT = "block long, sequence binary, a binary, b binary, counts binary, ids binary"


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed: small ones cost little."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(numbers).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.empty(0, np.uint32)
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def laid(sequence: np.ndarray) -> np.ndarray:
    """A sequence with one 0 between stretches, and none at its ends."""
    keep = sequence > 0
    keep[1:] |= sequence[:-1] > 0
    return sequence[keep]


def lay(texts: dict[str, list[bytes]]) -> pa.RecordBatch:
    """R(1) of one block of lower-cased, translated texts by language."""
    sequence, totals, owner, words, counts, known = [], [], [], [], [], 0
    for k, own in enumerate(texts.values()):
        at, tokens = coded(b"\n".join([*own, b""]).replace(b"\n", b" \n "))
        hole = tokens.index(b"\n")
        word = at != hole
        number = at - (at > hole)
        sequence += [np.where(word, number + known + 1, 0), np.zeros(1, np.int64)]
        tokens.pop(hole)
        totals.append(int(word.sum()))
        owner += [k] * len(tokens)
        words += tokens
        counts.append(np.bincount(number[word], minlength=len(tokens)))
        known += len(tokens)
    return pa.RecordBatch.from_arrays(
        [pa.array([packed(laid(np.concatenate(sequence)))], pa.binary()), pa.array([list(texts)], pa.list_(pa.string())), pa.array([totals], pa.list_(pa.int64())),
         pa.array([owner], pa.list_(pa.int32())), pa.array([words], pa.list_(pa.binary())), pa.array([np.concatenate(counts)], pa.list_(pa.int64()))],
        names=["sequence", "langs", "totals", "owner", "words", "counts"])


def _lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            own = (text.as_py() or b"").lower().translate(PIECES)
            texts.setdefault(lang, []).append(own)
            size += len(own) + 1
            if size >= BLOCK_BYTES:
                yield lay(texts)
                texts, size = {}, 0
    if texts:
        yield lay(texts)


def meet(block: int, sequence: np.ndarray, local: np.ndarray, ids: np.ndarray) -> list[list]:
    """One block of R(k) and its frequent groups (numbers in the block, ids): the row of R(k + 1)."""
    new = np.zeros(max(int(sequence.max(initial=0)), int(local.max(initial=0)) + 1) + 1, np.int64)
    new[local + 1] = np.arange(1, len(local) + 1)
    sequence = new[sequence]
    # both sides are sorted by position: a row's only partner is the next one, if no 0 comes between
    left, right = sequence[:-1], sequence[1:]
    both = (left > 0) & (right > 0)
    pairs, number, counts = np.unique((left[both] - 1) << 32 | (right[both] - 1), return_inverse=True, return_counts=True)
    longer = np.zeros(len(left), np.int64)
    longer[both] = number + 1
    return [[x] for x in (block, packed(laid(longer)), packed(pairs >> 32), packed(pairs & 0xffffffff), packed(counts), ids.astype("<i8").tobytes())]


NAMES, KINDS = ["block", "sequence", "a", "b", "counts", "ids"], [pa.int64(), *[pa.binary()] * 5]


def _meet(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    rows = [[]] * 6
    if len(relation) and len(frequent):
        rows = meet(relation["block"][0].as_py(), unpacked(relation["sequence"][0].as_py()), frequent["local"].to_numpy(), frequent["id"].to_numpy())
    return pa.table([pa.array(x, t) for x, t in zip(rows, KINDS, strict=True)], names=NAMES)


def _meet_words(shared):
    """Blocks of R(1) with the frequent words (lang, word, id) of all languages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        own = {lang: table.filter(pc.equal(table["lang"], lang)) for lang in pc.unique(table["lang"]).to_pylist()}
        for batch in batches:
            for i in range(len(batch)):
                block, sequence, langs, owner = (batch.column(c)[i].as_py() for c in ("block", "sequence", "langs", "owner"))
                words, owner = batch.column("words")[i].values.cast(pa.string()), np.array(owner, np.int64)
                local, ids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for k, lang in enumerate(langs):
                    here = np.flatnonzero(owner == k)
                    if lang in own and len(here):
                        at = pc.index_in(words.take(pa.array(here)), own[lang]["word"].combine_chunks()).to_numpy(zero_copy_only=False)
                        found = ~np.isnan(at)
                        local.append(here[found])
                        ids.append(own[lang]["id"].to_numpy()[at[found].astype(np.int64)])
                rows = meet(block, unpacked(sequence), np.concatenate(local), np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, KINDS, strict=True)], names=NAMES)
    return run


def _meet_pairs(shared):
    """Blocks of R(k), k > 1, with the frequent pairs (sorted a << 32 | b, id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers = shared.value
        for batch in batches:
            for block, sequence, a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "sequence", "a", "b", "ids")), strict=True):
                ids = np.frombuffer(ids, "<i8")
                pair = ids[unpacked(a)] << 32 | ids[unpacked(b)]
                at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
                local = np.flatnonzero(keys[at] == pair) if len(keys) else np.empty(0, np.int64)
                rows = meet(block, unpacked(sequence), local, numbers[at[local]])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, KINDS, strict=True)], names=NAMES)
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct groups of blocks: block, local, the pair (a, b) and how often."""
    for batch in batches:
        for block, a, b, counts, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b, counts, ids = unpacked(a), unpacked(b), unpacked(counts), np.frombuffer(ids, "<i8")
            for k in range(0, len(a), FLAT_ROWS):
                own = slice(k, k + FLAT_ROWS)
                n = len(a[own])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block), pa.int64()), pa.array(np.arange(k, k + n), pa.int32()), pa.array(ids[a[own]]), pa.array(ids[b[own]]),
                                                  pa.array(counts[own].astype(np.int64))], names=["block", "local", "a", "b", "c"])


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint for a stored table after its rows were counted."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def frequent(groups: DataFrame, by: list[str], least: int, name: str, one_key: bool = False) -> DataFrame:
    """Stored (id, by .., f): groups of (block, local, by .., c) found ``least``
    times or more, numbered from 0 without gaps.  ``one_key``: a and b travel as one number."""
    if one_key:
        sums = groups.groupBy(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("key")).agg(F.sum("c").alias("f"))
        sums = sums.select(F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "f")
    else:
        sums = groups.groupBy(*by).agg(F.sum("c").alias("f"))
    rows = stored(sums.where(F.col("f") >= least).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    # one row per partition
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = sizes.select("part", "first", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "part").select((F.col("before") + F.col("at") - F.col("first")).alias("id"), *by, "f")


def extend(relation: DataFrame, groups: DataFrame, by: list[str], found: DataFrame, n: int, one_key: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """Stored R(k + 1) of R(k) and its groups, of which ``n`` are frequent, and its groups (block, local, a, b, c)."""
    if n <= BROADCAST_GROUPS and (one_key or by == ["lang", "word"]):
        few = found.select("id", *by).toArrow()
        if by == ["lang", "word"]:
            run, columns = _meet_words(found.sparkSession.sparkContext.broadcast(few)), ["block", "sequence", "langs", "owner", "words"]
        else:
            keys = few["a"].to_numpy() << 32 | few["b"].to_numpy()
            order = np.argsort(keys)
            run = _meet_pairs(found.sparkSession.sparkContext.broadcast((keys[order], few["id"].to_numpy()[order])))
            columns = ["block", "sequence", "a", "b", "ids"]
        made = stored(relation.select(*columns).mapInArrow(run, NEXT), name)
    else:
        semi = groups.join(found.select("id", *by), by).select(F.col("block").alias("held"), F.col("local").cast("long").alias("local"), "id")
        made = stored(relation.select("block", "sequence").groupBy("block").cogroup(semi.groupBy("held")).applyInArrow(_meet, NEXT), name)
    return made, made.select("block", "a", "b", "counts", "ids").mapInArrow(_groups, "block long, local int, a long, b long, c long")


def named(found: DataFrame, shorter: DataFrame, name: str) -> DataFrame:
    """Stored (id, lang, phrase, tail, pre, suf, f): ``pre`` and ``suf`` are the
    counts of the phrase's first and last 1, 2 .. words; from the phrases one word shorter."""
    first = shorter.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"), F.col("pre").alias("pre_a"))
    last = shorter.select(F.col("id").alias("b"), "tail", F.col("suf").alias("suf_b"))
    return stored(found.join(_small(first), "a").join(_small(last), "b")
                       .select("id", "a", "b", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "tail",
                               F.concat("pre_a", F.array("f")).alias("pre"), F.concat("suf_b", F.array("f")).alias("suf"), "f"), name)


#: best cut of a phrase: the lowest score, then the shortest first part; decimals are exact beyond 64 bits
CUT = """array_min(transform(sequence(1, size(pre) - 1), k -> struct(
    (CAST(f AS DECIMAL(19, 0)) * 2000000) div (CAST(pre[k - 1] AS DECIMAL(20, 0)) + suf[size(pre) - k - 1]) AS score,
    k, pre[k - 1] AS l, suf[size(pre) - k - 1] AS r)))"""


def undominated(found: DataFrame, longer: DataFrame | None, percent: int = 80) -> DataFrame:
    """Phrases without a longer one around them that has ``percent`` of their count.

    Looking one word further is enough: a phrase between two others occurs at least as often as the outer one."""
    if longer is None:
        return found
    around = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("around"))
    kept = found.join(around, "id", "left").where(F.coalesce(100 * F.col("around") < percent * F.col("f"), F.lit(True)))
    return kept.drop("around")


def mine(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language the best phrases: lang, rank, phrase, a, l, r, n, score."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    words = stored(rows.mapInArrow(_lay, FIRST).withColumn("block", F.monotonically_increasing_id()), "setm-1")
    zipped = words.select("block", "langs", F.posexplode(F.arrays_zip("owner", "words", "counts")).alias("local", "g"))
    groups = zipped.select("block", "local", F.get("langs", F.col("g.owner")).alias("lang"), F.col("g.words").cast("string").alias("word"), F.col("g.counts").alias("c"))
    relation, by = words, ["lang", "word"]
    found = frequent(groups, by, least, "setm-frequent-1")
    names = [found.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("tail"), F.array("f").alias("pre"), F.array("f").alias("suf"), "f")]
    one_key = False
    for k in range(2, longest + 1):
        n = found.count()
        relation, groups = extend(relation, groups, by, found, n, one_key, f"setm-{k}")
        by, one_key = ["a", "b"], n < ONE_KEY
        found = frequent(groups, by, least, f"setm-frequent-{k}", one_key)
        names.append(named(found, names[-1], f"setm-phrases-{k}"))
    kept = [undominated(own, longer) for own, longer in zip(names[1:], [*names[2:], None], strict=True)]
    scored = [own.select("lang", "phrase", F.col("f").alias("a"), F.expr(CUT).alias("cut")) for own in kept]
    scored = stored(reduce(DataFrame.unionByName, scored).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "setm-scored")
    # the best of each slice of a language, then the best of those
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = SLICES + scored.count() // SLICE_ROWS
    scored = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*best))).where(F.col("rank") <= top)
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    totals = words.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n"))
    return scored.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
