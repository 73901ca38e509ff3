"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts.  A symbol is predicted from the longest
kept context of at most ``ORDER`` bytes; if that context has not seen it, an
escape (one count for each distinct successor, besides the counts of pruned ones)
leads to the next shorter context, in which the symbols of the longer one are
excluded, and at last to a uniform choice among symbols never seen.

Contexts run over white space back to a separator before the text; white space
counts as one separator symbol whose kind is coded apart.

Nothing in the model is bounded but by the corpus: a context or successor is
kept from ``LEAST_COUNT`` occurrences on, and the rest of the mass becomes
escape.  Grams are integers; their counts and code lengths are Spark tables,
made order by order with joins on whole grams.  Grams with at least
``TRIE_SHARE`` of the training symbols (at most ``1 / TRIE_SHARE``) are
broadcast for scoring, all others of a text are joined with the table of codes.
Counts for the unigram base are exact in the same way: words with at least
``HEAD_SHARE`` of the training tokens are broadcast, all other words joined.

Defined cases: null text is empty (one end token); with no training rows all
counts are 0 and every symbol is uniform; repeated rows are scored and learned
each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

ORDER = 5
#: contexts and successors are kept from this count on, at any corpus size
LEAST_COUNT = 2
#: share of the training symbols from which a gram (16 bytes), and of the training tokens from which a word, is broadcast
TRIE_SHARE = 4e-7
HEAD_SHARE = 1e-6
MOST_WORDS = 300_000
MOST_GRAMS = 2_000_000
CHUNK_BYTES = 1_000_000
SPACES = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
#: 250 bytes that are not white space, the separator and the end
SYMBOLS = 252
SEPARATOR, END = b" ", b"\n"
#: lower case, every white space a separator
PLAIN = bytes(SEPARATOR[0] if bytes([b]) in SPACES else bytes([b]).lower()[0] for b in range(256))


def _segments(text: bytes | None) -> tuple[list[bytes], list[int], bytes]:
    """Lower-cased words, counts of the kinds of white space, the last segment (empty after white space)."""
    text = (text or b"").lower()
    words = text.split()
    return words, [text.count(s) for s in SPACES], b"" if not words or text[-1:] in SPACES else words[-1]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    last: Counter = Counter()
    spaces = [0] * len(SPACES)
    docs = 0

    def out() -> pa.RecordBatch:
        keys = [*words]
        return pa.RecordBatch.from_arrays(
            [pa.array([0] * len(keys) + [1] * len(SPACES) + [2], pa.int32()), pa.array([*keys, *SPACES, b""], pa.binary()),
             pa.array([*(words[k] for k in keys), *spaces, docs], pa.int64()), pa.array([*(last[k] for k in keys), *[0] * (len(SPACES) + 1)], pa.int64())],
            names=["kind", "word", "n", "n_last"])

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            found, kinds, end = _segments(text.as_py())
            words.update(found)
            if empty := sum(kinds) + 1 - len(found):
                words[b""] += empty
            last[end] += 1
            spaces = [a + b for a, b in zip(spaces, kinds, strict=True)]
            docs += 1
        if len(words) > MOST_WORDS:
            yield out()
            words.clear()
            last.clear()
            spaces, docs = [0] * len(SPACES), 0
    yield out()


def word_table(texts: DataFrame) -> DataFrame:
    """(kind, word, n, n_last) over the training texts: words (kind 0), white space (1), documents (2)."""
    made = texts.mapInArrow(_count_words, "kind int, word binary, n long, n_last long")
    return stored(made.groupBy("kind", "word").agg(F.sum("n").alias("n"), F.sum("n_last").alias("n_last")), "ppm-words")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g[:-1] for g in grams], pa.binary()), pa.array([g[-1] for g in grams], pa.int32()),
                                           pa.array(grams.values(), pa.int64())], names=["context", "symbol", "n"])

    for batch in batches:
        for word, n, n_last in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            s = SEPARATOR + word
            for end, m in ((SEPARATOR, n - n_last), (END, n_last)):
                if m:
                    for k in range(min(ORDER, len(s)) + 1):
                        grams[s[len(s) - k:] + end] += m
            for i in range(1, len(s)):
                for k in range(min(ORDER, i) + 1):
                    grams[s[i - k:i + 1]] += n
        if len(grams) > 2 * MOST_WORDS:
            yield out()
            grams.clear()
    yield out()


class Trie:
    """Kept contexts with their escape masses; ``rows``: (context, total, distinct, symbols, counts)."""

    def __init__(self, rows):
        self.count: dict[bytes, float] = {}
        self.node: dict[bytes, tuple[float, float, float]] = {}
        seen = {bytes(r[0]): (r[1], r[2], dict(zip(r[3], r[4], strict=True))) for r in rows}
        for context, (total, distinct, after) in seen.items():
            escape = total - sum(after.values()) + distinct
            if context:
                shorter = seen[context[1:]]
                left = sum(n for s, n in shorter[2].items() if s not in after) + shorter[0] - sum(shorter[2].values()) + shorter[1]
            else:
                left = SYMBOLS - len(after)
            self.node[context] = (math.log10(total + distinct), math.log10(escape), math.log10(max(left, 1)))
            self.count.update((context + bytes([s]), math.log10(n)) for s, n in after.items())

    def symbol(self, before: bytes, symbol: bytes) -> float:
        context = before[-ORDER:]
        while context and context not in self.node:
            context = context[1:]
        if context not in self.node:
            return -math.log10(SYMBOLS)
        total, escape, left = self.node[context]
        got = 0.0
        while (n := self.count.get(context + symbol)) is None:
            got += escape - total
            total = left
            if not context:
                return got - total
            context = context[1:]
            _, escape, left = self.node[context]
        return got + n - total


def train_trie(words: DataFrame) -> Trie:
    """The model of single words (contexts start before the word) in memory, for small word tables; the tests hold its rule of prediction against the definition."""
    own = words.where("kind = 0").select("word", "n", "n_last")
    grams = own.mapInArrow(_count_grams, "context binary, symbol int, n long")
    grams = stored(grams.groupBy("context", "symbol").agg(F.sum("n").alias("n")), "ppm-word-grams")
    least = LEAST_COUNT
    kept = F.when(F.col("n") >= least, F.struct("symbol", "n"))
    rows = (grams.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.collect_list(kept).alias("after"))
                 .where((F.col("total") >= least) | (F.length("context") == 0))
                 .select("context", "total", "distinct", "after.symbol", "after.n").collect())
    return Trie(rows)


def space_codes(words: DataFrame) -> list[float]:
    """Code lengths of the kinds of white space."""
    spaces = {bytes(r["word"]): r["n"] for r in words.where("kind = 1").collect()}
    total = sum(spaces.values()) + len(SPACES)
    return [math.log10((spaces.get(s, 0) + 1) / total) for s in SPACES]


class _Head(dict):
    """Base score of frequent words; others are noted in ``rest`` and add 0."""

    def __missing__(self, word: bytes) -> float:
        self.rest[word] += 1
        return 0.0


def _windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Gram (longest context and symbol) of every symbol of the texts, end included, and the text it belongs to, block by block.

    A gram is one integer: length of the context, context, symbol."""
    starts = np.cumsum([0] + [len(t) + 2 for t in texts])
    plain = np.frombuffer(b"".join(SEPARATOR + t.translate(PLAIN) + END for t in texts), np.uint8)
    for low in range(0, len(plain), CHUNK_BYTES):
        before = min(ORDER, low)
        a = plain[low - before:low + CHUNK_BYTES].astype(np.int64)
        place = np.arange(low - before, low - before + len(a))
        owner = np.searchsorted(starts, place, "right") - 1
        length = np.minimum(place - starts[owner], ORDER)
        gram = a | length << 8 * (ORDER + 1)
        for k in range(1, ORDER + 1):
            gram[k:] |= np.where(length[k:] >= k, a[:-k] << 8 * k, 0)
        owner, coded = owner[before:], length[before:] > 0
        yield gram[before:][coded], owner[coded]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts (null: empty) some at a time, with the number of the first."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts.cast(pa.binary())):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

    def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])

    for batch in batches:
        held_out = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for first, texts in _chunks(batch.column(0)):
            for learned in (True, False):
                own = [t for i, t in enumerate(texts, first) if held_out[i] != learned]
                for found, _ in _windows(own):
                    keys, counts = np.unique(found, return_counts=True)
                    held.append((keys, counts if learned else 0 * counts))
            if sum(len(k) for k, _ in held) > MOST_GRAMS:
                held[:] = [merged()]
                if len(held[0][0]) > MOST_GRAMS // 2:
                    yield out(*held.pop())
    if held:
        yield out(*merged())


def _cut(gram: str, k: str) -> str:
    """SQL of the gram with only the last k bytes of its context."""
    return f"(shiftleft(cast({k} as long), {8 * (ORDER + 1)}) | ({gram} & (shiftleft(1L, 8 * ({k} + 1)) - 1)))"


def gram_table(rows: DataFrame) -> DataFrame:
    """(gram, n): the grams of (text, held_out) with the longest context, n times in rows that are learned from."""
    made = rows.select("text", "held_out").mapInArrow(_count_windows, "gram long, n long")
    return stored(made.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")


def gram_codes(grams: DataFrame) -> DataFrame:
    """(gram, n, code) of all grams of the table: log10 probability of the symbol after the context.

    All shorter contexts of the grams are counted too.  Order by order, a gram
    takes its own count if it is kept, and else the escape of its context and
    what the next shorter gram has; a gram meets the at most 256 grams that
    are longer by a byte, so no key is large."""
    size = 8 * (ORDER + 1)
    every = grams.selectExpr("gram", "n", f"explode(sequence(0, cast(shiftright(gram, {size}) as int))) as k")
    every = every.selectExpr(f"{_cut('gram', 'k')} as gram", "k", "n").groupBy("k", "gram").agg(F.sum("n").alias("n"))
    kept = f"n >= {LEAST_COUNT}"
    # a context is named by its grams without their symbol
    every = every.selectExpr("k", "gram", "n", "shiftright(gram, 8) as context")
    after = Window.partitionBy("context")
    every = every.withColumns({"total": F.sum("n").over(after), "distinct": F.sum(F.expr("cast(n > 0 as long)")).over(after),
                               "seen": F.sum(F.expr(f"if({kept}, n, 0L)")).over(after), "many": F.sum(F.expr(f"cast({kept} as long)")).over(after)})
    every = stored(every, "ppm-orders")
    shorter = every.selectExpr("k + 1 as k", "gram as suffix", "n as n_shorter", "total + distinct as all_shorter")
    every = every.withColumn("suffix", F.expr(f"if(k > 0, {_cut('gram', 'greatest(k - 1, 0)')}, null)")).join(shorter, ["k", "suffix"], "left")
    left = F.expr(f"any_value(all_shorter) over (partition by context) - sum(if({kept}, n_shorter, 0L)) over (partition by context)")
    every = every.withColumn("left", F.when(F.col("k") == 0, SYMBOLS - F.col("many")).otherwise(left))
    node = F.col("total") >= F.when(F.col("k") == 0, 1).otherwise(LEAST_COUNT)
    every = every.select("k", "gram", "suffix", "n", F.when(F.expr(kept), F.log10("n")).alias("own"),
                         F.when(node, F.log10(F.col("total") - F.col("seen") + F.col("distinct")) - F.log10(F.greatest("left", F.lit(1)))).alias("escape"),
                         F.when(node, F.log10(F.col("total") + F.col("distinct"))).alias("all"))
    every = stored(every, "ppm-nodes")
    done = None
    for k in range(ORDER + 1):
        level = every.where(f"k = {k}")
        if done is None:  # without anything learned all symbols are alike
            level = level.withColumns({"mass_shorter": F.lit(0.0), "code_shorter": F.lit(-math.log10(SYMBOLS))})
        else:
            level = level.join(done.selectExpr("gram as suffix", "mass as mass_shorter", "code as code_shorter"), "suffix")
        level = level.withColumn("mass", F.coalesce("own", F.coalesce("escape", F.lit(0.0)) + F.col("mass_shorter")))
        done = stored(level.select("gram", "mass", F.coalesce(F.col("mass") - F.col("all"), "code_shorter").alias("code")), "ppm-codes")
        found = done.select("gram", "code") if k == 0 else found.unionByName(done.select("gram", "code"))
    return stored(grams.join(found, "gram"), "ppm-codes")


_MODELS: dict = {}


def _score(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MODELS:
            _MODELS.clear()
            grams, codes, spaces, head = shared.value
            _MODELS[name] = grams, codes, spaces, _Head(head)
        grams, codes, spaces, head = _MODELS[name]
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, texts in _chunks(batch.column(1)):
                scores, others = np.zeros(len(texts)), []
                for made, owner in _windows(texts):
                    found, at = np.unique(made, return_inverse=True)
                    place = np.searchsorted(grams, found)
                    known = grams[place] == found
                    scores += np.bincount(owner, np.where(known, codes[place], 0.0)[at], len(texts))
                    # grams that are not broadcast, by text
                    other = ~known[at]
                    pairs, times = np.unique(owner[other] * len(found) + at[other], return_counts=True)
                    others.append((pairs // len(found), found[pairs % len(found)], times))
                owner, other, times = (np.concatenate(x) for x in zip(*others, strict=True))
                ends = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32))
                bases, tokens, rest, rest_n = [], [], [], []
                for i, text in enumerate(texts):
                    words, kinds, _ = _segments(text)
                    scores[i] += sum(n * x for n, x in zip(kinds, spaces, strict=True))
                    head.rest = Counter()
                    bases.append(sum(map(head.__getitem__, words)))
                    tokens.append(len(words) + 1)
                    rest.append([*head.rest])
                    rest_n.append([*head.rest.values()])
                n = len(texts)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (other, times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + n), pa.int64()), batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(tokens, pa.int64()),
                     pa.array(bases, pa.float64()), pa.array(scores, pa.float64()), pa.array(rest, pa.list_(pa.binary())), pa.array(rest_n, pa.list_(pa.int64())), *lists],
                    names=["row", "key", "held_out", "n_tokens", "base", "known_score", "rest", "rest_n", "grams", "grams_n"])
                row += n
    return run


def score(docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose ``held_out`` is false are learned from; all are scored."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = word_table(rows.where("not held_out").select("text"))
    grams = gram_codes(gram_table(rows))
    symbols = grams.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") >= max(1.0, TRIE_SHARE * symbols)
    top = grams.where(common).select("gram", "code").toArrow()
    top = top.take(pa.compute.sort_indices(top["gram"]))
    vocabulary = words.where("kind = 0 and length(word) > 0").select("word", "n")
    n_docs = words.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    of = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total = (of["n"] or 0) + n_docs
    floor = total + 0.5 * (of["v"] + (n_docs > 0) + 1)
    frequent = F.col("n") >= max(1.0, HEAD_SHARE * total)
    head = {bytes(r["word"]): math.log10((r["n"] + 0.5) / floor) for r in vocabulary.where(frequent).toLocalIterator()}
    end = math.log10((n_docs + 0.5) / floor)
    # a last entry that is no gram, for what sorts behind all
    top = np.r_[top["gram"].to_numpy(), np.iinfo(np.int64).max], np.r_[top["code"].to_numpy(), 0.0]
    shared = spark.sparkContext.broadcast((*top, space_codes(words), head))
    kind = dict(rows.dtypes)["key"]
    made = stored(rows.select("key", "text", "held_out").mapInArrow(
        _score(shared, uuid.uuid4().hex), f"row long, key {kind}, held_out boolean, n_tokens long, base double, known_score double, rest array<binary>, rest_n array<long>, "
        "grams array<long>, grams_n array<int>"), "ppm-scores")
    rest = made.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.rest_n").alias("times"))
    rare = vocabulary.where(~frequent).withColumnRenamed("n", "c")
    rest = rest.join(rare, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rest = rest.groupBy("row").agg(F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / floor)).alias("rest_base"),
                                   F.sum(F.when(F.col("c") == 0, F.col("times")).otherwise(0)).alias("unknown"))
    others = made.select("row", F.explode(F.arrays_zip("grams", "grams_n")).alias("x")).select("row", F.col("x.grams").alias("gram"), F.col("x.grams_n").alias("times"))
    others = others.join(grams.where(~common).select("gram", "code"), "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("code")).alias("other_score"))
    known = F.col("n_tokens") - F.coalesce("unknown", F.lit(0)) - (0 if n_docs else 1)
    return made.drop("rest", "rest_n", "grams", "grams_n").join(rest, "row", "left").join(others, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0)) + end).alias("base_score"), (F.col("known_score") + F.coalesce("other_score", F.lit(0.0))).alias("score"))
