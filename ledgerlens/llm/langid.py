"""Language identification with segmentation-marginalised unigrams.

For each language there is a probability for every piece of a fixed public
vocabulary.  A word's likelihood is the sum, over all its segmentations into
pieces, of the products of their probabilities (forward algorithm); a text's
log likelihood is the sum over its words.  Probabilities come from
expectation-maximisation: a backward pass gives the expected number of uses of
each piece over all segmentations, weighted by word counts.

Training reads labelled rows up to about ``ROWS_PER_LANGUAGE`` for each
language, chosen by a hash of the id; every text is predicted whole.  The
model has (pieces + 1) x languages numbers; at most ``MOST_LANGUAGES`` labels
are accepted (more raise an error), so it is bounded and broadcast.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
so is everything when no row is labelled; ties go to the language first in
order; runs of more than 32 letters count as several words; repeated rows are
predicted each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import give_back, stored, unit_hash

ROWS_PER_LANGUAGE = 1500
MOST_LANGUAGES = 1000
ROUNDS = 3
LEAST = 1e-9
LONGEST = 32
MOST_WORDS = 300_000
#: rows whose words are held as objects at one time
ROWS_AT_ONCE = 256
#: words that count as evidence in the score, however long the text
EVIDENCE = 20
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNKNOWN = "und"


def split_words(text: str | None) -> list[str]:
    found = LETTERS.findall((text or "").lower())
    if max(map(len, found), default=0) > LONGEST:
        found = [w[i:i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


class Pieces:
    """The vocabulary's pieces made of a word start and letters; one further id stands for any other character."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.size, self.unknown = len(names) + 1, len(names)
        self.lengths = np.array([len(x) for x in names] + [1])
        self.tree = ahocorasick.Automaton()
        for i, x in enumerate(names):
            self.tree.add_word(x, i)
        self.tree.make_automaton()

    def lattice(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, start, end, piece) of all edges, by end, then word; words get a start mark."""
        marked = ["▁" + w for w in words]
        sizes = np.array([len(w) for w in marked])
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        whole = "\n".join(marked)
        found = np.array(list(self.tree.iter(whole)), np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        # a character that is no piece by itself gets the unknown edge
        plain = np.ones(len(whole) + 1, bool)
        plain[offsets[1:]] = False
        plain[0] = False
        plain[end[self.lengths[piece] == 1]] = False
        other = np.nonzero(plain)[0]
        end = np.concatenate([end, other])
        piece = np.concatenate([piece, np.full(len(other), self.unknown)])
        word = np.searchsorted(offsets, end - 1, side="right") - 1
        end = end - offsets[word]
        order = np.lexsort((word, end))
        word, end, piece = word[order], end[order], piece[order]
        return word, end - self.lengths[piece], end, piece, sizes


def _sums(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values, for rows in ascending order."""
    if len(rows):
        first = np.nonzero(np.diff(rows, prepend=-1))[0]
        into[rows[first]] += np.add.reduceat(values, first, axis=0)


def forward(lattice, chance: np.ndarray) -> np.ndarray:
    """(word, position, language): probability of the word up to the position."""
    word, start, end, piece, sizes = lattice
    alpha = np.zeros((len(sizes), sizes.max() + 1, chance.shape[1]))
    alpha[:, 0] = 1
    cuts = np.searchsorted(end, np.arange(sizes.max() + 2))
    for j in range(1, sizes.max() + 1):
        e = slice(cuts[j], cuts[j + 1])
        _sums(alpha[:, j], word[e], alpha[word[e], start[e]] * chance[piece[e]])
    return alpha


def expected_uses(lattice, chance: np.ndarray, times: np.ndarray) -> np.ndarray:
    """(piece, language): expected uses of the pieces over all segmentations, words weighted by ``times``."""
    word, start, end, piece, sizes = lattice
    alpha = forward(lattice, chance)
    beta = np.zeros_like(alpha)
    each = np.arange(len(sizes))
    beta[each, sizes] = times / np.maximum(alpha[each, sizes], 1e-300)
    uses = np.zeros_like(chance)
    cuts = np.searchsorted(end, np.arange(sizes.max() + 2))
    for j in range(sizes.max(), 0, -1):
        e = slice(cuts[j], cuts[j + 1])
        back = beta[word[e], j] * chance[piece[e]]
        np.add.at(uses, piece[e], back * alpha[word[e], start[e]])
        np.add.at(beta, (word[e], start[e]), back)
    return uses


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for label, text in zip(batch.column(0), batch.column(1), strict=True):
            own = label.as_py()
            counts.update((own, w) for w in split_words(text.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                                          pa.array(counts.values(), pa.int64())], names=["label", "word", "n"])


def _expect(path: str, shared, languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, chance = pieces_of(path), shared.value
        uses = np.zeros_like(chance)
        for batch in batches:
            words = {}
            at = [words.setdefault(w, len(words)) for w in batch.column(1).to_pylist()]
            if not words:
                continue
            times = np.zeros((len(words), len(languages)))
            columns = {x: i for i, x in enumerate(languages)}
            np.add.at(times, (at, [columns[x] for x in batch.column(0).to_pylist()]), batch.column(2).to_numpy(zero_copy_only=False))
            uses += expected_uses(pieces.lattice([*words]), chance, times)
        piece, language = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(language, pa.int32()), pa.array(uses[piece, language])], names=["piece", "language", "uses"])
    return run


def train(labelled: DataFrame, path: str, rows_per_language: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray | None]:
    """(languages, piece probabilities) from (key, text, label)."""
    spark = labelled.sparkSession
    labelled = labelled.where("text is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} language labels")
    if not sizes:
        return [], None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_language / n))])
    sample = labelled.where(unit_hash(F.col("key")) < F.element_at(share, F.col("label")) * float(1 << 40))
    counts = sample.select("label", "text").mapInArrow(_count, "label string, word string, n long")
    counts = stored(counts.groupBy("label", "word").agg(F.sum("n").cast("long").alias("n")), "langid-words")
    pieces = pieces_of(path)
    chance = np.full((pieces.size, len(languages)), 1.0 / pieces.size)
    chance[pieces.unknown] = 1e-7
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(chance)
        made = counts.mapInArrow(_expect(path, shared, languages), "piece int, language int, uses double")
        uses = np.full_like(chance, 0.01)
        for r in made.groupBy("piece", "language").agg(F.sum("uses").alias("uses")).collect():
            uses[r["piece"], r["language"]] += r["uses"]
        chance = np.maximum(uses / uses.sum(axis=0), LEAST)
        shared.unpersist()
    return languages, chance


_MODELS: dict = {}


def _predict(path: str, shared, name: str, languages: list[str], text_field: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = {}, []
        known, likely = _MODELS[name]
        pieces, chance = pieces_of(path), shared.value
        yield from predicted(batches, known, likely, pieces, chance)
        known.clear()
        likely.clear()
        give_back()

    def predicted(batches, known, likely, pieces, chance) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            found, scores = [], []
            texts = [split_words(t.as_py()) for t in (batch.column(0).field(text_field) if text_field else batch.column(1))]
            new = list({w for words in texts for w in words if w not in known})
            if len(known) + len(new) > MOST_WORDS:
                known.clear()
                likely.clear()
                new = list({w for words in texts for w in words})
            new.sort(key=len)
            rows = []
            for i in range(0, len(new), 4096):
                lattice = pieces.lattice(new[i:i + 4096])
                sizes = lattice[-1]
                rows.append(np.log(np.maximum(forward(lattice, chance)[np.arange(len(sizes)), sizes], 1e-300)))
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            likely[:] = [np.concatenate([*likely, *rows])] if rows else likely
            for words in texts:
                if not words:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = likely[0][[known[w] for w in words]].sum(axis=0)
                best = int(total.argmax())
                gap = (total - total[best]) * min(1.0, EVIDENCE / len(words))
                found.append(languages[best])
                scores.append(float(1 / np.exp(gap).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])
    return run


def predictor(spark, path: str, languages: list[str], chance):
    """Function from (row, text) DataFrames to (row, lang_pred, score); ``row``
    may be a struct of any columns, and with ``text_field`` one of these is
    the text, which then travels once."""
    def apply(rows: DataFrame, text_field: str | None = None) -> DataFrame:
        if not languages:
            return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        kind = rows.schema["row"].dataType.simpleString()
        shared = spark.sparkContext.broadcast(chance)
        rows = rows.select("row") if text_field else rows.select("row", "text")
        return rows.mapInArrow(_predict(path, shared, uuid.uuid4().hex, languages, text_field), f"row {kind}, lang_pred string, score double")
    return apply


def fit(docs: DataFrame, held_out: Column, path: str, text: str = "text", label: str = "lang", key: str = "doc_id"):
    """Train on the labelled rows whose ``held_out`` is false; returns a predictor."""
    own = docs.where(~F.coalesce(held_out, F.lit(False))).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    languages, chance = train(own, path)
    return predictor(docs.sparkSession, path, languages, chance)


def identify(docs: DataFrame, held_out: Column, path: str, text: str = "text", label: str = "lang", key: str = "doc_id") -> DataFrame:
    """Per row: key, held_out, lang_pred, score."""
    apply = fit(docs, held_out, path, text, label, key)
    rows = docs.select(F.struct(F.col(key).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out")).alias("row"), F.col(text).cast("string").alias("text"))
    return apply(rows).select(F.col("row.key").alias(key), "row.held_out", "lang_pred", "score")
