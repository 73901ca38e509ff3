"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Tokenising runs in Arrow batches.  Words separated by ASCII white space are
independent for the tokenizer, so each worker keeps the ids of words it has
seen, up to a bound.

Packing is bulk-synchronous.  Pieces are range-sorted: a piece is known by its
length and its rank among the pieces of that length, numbered without bringing
a length into one task.  Gaps are sorted the same way.  Each round sweeps both
in order of size; every gap is given its successor match, the longest piece
that still fits, and pieces that compete for gaps of a size are resolved by
rank.  Then gaps shrink and the next round begins; when nothing fits any more,
the longest pieces left open new sequences.  The sweep works on runs (length,
ranks from .. to), of which there are at most a few for each of the
``capacity`` lengths whatever the number of documents; rows meet their run in
one broadcast join.

Defined cases: null text is empty and has the end token alone; a repeated row
is packed again; an empty table gives an empty result; documents longer than the capacity are cut into full
pieces and a rest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import give_back, numbered, stored

MOST_WORDS, LASTING = 400_000, 200_000
#: a run of letters that lower-casing and composition leave a run of letters, then ASCII punctuation without apostrophe:
#: two units for the tokenizer, whatever stands around them
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([!-&(-/:-@\\[-`{-~]*)\\Z")


def byte_letters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if it is visible, else the next free one above 255."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class WordIds(dict):
    """Little-endian ids of words (bytes without ASCII white space), found when
    first met.  The first ``LASTING`` words stay; when there are ``MOST_WORDS``
    the others go."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.letters = Tokenizer.from_file(path), byte_letters()
        self.lasting: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {}

    def unit(self, unit: str) -> bytes:
        if (ids := self.units.get(unit)) is None:
            if len(self.units) >= MOST_WORDS:
                self.units.clear()
            written = "".join([self.letters[b] for b in unit.encode()])
            ids = self.units[unit] = np.array([t.id for t in self.tokenizer.model.tokenize(written)], "<u4").tobytes()
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
            self.update(self.lasting)
        text = word.decode()
        if plain := PLAIN.match(text):
            ids = self.unit(plain[1].lower()) + (self.unit(plain[2]) if plain[2] else b"")
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        if len(self.lasting) < LASTING:
            self.lasting[word] = ids
        return ids


_WORDS: dict[str, WordIds] = {}


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the worker may hold what an earlier stage has freed
        give_back()
        known = _WORDS.get(path) or _WORDS.setdefault(path, WordIds(path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                whole = b"".join(map(known.__getitem__, (text.as_py() or b"").split())) + end
                for k, first in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[first:first + 4 * capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(first // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                              pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["key", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids, then the end id, cut at the capacity."""
    own = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string")).mapInArrow(
        _pieces(tokenizer, end_id, capacity), f"key {own}, piece int, start long, length long, ids_crc32 long")


def _sweep(items: dict[int, int], ranks: dict[int, int], gaps: dict[int, list], capacity: int, plan: list) -> dict[int, list]:
    """One round: sizes ascend; a gap takes the longest piece below it that no smaller gap took."""
    waiting: list[list[int]] = []
    after: dict[int, list] = {}
    for size in range(1, capacity):
        if items.get(size):
            waiting.append([size, items[size]])
        for first, n in gaps.get(size, ()):
            while n and waiting:
                length, there = waiting[-1]
                m = min(n, there)
                plan.append((length, ranks[length], m, first, capacity - size))
                ranks[length] += m
                items[length] -= m
                if size > length:
                    after.setdefault(size - length, []).append((first, m))
                first, n = first + m, n - m
                if m == there:
                    waiting.pop()
                else:
                    waiting[-1][1] = there - m
            if n:
                after.setdefault(size, []).append((first, n))
    return after


def best_fit_rounds(lengths: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Runs (length, first rank, n, first sequence, offset) that place every
    piece, and the number of sequences; ``lengths``: pieces by length."""
    items = {k: v for k, v in lengths.items() if v}
    ranks = dict.fromkeys(items, 0)
    plan: list[tuple] = []
    gaps: dict[int, list] = {}
    sequences = 0

    def open_with(length: int, n: int) -> None:
        nonlocal sequences
        plan.append((length, ranks[length], n, sequences, 0))
        ranks[length] += n
        items[length] -= n
        if length < capacity:
            gaps.setdefault(capacity - length, []).append((sequences, n))
        sequences += n

    for length in sorted(items, reverse=True):
        if 2 * length > capacity:
            open_with(length, items[length])
    while left := sum(items.values()):
        gaps = _sweep(items, ranks, gaps, capacity, plan)
        if sum(items.values()) < left:
            continue
        # nothing fits: as many new sequences as the rest needs at least, from its longest pieces
        wanted = -(-sum(k * v for k, v in items.items()) // capacity)
        for length in sorted((k for k, v in items.items() if v), reverse=True):
            if wanted <= 0:
                break
            n = min(wanted, items[length])
            open_with(length, n)
            wanted -= n
    return plan, sequences


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    made = stored(pieces(docs, tokenizer, capacity, end_id, text, key), "pack-pieces")
    lengths = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = best_fit_rounds(lengths, capacity)
    runs = spark.createDataFrame(plan, "run_length long, first_rank long, n long, first_sequence long, offset long")
    runs = F.broadcast(stored(runs.coalesce(1), "pack-plan"))
    ranked = numbered(made, ["length"], [F.col("key"), F.col("piece"), F.col("ids_crc32")], "rank")
    here = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    return ranked.join(runs, here).select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
                                          (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
