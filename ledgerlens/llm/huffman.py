"""Token ids on disk as canonical, length-limited Huffman codes.

Writing: documents are tokenised in Arrow batches (pieces of at most
``PIECE_IDS`` ids), ids are counted over the whole corpus, code lengths of at
most ``LIMIT`` bits follow from the counts by package-merge, and the pieces
are range-sorted by document and streamed into files of blocks.  A stored
dataset has three tables:

``code``    (id, bits): the lengths; the code is canonical, so they say all.
            One row for each id in use, bounded by the vocabulary.
``blocks``  one Parquet file per range of documents, rows in order:
            file, block (its number in the file), first (ids of the file
            before it), n (ids), docs, ats, places (documents that have ids
            here, ids of them before this block, place of their first id
            here), continues (the last document goes on in the next block),
            marks (bit offset of every ``STRIDE``-th id, little-endian
            unsigned 32-bit), bits (codes, highest bit first).
``files``   (file, n, before): ids of each file, and of all files before it.

Reading: blocks are independent.  Within them every mark starts a lane; all
lanes of an Arrow batch advance together, one table look-up (the next ``LIMIT``
bits give id and length) a step.  A document that spans blocks is put together
from its segments, its checksum from theirs.  Any span of ids can be read
alone, from the mark before it (``window``).

Memory: a task holds one block while writing and ``BATCH_BLOCKS`` while
reading; the driver sees one count per id of the vocabulary.

Defined cases: null text is empty and has the end id alone; null ids come
first; rows with the same id are ordered by number of ids, checksum and place
in the input, so rows that differ have the same places in every run; an empty
table gives empty tables; very long documents span blocks and files; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import packing
from ledgerlens.llm.common import stored
from ledgerlens.llm.words import distinct, ended
from ledgerlens.session import scratch_path

LIMIT = 20
BLOCK_IDS, STRIDE = 1 << 16, 256
PIECE_IDS = 1 << 13
#: ids of a file, on average: about 20 MB of codes
FILE_IDS = 1 << 24
CHUNK_BYTES = 8 << 20
BATCH_BLOCKS = 32
#: more files than this are joined, not broadcast
BROADCAST_FILES = 100_000
BLANK = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


# ---- tokenising

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Rows of about ``CHUNK_BYTES`` of text: keys and texts."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        first, size, held = 0, 0, []
        for i, text in enumerate(texts):
            held.append(text.as_py() or b"")
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                yield batch.column(0).slice(first, len(held)), held
                first, size, held = i + 1, 0, []
        if held:
            yield batch.column(0).slice(first, len(held)), held


#: classes of bytes: space, ASCII letters, ASCII punctuation but the apostrophe, all others
CLASS = np.full(256, 3, np.uint8)
CLASS[32] = 0
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = 2
#: bytes of a unit that its hash tells apart by place
PLACES = 64
MOST_UNITS = 1_500_000


def units(raw: np.ndarray) -> np.ndarray:
    """Tokens of ``ended`` bytes cut where the tokenizer cuts them whatever
    stands around: a run of letters (lower-cased) from the punctuation after it.
    Tokens that hold anything else stay whole, as they are."""
    kind = CLASS[raw]
    start = np.r_[0, np.flatnonzero(raw == 32)[:-1] + 1]
    back = np.zeros(len(raw), bool)
    back[1:] = (kind[1:] == 1) & (kind[:-1] == 2)
    plain = (np.maximum.reduceat(kind, start) <= 2) & ~np.logical_or.reduceat(back, start)
    plain = np.repeat(plain, np.diff(np.r_[start, len(raw)]))
    lower = raw + 32 * (plain & (raw >= 65) & (raw <= 90)).astype(np.uint8)
    cut = plain[1:] & (kind[1:] == 2) & (kind[:-1] == 1)
    return np.insert(lower, np.flatnonzero(cut) + 1, 32)


class UnitIds:
    """Ids of units, found when first met and kept by 64-bit hash in sorted
    arrays: far smaller and faster than a dict of Python objects.  The hash adds
    a random number per (place, byte), so two of a million known units agree
    with probability below 1e-7; longer units than it tells apart are never kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.letters = Tokenizer.from_file(path), packing.byte_letters()
        self.random = np.random.default_rng(12).integers(0, 1 << 63, (PLACES, 256), np.uint64) * np.uint64(2) + np.uint64(1)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.first, self.n, self.flat = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def unit(self, text: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize("".join([self.letters[b] for b in text.encode()]))]

    def token(self, token: bytes) -> list[int]:
        if token.isalpha():  # ASCII letters, lower-cased: their bytes are written as themselves
            return [t.id for t in self.tokenizer.model.tokenize(token.decode())]
        text = token.decode()
        if plain := packing.PLAIN.match(text):
            return self.unit(plain[1].lower()) + (self.unit(plain[2]) if plain[2] else [])
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def find(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``flat`` the ids of each token (with its space) begin, and how many there are."""
        _, offsets, data = tokens.buffers()
        offsets = np.frombuffer(offsets, np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        raw, size = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], np.diff(offsets)
        start = offsets[:-1] - offsets[0]
        place = np.arange(len(raw)) - np.repeat(start, size)
        hashes = np.add.reduceat(self.random[place & (PLACES - 1), raw], start)
        if len(self.hashes) + len(tokens) > MOST_UNITS:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(tokens), bool)
        if len(self.hashes):
            at = np.minimum(at, len(self.hashes) - 1)
            known = (self.hashes[at] == hashes) & (size <= PLACES)
        first, n = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
        first[known], n[known] = self.first[at[known]], self.n[at[known]]
        new = np.flatnonzero(~known)
        found = [self.token(t[:-1]) for t in tokens.take(pa.array(new)).to_pylist()]
        n[new] = [len(x) for x in found]
        first[new] = len(self.flat) + np.cumsum(n[new]) - n[new]
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in found for i in x), np.uint32, int(n[new].sum()))])
        kept = new[size[new] <= PLACES]
        hashes, firsts, ns = (np.concatenate(x) for x in ((self.hashes, hashes[kept]), (self.first, first[kept]), (self.n, n[kept])))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.n = hashes[order], firsts[order], ns[order]
        return first, n


def chunk_ids(texts: list[bytes], known: UnitIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's end."""
    # no word holds a line feed any more: it stands for the end of a text
    at, tokens = distinct(units(ended(b" \n ".join([t.translate(BLANK) for t in texts]) + b" \n ")))
    first, n = known.find(tokens)
    flat, end = known.flat, tokens.index(b"\n ").as_py()
    flat, first[end], n[end] = np.r_[flat, np.uint32(end_id)], len(flat), 1
    many = n[at]
    ends = np.cumsum(many)
    return flat[np.arange(ends[-1]) + np.repeat(first[at] - (ends - many), many)], ends[at == end]


_UNITS: dict[str, UnitIds] = {}


def unit_ids(path: str) -> UnitIds:
    """The tokenizer's units, kept by a worker over its tasks."""
    if path not in _UNITS:
        _UNITS[path] = UnitIds(path)
    return _UNITS[path]


def _tokenise(path: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unit_ids(path)
        for keys, texts in _chunks(batches):
            ids, ends = chunk_ids(texts, known, end_id)
            row, n, crc, at, parts, first = [], [], [], [], [], 0
            for i, last in enumerate(ends.tolist()):
                own, check = ids[first:last], zlib.crc32(ids[first:last])
                small = own.astype(kind)
                for k in range(0, len(own), PIECE_IDS):
                    row.append(i)
                    n.append(len(own))
                    crc.append(check)
                    at.append(k)
                    parts.append(small[k:k + PIECE_IDS].tobytes())
                first = last
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array(at, pa.int64()), pa.array(parts, pa.binary())], names=["key", "n", "crc", "at", "ids"])
    return run


def id_kind(tokenizer: str) -> str:
    """The smallest unsigned type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def tokenised(docs: DataFrame, tokenizer: str, kind: str, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stored (key, n, crc, at, ids, place): pieces of each document's ids,
    the end id included; n and crc are those of the whole document."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    made = rows.mapInArrow(_tokenise(tokenizer, end_id, kind), f"key {dict(rows.dtypes)['key']}, n long, crc long, at long, ids binary")
    return stored(made.withColumn("place", F.monotonically_increasing_id()), "huffman-tokens")


# ---- the code

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of at most ``limit`` bits that minimise the coded size
    (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        bits[used] = 1
        return bits
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    row, leaf = weight, [np.ones(len(weight), bool)]
    for _ in range(limit - 1):
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        rank = np.argsort(both, kind="stable")
        row = both[rank]
        leaf.append(rank < len(weight))
    taken, length = 2 * len(weight) - 2, np.zeros(len(weight), np.int64)
    for own in reversed(leaf):
        leaves = int(own[:taken].sum())
        length[:leaves] += 1
        taken = 2 * (taken - leaves)
    bits[order] = length
    return bits


def canonical(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in code order (by length, then id), and the code of every id."""
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    span = np.int64(1) << (np.int64(63 - 1) - bits[order].astype(np.int64))
    code = np.zeros(len(bits), np.int64)
    code[order] = (np.cumsum(span) - span) >> (np.int64(63 - 1) - bits[order].astype(np.int64))
    return order, code


def decode_table(bits: np.ndarray) -> tuple[np.ndarray, int]:
    """By the next ``width`` bits: id and code length, as id << 5 | length."""
    order, _ = canonical(bits)
    width = int(bits.max(initial=1))
    entries = (order << 5 | bits[order]).astype(np.uint32)
    table = np.repeat(entries, 1 << (width - bits[order].astype(np.int64)))
    return np.r_[table, np.full((1 << width) - len(table), 1, np.uint32)], width


def encode(ids: np.ndarray, bits: np.ndarray, code: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Codes of ``ids`` one after another, and the bit offset of every ``STRIDE``-th."""
    length = bits[ids].astype(np.int64)
    last = np.cumsum(length)
    first = last - length
    word = first >> 5
    # a code lies in at most two 32-bit words; the sums below never carry, as no two codes share a bit
    lane = code[ids].astype(np.uint64) << (64 - (first & 31) - length).astype(np.uint64)
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(int(last[-1] >> 5) + 2, np.uint64)
    out[word[start]] += np.add.reduceat(lane >> np.uint64(32), start)
    out[word[start] + 1] += np.add.reduceat(lane & np.uint64(0xffffffff), start)
    return out.astype(">u4").tobytes()[:int(last[-1] + 7) >> 3], first[::STRIDE].astype("<u4")


def decode(parts: list[bytes], marks: list[np.ndarray], n: list[int], table: np.ndarray, width: int) -> np.ndarray:
    """Ids of several blocks one after another.  All lanes (stretches of
    ``STRIDE`` ids from a mark) take a step at a time."""
    bytes_before = np.cumsum([0, *map(len, parts)])
    raw = np.frombuffer(b"".join(parts) + bytes(4), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    place = np.concatenate([m.astype(np.int64) + 8 * b for m, b in zip(marks, bytes_before, strict=False)])
    lengths = np.concatenate([np.minimum(STRIDE, k - STRIDE * np.arange(len(m))) for m, k in zip(marks, n, strict=True)])
    # full lanes first, so that the lanes still running are always the first ones
    order = np.argsort(-lengths, kind="stable")
    place, running = place[order], np.searchsorted(-lengths[order], -np.arange(STRIDE), "left")
    out, mask = np.zeros((STRIDE, len(place)), np.uint32), np.uint32((1 << width) - 1)
    for step in range(int(lengths.max(initial=0))):
        here = place[:running[step]]
        found = table[(ahead[here >> 3] >> (32 - width - (here & 7)).astype(np.uint32)) & mask]
        out[step, :len(here)] = found >> 5
        here += found & np.uint32(31)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    whole = out.T[back]
    return whole[np.arange(STRIDE) < lengths[:, None]]


# ---- writing

def _count(kind: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in batch.column(0):
                counts += np.bincount(np.frombuffer(part.as_buffer(), kind), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], names=["id", "n"])
    return run


class _Block:
    """Ids of the block that is being filled, and its documents."""

    def __init__(self):
        self.parts, self.docs, self.ats, self.places, self.n = [], [], [], [], 0

    def add(self, ids: np.ndarray, doc, at: int) -> None:
        if at == 0 or not self.n:
            self.docs.append(doc)
            self.ats.append(at)
            self.places.append(self.n)
        self.parts.append(ids)
        self.n += len(ids)


def _write(kind: str, bits: np.ndarray, docs_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, code = canonical(bits)
        file, number, first, block = TaskContext.get().partitionId(), 0, 0, _Block()

        def row(continues: bool) -> pa.RecordBatch:
            packed, marks = encode(np.concatenate(block.parts), bits, code)
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int64()), pa.array([first], pa.int64()), pa.array([block.n], pa.int32()),
                 pa.array([block.docs], pa.list_(docs_type)), pa.array([block.ats], pa.list_(pa.int64())), pa.array([block.places], pa.list_(pa.int32())),
                 pa.array([continues]), pa.array([marks.tobytes()], pa.binary()), pa.array([packed], pa.binary())],
                names=["file", "block", "first", "n", "docs", "ats", "places", "continues", "marks", "bits"])
        for batch in batches:
            for doc, n, at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                ids = np.frombuffer(part.as_buffer(), kind)
                while len(ids):
                    here = ids[:BLOCK_IDS - block.n]
                    block.add(here, doc, at)
                    at, ids = at + len(here), ids[len(here):]
                    if block.n == BLOCK_IDS:
                        yield row(at < n)
                        number, first, block = number + 1, first + block.n, _Block()
        if block.n:
            yield row(at < n)
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, text: str = "text", key: str = "doc_id", file_ids: int = FILE_IDS) -> None:
    """Write all documents' ids, in ascending order of the key, under ``path``."""
    spark, kind = docs.sparkSession, id_kind(tokenizer)
    made = tokenised(docs, tokenizer, kind, end_id, text, key)
    size = 1 << (16 if kind == "<u2" else 20)
    counts = np.zeros(size, np.int64)
    for r in made.select("ids").mapInArrow(_count(kind, size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    bits = code_lengths(counts)
    used = np.flatnonzero(bits)
    code = spark.createDataFrame([(int(i), int(bits[i])) for i in used], "id int, bits int")
    code.coalesce(1).write.parquet(f"{path}/code")
    own = made.schema["key"].dataType.simpleString()
    order = made.repartitionByRange(1 + int(counts.sum()) // file_ids, "key", "n", "crc", "place").sortWithinPartitions("key", "n", "crc", "place")
    blocks = order.select("key", "n", "at", "ids").mapInArrow(
        _write(kind, bits, _arrow(made.select("key"))),
        f"file int, block long, first long, n int, docs array<{own}>, ats array<long>, places array<int>, continues boolean, marks binary, bits binary")
    blocks.write.parquet(f"{path}/blocks")
    # one row a file: a table much smaller than the number of documents
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("file").agg(F.sum("n").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).coalesce(1).write.parquet(f"{path}/files")


def _arrow(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[0].dataType)


# ---- reading

def _read_code(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/code").collect()
    bits = np.zeros(1 + max((r["id"] for r in rows), default=0), np.uint8)
    for r in rows:
        bits[r["id"]] = r["bits"]
    return bits


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks, with ``first`` counted over all files."""
    files = spark.read.parquet(f"{path}/files").select("file", "before")
    if files.count() <= BROADCAST_FILES:
        files = F.broadcast(files)
    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.join(files, "file").withColumn("first", F.col("first") + F.col("before")).drop("before")


def _segments(bits: np.ndarray, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, width = decode_table(bits)
        for whole in batches:
            for k in range(0, len(whole), BATCH_BLOCKS):
                batch = whole.slice(k, BATCH_BLOCKS)
                col = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names) if name not in ("docs",)}
                ids = decode(col["bits"], [np.frombuffer(m, "<u4") for m in col["marks"]], col["n"], table, width).astype("<u4")
                start, at, n, crc, done, spans, before = [], [], [], [], [], [], 0
                for first, size, ats, places, continues in zip(col["first"], col["n"], col["ats"], col["places"], col["continues"], strict=True):
                    for i, (a, p) in enumerate(zip(ats, places, strict=True)):
                        last = i + 1 == len(places)
                        end = size if last else places[i + 1]
                        own = ids[before + p:before + end]
                        start.append(first + p - a)
                        at.append(a)
                        n.append(end - p)
                        crc.append(zlib.crc32(own))
                        done.append(a == 0 and not (last and continues))
                        if keep_ids:
                            spans.append(own.astype(np.int64))
                    before += size
                out = [batch.column(batch.schema.get_field_index("docs")).flatten(), pa.array(start, pa.int64()), pa.array(at, pa.int64()), pa.array(n, pa.int64()),
                       pa.array(crc, pa.int64()), pa.array(done)]
                names = ["doc", "start", "at", "n", "crc", "whole"]
                if keep_ids:
                    out.append(pa.array(spans, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def segments(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Decoded (doc, start, at, n, crc, whole[, ids]): the part of a document
    that lies in a block; start is the document's place among all ids."""
    blocks = _placed(spark, path).select("docs", "first", "n", "ats", "places", "continues", "marks", "bits")
    own = blocks.schema["docs"].dataType.elementType.simpleString()
    return blocks.mapInArrow(_segments(_read_code(spark, path), keep_ids),
                             f"doc {own}, start long, at long, n long, crc long, whole boolean" + (", ids array<long>" if keep_ids else ""))


def _times(a: int, b: int) -> int:
    """Product modulo the checksum's polynomial, bits reflected."""
    out = 0
    while a:
        if a & 1 << 31:
            out ^= b
        a = a << 1 & 0xffffffff
        b = b >> 1 ^ (0xedb88320 if b & 1 else 0)
    return out


def crc_after(a: int, b: int, n: int) -> int:
    """crc32 of two byte strings together: ``a`` and ``b`` are theirs, ``n`` the second's length."""
    shift, power = 1 << 31, 1 << 23  # x ** 0 and x ** 8
    while n:
        if n & 1:
            shift = _times(power, shift)
        power = _times(power, power)
        n >>= 1
    return _times(shift, a) ^ b


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, crc = [], []
        for parts in batch.column(2).to_pylist():
            size, check = 0, 0
            for part in sorted(parts, key=lambda p: p["at"]):
                size, check = size + part["n"], crc_after(check, part["crc"], 4 * part["n"])
            n.append(size)
            crc.append(check)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["doc", "start", "n", "crc"])


def digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, start, n_tokens, ids_crc32."""
    found = stored(segments(spark, path), "huffman-segments")
    own = found.schema["doc"].dataType.simpleString()
    # only documents on a block's edge meet again; their places tell them apart
    split = found.where("not whole").groupBy("start").agg(F.first("doc").alias("doc"), F.collect_list(F.struct("at", "n", "crc")).alias("parts"))
    split = split.select("doc", "start", "parts").mapInArrow(_together, f"doc {own}, start long, n long, crc long")
    return (found.where("whole").select("doc", "start", "n", "crc").unionByName(split)
                 .select(F.col("doc").alias(key), "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")))


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document: key, start, ids."""
    found = segments(spark, path, keep_ids=True)
    split = found.where("not whole").groupBy("start").agg(F.first("doc").alias("doc"), F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    split = split.select("doc", "start", F.flatten("parts.ids").alias("ids"))
    return found.where("whole").select("doc", "start", "ids").unionByName(split).select(F.col("doc").alias(key), "start", "ids")


def _span(bits: np.ndarray, lo: int, hi: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, width = decode_table(bits)
        for batch in batches:
            for r in batch.to_pylist():
                a, b = max(0, lo - r["first"]), min(r["n"], hi - r["first"])
                lane = a // STRIDE
                marks = np.frombuffer(r["marks"], "<u4")[lane:-(-b // STRIDE)]
                # only the lanes that the span meets, from the mark before it
                ids = decode([r["bits"]], [marks], [b - lane * STRIDE], table, width)[a - lane * STRIDE:]
                yield pa.RecordBatch.from_arrays([pa.array([r["first"] + a], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["start", "ids"])
    return run


def window(spark: SparkSession, path: str, first: int, n: int) -> DataFrame:
    """Ids ``first`` to ``first + n`` of the whole stream, a row per block that holds some: start, ids."""
    here = _placed(spark, path).where((F.col("first") < first + n) & (F.col("first") + F.col("n") > first))
    return here.select("first", "n", "marks", "bits").mapInArrow(_span(_read_code(spark, path), first, first + n), "start long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the documents to the shared folder and digest what the files give back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end_id, text, key)
    return digests(docs.sparkSession, path, key)
