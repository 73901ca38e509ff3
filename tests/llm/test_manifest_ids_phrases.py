import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import MEDIUM, SMALL, docs, empty  # noqa: F401
from pyspark.sql import functions as F

from ledgerlens.llm import huffman, merkle, phrases
from ledgerlens.llm.queries import LOWER, ORACLE, QUERIES, remainder, tokenizer_path
from ledgerlens.llm.words import coded
from ledgerlens.session import scratch_path
from ledgerlens.sources.tables import table

LOW = {ord(a): b for a, b in zip(*LOWER, strict=True)}


def text_key(row):
    return tuple(map(str, row))


# ---- Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root, and per node its siblings (left, right) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, p in zip(paths, at, strict=True):
            run = nodes[p // 8 * 8:p // 8 * 8 + 8]
            path.append((run[:p % 8], run[p % 8 + 1:]))
        nodes, at = [sha(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [p // 8 for p in at]
    return nodes[0], paths


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, sha(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, r.text))), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for n in names:
        groups[n].sort(key=lambda x: x[:3])
        trees[n] = tree([x[2] for x in groups[n]])
    root, top = tree([trees[n][0] for n in names])
    out = []
    for n, above in zip(names, top, strict=True):
        for (_, _, leaf, r), own in zip(groups[n], trees[n][1], strict=True):
            node, path = leaf, own + above
            if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                node = sha(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, r.text.translate(LOW))))
            for a, b in path:
                node = sha(*a, node, *b)
            out.append((r.doc_id, n, leaf, trees[n][0], root, sha(*(x for a, b in path for x in (*a, *b))), node, node == root))
    return sorted(out, key=text_key)


def manifest(df):
    out = merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], suspect={"text": F.translate("text", *LOWER)}, where=remainder("doc_id", 3) == 0)
    return sorted((tuple(r[c] for c in ("doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in out.collect()), key=text_key)


def test_manifest_fixture(docs, empty):
    want = brute_manifest(docs.collect())
    assert manifest(docs) == want
    assert manifest(docs.repartition(7)) == want
    assert manifest(empty) == []


def test_manifest_rounds(spark):
    """A group of several blocks beside many of one leaf, and a null group: block roots and groups take rounds of their own."""
    big = spark.range(0, 6000).selectExpr("id div 2 as doc_id", "cast(id as string) as text", "case when id < 4200 then 'a' when id % 3 = 0 then null else concat('l', id) end as lang",
                                          "'s' as source", "id as n_chars", "'x' as node", "'y' as path")
    assert manifest(big) == brute_manifest(big.collect())


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513])
def test_manifest_sizes(spark, n):
    one = spark.range(0, n).selectExpr("id as doc_id", "'T' as text", "'a' as lang", "'s' as source", "id as n_chars")
    assert manifest(one) == brute_manifest(one.collect())


def test_manifest_finds_any_change(spark):
    base = table(spark, SMALL, "documents")
    plain = merkle.manifest(base, ["doc_id", "source", "lang", "n_chars", "text"])
    assert plain.where("not verified").count() == 0
    bad = merkle.manifest(base, ["doc_id", "text"], suspect={"text": F.concat("text", F.lit(" "))}, where=F.col("doc_id") % 5 == 0)
    assert bad.where("not verified").count() == base.where("doc_id % 5 = 0 and text is not null").count()


def test_manifest_native(spark):
    plan = QUERIES["op11_merkle_manifest"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---- ids in Huffman codes

def brute_ids(rows, path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    found = []
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        found.append((r.doc_id is not None, r.doc_id or 0, len(ids), zlib.crc32(ids.tobytes()), r.doc_id, ids))
    found.sort(key=lambda x: x[:4])
    start, out = 0, []
    for f in found:
        out.append((f[4], start, f[2], f[3]))
        start += f[2]
    return sorted(out, key=text_key), np.concatenate([f[5] for f in found]) if found else np.empty(0)


def test_ids_fixture(docs, empty):
    path = tokenizer_path("word_bpe_49k.json")
    want, _ = brute_ids(docs.collect(), path)
    assert sorted(map(tuple, huffman.round_trip(docs, path).collect()), key=text_key) == want
    assert sorted(map(tuple, huffman.round_trip(docs.repartition(5), path).collect()), key=text_key) == want
    assert huffman.round_trip(empty, path).collect() == []


def test_ids_files(spark):
    """Many files, documents over their edges, every id and any window back."""
    path, out = tokenizer_path("word_bpe_49k.json"), scratch_path(spark, "ids")
    own = table(spark, MEDIUM, "documents")
    want, stream = brute_ids(own.collect(), path)
    huffman.write(own, out, path, file_ids=70_000)
    assert sorted(map(tuple, huffman.digests(spark, out).collect()), key=text_key) == want
    files = spark.read.parquet(out + "/files").count()
    assert files > 5
    blocks = spark.read.parquet(out + "/blocks")
    assert blocks.agg(F.sum(F.length("bits"))).first()[0] < 1.5 * len(stream)  # against two bytes an id
    read = np.concatenate([r["ids"] for r in huffman.read(spark, out).orderBy("start").collect()])
    assert (read == stream).all()
    for first, n in ((0, 1), (65_530, 20), (123_456, 200_000), (len(stream) - 5, 50)):
        part = np.concatenate([r["ids"] for r in huffman.window(spark, out, first, n).orderBy("start").collect()])
        assert (part == stream[first:first + n]).all()
    assert not huffman.segments(spark, out).where("not whole").limit(1).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=900), st.integers(6, 20))
def test_code_round_trip(ids, limit):
    ids = np.array(ids)
    counts = np.bincount(ids, minlength=41)
    bits = huffman.code_lengths(counts, limit)
    used = bits[bits > 0].astype(float)
    assert bits.max() <= limit and (len(used) == 1 or (2.0 ** -used).sum() == 1) and ((bits > 0) == (counts > 0)).all()
    packed, marks = huffman.encode(ids, bits, huffman.canonical(bits)[1])
    code, width = huffman.decode_table(bits)
    assert (huffman.decode([packed, packed], [marks, marks], [len(ids)] * 2, code, width) == np.r_[ids, ids]).all()


def test_code_is_optimal():
    """Without an effective limit the size is that of the plain Huffman code."""
    import heapq
    counts = np.random.default_rng(5).zipf(1.5, 300)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (huffman.code_lengths(counts, 40) * counts).sum() == cost
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=80))
def test_checksum_of_parts(a, b):
    assert huffman.crc_after(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"bb", b"", b"\n", b" ", "é".encode()]), max_size=30))
def test_coded_words(parts):
    block = b" ".join(parts)
    at, words = coded(block)
    assert [words[i] for i in at] == [w for w in block.split(b" ") if w] and len(set(words)) == len(words)


# ---- phrases

def brute_phrases(rows, least, top, longest=4):
    import re
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        for piece in re.split("[.,;:!?\n-\r]", (r.text or "").translate(LOW)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {g: c for g, c in f.items() if len(g[1]) > 1 and c >= least}
    around = Counter()
    for (lang, words), c in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                around[lang, words[i:i + k]] = max(around[lang, words[i:i + k]], c)
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) in around and 100 * around[lang, words] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, own in out.items() for i, x in enumerate(sorted(own)[:top], 1))


def mined(df, **k):
    return sorted(map(tuple, phrases.mine(df, **k).collect()))


def test_phrases_fixture(docs, empty):
    rows = docs.collect()
    assert mined(docs, least=2, top=30) == brute_phrases(rows, 2, 30)
    assert mined(empty) == []


def test_phrases_blocks(spark, monkeypatch):
    """Repetitive texts of three languages; blocks and slices many, groups joined instead of broadcast."""
    draw = np.random.default_rng(3)
    words = np.array(["Alpha", "beta", "gämma", "d", "it's", "of", "the", "X"])
    texts = [" ".join(words[draw.integers(0, 8, int(draw.integers(0, 60)))]).replace(" d ", " d, ").replace("X", "X.\n") for _ in range(400)]
    rows = [(i, t, ("en", "de", None)[i % 3] if i % 50 else "und") for i, t in enumerate(texts)] + [(900, None, "en"), (901, " \t\x0b", "de"), (902, "a a a a a a a", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("block", F.lit("x")).withColumn("phrase", F.lit("y")).repartition(9)
    want = brute_phrases(df.collect(), 5, 20)
    assert len(want) == 60 and mined(df, least=5, top=20) == want
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(phrases, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(phrases, "ONE_KEY", 20)
    monkeypatch.setattr(phrases, "SLICE_ROWS", 50)
    assert mined(df, least=5, top=20) == want


def test_phrases_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    row = spark.createDataFrame([([big - 1, big // 3], [big, big // 3], big // 3)], "pre array<long>, suf array<long>, f long")
    cut = row.select(F.expr(phrases.CUT).alias("cut")).first()["cut"]
    assert cut["score"] == 2_000_000 * (big // 3) // (2 * big - 1) and (cut["l"], cut["r"]) == (big - 1, big)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_setm_phrases"])
def test_oracle(spark, duck_small, name):
    from oracle_check import compare
    ok, n, _, detail = compare(spark, duck_small, name, QUERIES[name], ORACLE[name], SMALL)
    assert ok and (n or name == "op13_setm_phrases"), detail
