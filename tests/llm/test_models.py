import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from llm_fixtures import MEDIUM, docs, empty  # noqa: F401
from pyspark.sql import functions as F

from ledgerlens.llm import langid, ppm
from ledgerlens.llm.queries import remainder
from ledgerlens.sources.tables import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_base_scores(docs, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_SHARE", 0.01)  # most words take the join
    made = ppm.score(docs, remainder("doc_id", 5) == 1).collect()
    counts, texts = Counter(), docs.select("doc_id", "text").collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words = lambda t: [*(t or "").encode().lower().split(), None]
    for r in texts:
        if not held(r["doc_id"]):
            counts.update(words(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r["doc_id"]), held(r["doc_id"]), len(w := words(r["text"])), sum(counts[x] > 0 for x in w), n,
                   round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for r in texts)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in made) == want
    assert all(r["score"] < 0 for r in made)


def brute_symbol(counts, context, symbol, order, alphabet):
    """Prediction by partial matching straight from the definition, with full counts."""
    context, excluded, p = context[-order:], set(), 1.0
    while True:
        after = {s: n for (c, s), n in counts.items() if c == context}
        if after:
            seen = {s: n for s, n in after.items() if s not in excluded}
            total = sum(seen.values()) + len(after)
            if symbol in seen:
                return p * seen[symbol] / total
            p *= len(after) / total
            excluded |= set(after)
        if not context:
            return p / (alphabet - len(excluded))
        context = context[1:]


def test_trie_follows_the_definition(spark, monkeypatch):
    monkeypatch.setattr(ppm, "TRIE_SHARE", 0.0)
    texts = ["ab abc\tabd ab", "abc bd", "", " b"] * 3
    trie = ppm.train_trie(ppm.word_table(spark.createDataFrame([(t,) for t in texts], "text string")))
    counts = Counter()
    for t in texts:
        symbols = t.translate(str.maketrans("\t", " ")) + "\n"
        for i, s in enumerate(symbols):
            start = " " + symbols[:i]
            start = start[start.rindex(" "):]
            for k in range(min(ppm.ORDER, len(start)) + 1):
                counts[start[len(start) - k:].encode(), s.encode()] += 1
    kept = {k: n for k, n in counts.items() if n >= 2}
    assert set(kept) == {(g[:-1], g[-1:]) for g in trie.count}
    for context in {c for c, _ in kept} | {b" zz", b" abq"}:
        for symbol in (b"a", b"b", b"c", b"d", b" ", b"\n", b"z"):
            short = context[-ppm.ORDER:]
            while short and short not in trie.node:
                short = short[1:]
            assert trie.symbol(context, symbol) == pytest.approx(math.log10(brute_symbol(kept, short, symbol, ppm.ORDER, ppm.SYMBOLS)), abs=1e-9)
    # probabilities of a context add up to one
    every = [bytes([b]) for b in range(256) if bytes([b]) not in ppm.SPACES] + [ppm.SEPARATOR, ppm.END]
    assert len(every) == ppm.SYMBOLS
    for context in (b" ", b" a", b" ab", b" abc", b"zzzz"):
        assert sum(10 ** trie.symbol(context, s) for s in every) == pytest.approx(1, abs=1e-6)


def brute_scores(texts, learned):
    """log10 of the probabilities of whole texts straight from the definition, with every gram that occurs twice."""
    plain = [b"".join(ppm.SEPARATOR if bytes([x]) in ppm.SPACES else bytes([x]) for x in t.lower()) + ppm.END for t in texts]
    counts, spaces = Counter(), Counter()

    def places(t):
        for i in range(len(t)):
            yield (b" " + t[:i])[-ppm.ORDER:], t[i]
    for t, raw, use in zip(plain, texts, learned, strict=True):
        if use:
            spaces.update(x for x in raw if bytes([x]) in ppm.SPACES)
            counts.update((context[len(context) - k:], s) for context, s in places(t) for k in range(len(context) + 1))
    total, distinct, kept = Counter(), Counter(), {}
    for (c, s), n in counts.items():
        total[c] += n
        distinct[c] += 1
        kept.setdefault(c, {}).update({s: n} if n >= 2 else {})

    def code(context, s):
        while context and total[context] < 2:
            context = context[1:]
        mass, found = total[context] + distinct[context], 0.0
        while s not in kept[context]:
            found += math.log10((total[context] - sum(kept[context].values()) + distinct[context]) / mass)
            if not context:
                return found - math.log10(ppm.SYMBOLS - len(kept[context]))
            longer, context = context, context[1:]
            mass = total[context] + distinct[context] - sum(kept[context][x] for x in kept[longer])
        return found + math.log10(kept[context][s] / mass)
    of = sum(spaces.values()) + len(ppm.SPACES)
    return [sum(code(*x) for x in places(t)) + sum(math.log10((spaces[x] + 1) / of) for x in raw if bytes([x]) in ppm.SPACES) for t, raw in zip(plain, texts, strict=True)]


@pytest.mark.parametrize("share, chunk", [(2e-6, 1_000_000), (0.01, 7), (1.1, 50)])
def test_every_gram_counts_whatever_its_share(spark, monkeypatch, share, chunk):
    """Rare grams are in the model however large the corpus, and scores do not depend on which grams are broadcast."""
    monkeypatch.setattr(ppm, "TRIE_SHARE", share)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk, raising=False)
    texts = ["the cat sat on the mat"] * 60 + ["a rare\tzyzzyva here", "a rare zyzzyva there ", "Rare zyzzyvas\n\nthe cat", "", "qué x\0y", "the  unseen zyz mat", " "]
    made = sorted(ppm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), remainder("doc_id", 5) == 1).collect())
    learned = [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]
    assert [not r["held_out"] for r in made] == learned and not all(learned[60:])
    assert [r["score"] for r in made] == pytest.approx(brute_scores([t.encode() for t in texts], learned), abs=1e-6)


def test_shuffled_words_score_worse(spark):
    texts = ["the cat sat on the mat and the dog lay by the door"] * 40
    *first, last = texts[0].split()
    texts += [texts[0], " ".join([*reversed(first), last])]
    made = sorted(ppm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.col("doc_id") >= 40).collect())
    assert made[40]["score"] == pytest.approx(made[0]["score"]) and made[41]["score"] < made[40]["score"] - 1


def test_model_prefers_its_corpus(spark):
    docs = table(spark, MEDIUM, "documents").where("lang = 'en'")
    made = ppm.score(docs, remainder("doc_id", 5) == 1).where("held_out").collect()
    texts = {r["doc_id"]: len(r["text"].encode()) for r in docs.collect()}
    bits = -sum(r["score"] for r in made) / math.log10(2) / sum(texts[r["doc_id"]] for r in made)
    assert bits < 3


def test_scores_of_nothing(empty, docs):
    assert ppm.score(empty, remainder("doc_id", 5) == 1).collect() == []
    made = ppm.score(docs.where("doc_id = 7"), remainder("doc_id", 1) == 0).collect()  # nothing to learn from
    assert [(r["n_known"], r["train_tokens"]) for r in made] == [(0, 0)] and math.isfinite(made[0]["score"])


def test_forward_sums_all_segmentations():
    pieces = langid.pieces_of(PIECES)
    import numpy as np
    draw = np.random.default_rng(1)
    chance = draw.random((pieces.size, 2))
    words = ["the", "étés", "abcab", "\U00010400x"]
    got = langid.forward(lattice := pieces.lattice(words), chance)
    names = {}
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i in range(model.vocab_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            names[model.id_to_piece(i)] = len(names)

    def total(w, language):
        if not w:
            return 1.0
        out = sum(chance[names[w[:k]], language] * total(w[k:], language) for k in range(1, len(w) + 1) if w[:k] in names)
        return out + (chance[pieces.unknown, language] * total(w[1:], language) if w[0] not in names else 0)

    for i, w in enumerate(words):
        for language in (0, 1):
            assert got[i, len(w) + 1, language] == pytest.approx(total("▁" + w, language))
    uses = langid.expected_uses(lattice, chance, np.ones((len(words), 2)))
    spelled = sum(uses[i, 0] * pieces.lengths[i] for i in range(pieces.size))
    assert spelled == pytest.approx(sum(len(w) + 1 for w in words))


def test_held_out_accuracy(spark):
    docs = table(spark, MEDIUM, "documents")
    made = langid.identify(docs, remainder("doc_id", 3) == 1, PIECES)
    made = made.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(made) > 200 and sum(r["lang"] == r["lang_pred"] for r in made) >= 0.98 * len(made)
    assert all(0 <= r["score"] <= 1 for r in made)


def test_language_cases(docs, empty):
    made = langid.identify(docs, remainder("doc_id", 3) == 1, PIECES).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(made) == docs.count()
    for r in made:
        if r["doc_id"] is not None:
            letter = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letter)
    assert langid.identify(empty, remainder("doc_id", 3) == 1, PIECES).collect() == []
