import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SMALL, docs, empty  # noqa: F401
from tokenizers import Tokenizer

from ledgerlens.llm import mixing, packing, sharding
from ledgerlens.sources.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def brute_targets(sizes: dict, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_ = sum(sizes.values()), set(order)
    target = {}
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = cap * sizes[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("which", ["fixture", "table"])
def test_mix(spark, docs, which):
    docs = docs if which == "fixture" else table(spark, SMALL, "documents")
    made = mixing.mix(docs).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in made) == sorted((str(r["doc_id"]), len(WORD.findall(r["text"] or ""))) for r in docs.select("doc_id", "text").collect())
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in made:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    target = brute_targets(sizes)
    for r in made:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]], rel=1e-9)
    for s in sizes:
        # repeated rows move together, so a step may be twice the largest text
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
        if len([r for r in made if r["source"] == s]) > 5 and which == "table":
            assert abs(taken[s] - target[s]) <= 0.05 * target[s] + largest[s] / 2
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, made)) == sorted(map(key, again))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in made)


def test_tilt_is_the_entropy_optimum(spark):
    """Rates of a source are exp(a * size), cut at 3, and meet the target."""
    made = mixing.mix(table(spark, SMALL, "documents")).where("size > 0").toPandas()
    for _, g in made.groupby("source"):
        free = g[(g.rate < 3) & (g.rate > 0)]
        slopes = np.log(free.rate) / free["size"]
        assert np.ptp(slopes) <= 1e-9 + 1e-6 * np.abs(slopes).max()
        assert (g.rate * g["size"]).sum() == pytest.approx(g.target.iloc[0], rel=1e-5)


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).collect() == []


@pytest.mark.parametrize("which", ["fixture", "table"])
def test_shards(spark, docs, which):
    docs = docs if which == "fixture" else table(spark, SMALL, "documents")
    made = sharding.shard(docs, 8).collect()
    texts = docs.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in made) == want
    slots, load, home = defaultdict(list), defaultdict(int), {}
    for r in made:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        assert home.setdefault(r["group"], r["shard"]) == r["shard"] and 0 <= r["shard"] < 8
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    if which == "table":
        assert max(load.values()) <= 1.01 * sum(load.values()) / 8


def test_bundles_of_small_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 5)
    monkeypatch.setattr(sharding, "BUNDLES", 20)
    made = sharding.shard(table(spark, SMALL, "documents"), 4).collect()
    load, home = defaultdict(int), {}
    for r in made:
        load[r["shard"]] += r["size"]
        assert home.setdefault(r["group"], r["shard"]) == r["shard"]
    assert len(made) == 200 and max(load.values()) <= 1.05 * sum(load.values()) / 4


def test_best_fit_takes_the_tightest_room():
    import random
    draw = random.Random(5)
    sizes = sorted((draw.randint(1, 50) for _ in range(3000)), reverse=True)
    placed, used = sharding.best_fit(sizes, 100)
    room, mine = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            room.append(100)
            i = len(room) - 1
        room[i] -= s
        mine.append(i)
    assert placed == mine and used == len(room)


def test_shards_of_nothing(empty):
    assert sharding.shard(empty, 3).collect() == []


@pytest.mark.parametrize("which", ["fixture", "table"])
def test_packing(spark, docs, which):
    docs = docs if which == "fixture" else table(spark, SMALL, "documents")
    made = packing.pack(docs, TOKENIZER, 512).collect()
    tokenizer, want = Tokenizer.from_file(TOKENIZER), []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(r["doc_id"]), i // 512, i, len(ids[i:i + 512]), zlib.crc32(ids[i:i + 512].tobytes())) for i in range(0, len(ids), 512)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in made) == sorted(want)
    held = defaultdict(list)
    for r in made:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(r["length"] for r in made)
    assert len(held) <= 1.05 * total / 512 + 2


def test_rounds_place_every_piece_once():
    import random
    draw = random.Random(3)
    lengths = {k: draw.randint(0, 400) for k in draw.sample(range(1, 101), 60)}
    plan, n = packing.best_fit_rounds(lengths, 100)
    ranks, fill = defaultdict(set), defaultdict(list)
    for length, first, k, at, offset in plan:
        for i in range(k):
            assert first + i not in ranks[length]
            ranks[length].add(first + i)
            fill[at + i].append((offset, length))
    assert {k: len(v) for k, v in ranks.items()} == {k: v for k, v in lengths.items() if v}
    assert len(fill) == n
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    one_by_one = sharding.best_fit([k for k in sorted(lengths, reverse=True) for _ in range(lengths[k])], 100)[1]
    assert n <= 1.01 * one_by_one


def test_packing_of_nothing(empty):
    assert packing.pack(empty, TOKENIZER).collect() == []
