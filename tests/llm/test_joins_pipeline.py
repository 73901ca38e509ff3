import numpy as np
import pytest
from llm_fixtures import MEDIUM, SMALL, docs, empty  # noqa: F401

from ledgerlens.llm import embed_dedup, ngram_join
from ledgerlens.llm.common import components, numbered
from ledgerlens.sources.tables import table


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def union(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_join(rows):
    """Component of every row: smallest id among the rows linked with it."""
    sets = [shingle_set(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    group = union(len(rows), pairs)
    least = {}
    for (k, _), g in zip(rows, group, strict=True):
        if k is not None:
            least[g] = min(k, least.get(g, k))
    return sorted((str(k), len(s), str(None if k is None else least[g])) for (k, _), s, g in zip(rows, sets, group, strict=True))


def result(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def near_copies(n=120):
    """Texts around the threshold: windows of one long text, with words changed."""
    draw = np.random.default_rng(2)
    words = [f"v{i}" for i in range(400)]
    out = []
    for k in range(n):
        start, size = int(draw.integers(0, 60)), int(draw.integers(60, 120))
        own = words[start:start + size]
        for i in draw.integers(0, size, int(draw.integers(0, 4))):
            own[i] = f"x{k}_{i}"
        out.append((1000 + k, " ".join(own)))
    return out


def test_join_fixture(docs, empty):
    assert result(ngram_join.join(docs)) == brute_join([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngram_join.join(empty).collect() == []


def test_join_at_the_threshold(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_join(rows)
    assert 3 < len({c for _, _, c in want}) < len(rows)
    assert result(ngram_join.join(df)) == want
    # blocks split into many parts, and many token partitions
    assert result(ngram_join.join(df, part_tokens=600)) == want


def test_join_with_many_token_partitions(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK_TOKENS", 700)
    rows = near_copies(60)
    assert result(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_join(rows)


def test_join_table(spark):
    docs = table(spark, SMALL, "documents")
    assert result(ngram_join.join(docs)) == brute_join([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_tree_links_connect_what_brute_force_connects():
    sets = [ngram_join.shingles(t.encode()) for _, t in near_copies(90)]
    links = ngram_join.tree_links(sets, np.arange(len(sets)))
    every = [(i, j) for i in range(len(sets)) for j in range(i) if ngram_join.similar(sets[i], sets[j])]
    assert set(union(len(sets), links)) == set(union(len(sets), every)) and union(len(sets), links) == union(len(sets), every)
    assert len(links) < len(sets)


def brute_vectors(rows):
    unit = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            unit[i] = x / np.linalg.norm(x)
    pairs = [(i, j) for i in unit for j in unit if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    group, links = union(len(rows), pairs), [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    least = {}
    for (k, _), g in zip(rows, group, strict=True):
        if k is not None:
            least[g] = min(k, least.get(g, k))
    return links, [None if k is None else least[g] for (k, _), g in zip(rows, group, strict=True)]


@pytest.mark.parametrize("list_rows", [4000, 25])
def test_vectors(spark, list_rows):
    draw = np.random.default_rng(4)
    rows = []
    for c in range(40):
        centre = draw.normal(size=32)
        for _ in range(1 + c % 5 * 6):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + draw.normal(size=32) * 0.15]))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [1.0, None] + [0.0] * 30), (1004, [float("nan")] * 32), (1005, [float("inf")] + [1.0] * 31), (1006, rows[3][1]), (1006, rows[3][1]),
             (1007, [1.0, 2.0]), (1008, [1.0, 2.1]), (None, rows[5][1])]
    df = spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], "vec_id long, embedding array<float>, n_links int, name string, times int")
    made = embed_dedup.near_duplicates(df, list_rows=list_rows).collect()
    links, component = brute_vectors(rows)
    want = {}
    for (k, _), n, c in zip(rows, links, component, strict=True):
        want[k] = (n, c, k is not None and k == c)
    assert len(made) == len(rows)
    assert all(r["n_links"] <= want[r["vec_id"]][0] for r in made)
    assert sum(r["n_links"] for r in made) >= 0.9 * sum(links)
    same = sum((r["n_links"], r["component_id"], r["kept"]) == want[r["vec_id"]] for r in made)
    assert same >= 0.9 * len(made)
    bad = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in made}
    assert all(bad[k] == (0, k) for k in range(1000, 1006)) and bad[1007][0] == 1


def planted(n, dim, seed):
    """Unit vectors, and for each one another at a cosine from 0.90 to 0.92."""
    draw = np.random.default_rng(seed)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in draw.standard_normal((2, n, dim)))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = draw.uniform(0.901, 0.92, (n, 1))
    return x, c * x + np.sqrt(1 - c * c) * y


@pytest.mark.parametrize("pivots", [128, 900, 4000, 30_000])
@pytest.mark.parametrize("dim", [32, 128])
def test_recall_just_above_the_limit_at_any_number_of_pivots(pivots, dim):
    # 4000 pivots are those of a million vectors, 30,000 of 56 million
    points = planted(pivots, dim, 1)[0].astype(np.float32)
    a, b = (embed_dedup._near(v, points) for v in planted(1000, dim, 2))
    assert ((a[:, :, None] == b[:, None, :]).any(axis=2).sum(axis=1) >= 2).mean() >= 0.93


def test_separated_points():
    points = planted(700, 4, 3)[0]
    kept = []
    for x in points:
        if all(x @ k < embed_dedup.APART for k in kept):
            kept.append(x)
    assert (embed_dedup._separated(points, 64) == np.array(kept)).all()


def test_vectors_just_above_the_limit(spark, monkeypatch):
    # near all vectors are pivots, as many as 400,000 vectors would have
    monkeypatch.setattr(embed_dedup, "APART", 2.0)
    monkeypatch.setattr(embed_dedup, "MOST_PIVOTS", 2600)
    x, y = planted(1500, 48, 4)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))] + [(3000, [1.0] * 500), (3001, [1.0] * 499 + [1.5])]
    links, component = brute_vectors(rows)
    monkeypatch.setattr(embed_dedup, "sample_size", lambda n: 2600)
    made = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r["n_links"] for r in made) >= 0.9 * sum(links)
    want = {k: (n, c) for (k, _), n, c in zip(rows, links, component, strict=True)}
    assert all(r["n_links"] <= want[r["vec_id"]][0] for r in made)
    assert [(r["n_links"], r["component_id"]) for r in made if r["vec_id"] >= 3000] == [(1, 3000)] * 2


def test_vectors_of_the_table(spark):
    df = table(spark, MEDIUM, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.orderBy("vec_id").collect()]
    links, component = brute_vectors(rows)
    made = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df).collect()}
    assert sum(r["n_links"] for r in made.values()) >= 0.9 * sum(links) and len(made) == len(rows)
    assert embed_dedup.near_duplicates(df.where("vec_id < 0")).collect() == []


def test_components(spark):
    draw = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 460)] + [(-5, 470), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    label = {x: x for p in pairs for x in p}
    while True:
        new = dict(label)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    assert got == {x: c for x, c in label.items() if any(a != b and x in (a, b) for a, b in pairs)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_numbered(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as k")
    made = numbered(df, ["k"], ["id"], "slot", rows_per_task=50).collect()
    for k in range(3):
        slots = sorted(r["slot"] for r in made if r["k"] == k)
        assert slots == list(range(len(slots)))


def test_pipeline(spark):
    """Each stage against brute force on what its predecessor kept."""
    import corpus_pipeline as P
    from ledgerlens.llm import langid, mixing, outliers, packing
    from ledgerlens.llm.queries import remainder, tokenizer_path
    docs = table(spark, SMALL, "documents").cache()
    one = P.language_id(spark, docs, SMALL).cache()
    found = langid.identify(docs, remainder("doc_id", 3) == 1, tokenizer_path("piece_bpe_32k.model")).collect()
    assert one.columns == docs.columns
    assert {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5}
    two = P.quality_rules(spark, one, SMALL).cache()
    assert {r["doc_id"] for r in two.collect()} == {r["doc_id"] for r in outliers.rules(one).where("kept").collect()}
    three = P.near_duplicates(spark, two.unionByName(two.limit(3)), SMALL).cache()
    kept = {int(k) for k, _, c in brute_join([(r["doc_id"], r["text"]) for r in two.collect()]) if k == c}
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(kept)
    four = P.mix_sources(spark, three, SMALL).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(three).collect()}
    assert four.columns == docs.columns
    assert sorted(r["doc_id"] for r in four.collect()) == sorted(k for k, n in copies.items() for _ in range(n))
    five = P.best_fit_packing(spark, four, SMALL)
    assert five.count() == packing.pieces(four, tokenizer_path("word_bpe_49k.json")).count()
    assert P.run(spark, SMALL).count() > 0


def test_near_duplicates_of_repeated_ids(spark):
    """Rows that share an id, with one text or several, and rows without one:
    each group keeps its row of the smallest id, and no other text is lost."""
    import corpus_pipeline as P
    texts = near_copies(60)
    rows = [(None if k % 7 == 0 else k // 3, t, "en", "a", len(t), k) for k, t in texts]
    rows += [(rows[5][0], " ".join(f"other{i}" for i in range(80)), "en", "b", 1, 0), (None, "all alone here", "de", None, 1, 1), rows[8], rows[8]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long").repartition(5)
    kept = P.near_duplicates(spark, df, SMALL).collect()
    at = df.collect()
    sets = [shingle_set(r["text"]) for r in at]
    group = union(len(at), [(i, j) for i in range(len(at)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])])
    least = {}
    for r, g in zip(at, group, strict=True):
        least[g] = min(least.get(g, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(least.values())
    by_text = {r["text"]: g for r, g in zip(at, group, strict=True)}
    assert sorted(by_text[r["text"]] for r in kept) == sorted(least) and df.columns == P.near_duplicates(spark, df, SMALL).columns


def test_pipeline_cases(spark, docs, empty):
    import corpus_pipeline as P
    for start in (docs, empty):
        at = start
        for _, stage in P.STAGES[:-1]:
            at = stage(spark, at, SMALL).cache()
            assert at.columns == start.columns
        P.STAGES[-1][1](spark, at, SMALL).collect()


def test_workers_give_memory_back_between_stages(monkeypatch):
    """Pipeline: packing starts with what the join's workers have freed, and large groups of the join give back theirs."""
    import pyarrow as pa
    from ledgerlens.llm import ngram_join, packing
    from ledgerlens.llm.queries import tokenizer_path
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append("packing"))
    monkeypatch.setattr(ngram_join, "give_back", lambda: given.append("join"))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two"])], names=["key", "text"])

    def batches():
        assert given == ["packing"]  # before the first rows are read
        yield batch
    assert next(packing._pieces(tokenizer_path("word_bpe_49k.json"), 1, 4096)(batches())).num_rows == 1
    same = ngram_join._returning(lambda table: table)
    small, large = pa.table({"x": [1]}), pa.table({"x": range(ngram_join.LARGE_GROUP // 8 + 1)})
    assert same(small) is small and given == ["packing"]
    assert same(large) is large and given == ["packing", "join"]
