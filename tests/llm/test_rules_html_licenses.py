import re
import time
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import MEDIUM, SMALL, docs, empty  # noqa: F401
from pyspark.sql import functions as F

from ledgerlens.llm import html, licenses, outliers
from ledgerlens.sources.tables import table


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("which", ["fixture", "table"])
def test_rules(spark, docs, which):
    docs = docs if which == "fixture" else table(spark, SMALL, "documents")
    made = outliers.rules(docs).collect()
    want = sorted((str(r["doc_id"]), *brute_statistics(r["text"])) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in made) == want
    for r in made:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rules_on_labelled_documents(spark):
    made = outliers.rules(table(spark, MEDIUM, "documents")).join(table(spark, MEDIUM, "labels"), "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in made if r["quality"] == 1], [r["kept"] for r in made if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


@pytest.mark.parametrize("most", [100_000, 0])
def test_estimates_ignore_a_cluster_of_outliers(spark, monkeypatch, most):
    monkeypatch.setattr(outliers, "MOST_BROADCAST", most)
    draw = np.random.default_rng(0)
    clean = draw.normal([5, 1.6, 0.5, 0.5, 0.5], [1, 0.3, 1.0, 2.0, 2.0], (3000, 5))
    far = draw.normal([5, 1.6, 9, 9, 9], 0.05, (600, 5))
    rows = [("0\ng", *map(float, x)) for x in np.concatenate([clean, far])]
    est = outliers.estimate(spark.createDataFrame(rows, ["g", *outliers.Z])).collect()[0]
    mean = np.array([est[f"m{i}"] for i in range(5)])
    assert np.abs(mean - clean.mean(axis=0)).max() < 0.25
    w = np.zeros((5, 5))
    for i, j in outliers.PAIRS:
        w[i, j] = est[f"w{i}{j}"]
    cov = np.linalg.inv(w.T @ w)
    spread = np.sqrt(np.diag(cov) - np.array(outliers.FLOORS) ** 2)
    assert spread == pytest.approx(clean.std(axis=0), rel=0.25)
    assert (((far - mean) @ w.T) ** 2).sum(axis=1).min() > 60


def test_rules_of_nothing(empty):
    assert outliers.rules(empty).collect() == []


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<div id="cookie-notice">We use cookies, a lot of them, and many words here.</div><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="content"><h1>Title &amp; more</h1><p>First para with, commas, and a good number of words so that it counts.<p>Second  one,
also long enough &copy; to count &#233;t&eacute;.<br>After the break<ul><li>item one<li>item <b>t</b>wo</ul><div class="ad">Buy now, cheap!</div>
<blockquote>A quote, said someone.</blockquote><form><label>Mail</label><input name=q></form><table><tr><td>cell a<td>cell b</table></div>
<aside class="sidebar"><p>Side, text, long, with, many, commas, here and there and there and there.</p></aside>
<section id="comments"><h2>Comments</h2><p>Great post, really, thanks, I liked it, so much, yes.</p></section><footer>foot</footer><!-- <p>gone</p> --></body></html>"""
TEXT = ["Title & more", "First para with, commas, and a good number of words so that it counts.", "Second one, also long enough © to count été. After the break",
        "item one", "item two", "A quote, said someone.", "cell a", "cell b"]


def test_page():
    assert html.main_text(PAGE) == "\n\n".join(TEXT)


LONG = "<p>" + "one, two, three four five six seven eight. " * 3 + "</p>"


@pytest.mark.parametrize("paragraphs", [1, 12])
@pytest.mark.parametrize("opening, closing", [("<article>", "</article>"), ("<main id=main>", "</main>"), ("<div class='blog-post'>", "</div>")])
def test_whole_article_beside_its_best_container(paragraphs, opening, closing):
    story = f"<header><h1>Head</h1></header><div class=body>{LONG * paragraphs}</div><h3>More</h3><ul><li>i1<li>i2</ul><p>Last.</p><pre>code</pre><table><tr><td>cell</table><aside>ad</aside>"
    page = f"<body><nav><a href=x>menu</a></nav>{opening}{story}{closing}<footer>foot</footer>"
    body = " ".join(["one, two, three four five six seven eight."] * 3)
    assert html.main_text(page).split("\n\n") == ["Head", *[body] * paragraphs, "More", "i1", "i2", "Last.", "code", "cell"]


def test_unnamed_menu_inside_main():
    menu = "<div>" + "".join(f"<a href=/{i}>another page {i}</a> " for i in range(20)) + "</div>"
    assert html.main_text(f"<main>{menu}<div class=text><p>Kept.</p>{LONG * 5}</div><p>End.</p></main>").split("\n\n")[::6] == ["Kept.", "End."]


@pytest.mark.parametrize("tag", ["<div>", "<b>", "<ul><li>", "<div><p>some text, of a paragraph here and more</p>"])
def test_deep_pages_take_linear_time(tag):
    took = []
    for n in (4000, 16000):
        start = time.process_time()
        assert html.main_text(tag * n + "<p>the last, of all the paragraphs").endswith("the last, of all the paragraphs")
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.5


def test_pages_of_nothing(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_page_cases(spark):
    deep = "<div>" * 3000 + "<p>deep text, with a comma</p>"
    long = "<article>" + "<p>one, two, three four five six seven eight.</p>" * 5000 + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "no tags, only text"), (4, "u", deep), (5, "u", long), (5, "u", long), (None, "u", "<p>a &amp b &am c</p>"), (6, "u", "<p"), (7, "u", "</div></p><p>x")]
    made = {(r["page_id"]): r for r in html.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()}
    assert made[1]["text"] == made[2]["text"] == "" and made[3]["text"] == "no tags, only text" and made[4]["text"] == "deep text, with a comma"
    assert made[5]["text"].count("seven") == 5000 and made[5]["n_chars"] == len(made[5]["text"]) and made[None]["text"] == "a & b &am c"
    assert made[6]["text"] == "" and made[7]["text"] == "x"


def test_pages_of_the_table(spark):
    from html import unescape
    for r, page in zip(html.extract(table(spark, SMALL, "pages")).orderBy("page_id").collect(), table(spark, SMALL, "pages").orderBy("page_id").collect(), strict=True):
        body = page["html"].split("<article>")[1].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>|<br>", "", x))).strip() for x in re.split(r"<h1>|</h1>|<p>|</p>", body)]
        assert r["text"] == "\n\n".join(x for x in blocks if x)


def brute_canonical(text):
    text = re.sub(r"\r\n?", "\n", text).lower()
    if any(x in text for x in ("copyright", "(c)", "©", "all rights reserved")):
        text = re.sub(licenses.COPYRIGHT, " ", text)
    for a, b in licenses.SPELLINGS:
        text = text.replace(a, b)
    return " ".join(re.sub(r"[\W_]+", " ", re.sub(licenses.VERSION, "v", text)).split())


def test_license_scan(spark, empty):
    known = {brute_canonical(t): k for k, t in licenses.known_texts()}
    mit = licenses.KNOWN["MIT"][1]
    texts = [None, "", "Some words.\nReleased under the MIT License.\nMore.", mit.upper(), "Copyright (c) 2020 Someone\n" + mit.replace("sublicense", "sub-license"), "x\n\n" + mit + "\n\ny",
             "LICENSED UNDER CC BY-NC 4.0", "...", "Licensed under the Apache Licence, version 2.0", "the MIT License is short", "(c) 2001 X"]
    rows = [(i, t, "z", 1) for i, t in enumerate(texts)] + [(2, texts[2], "z", 1), (None, texts[2], "z", 1)]
    made = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, license string, n_matches int")).collect()
    assert len(made) == len(rows)
    whole = {r["doc_id"]: r["license"] for r in made}
    found = {r["doc_id"]: r["licenses"] for r in made}
    assert whole[3] == whole[4] == "MIT" and whole[6] == "CC-BY-NC-4.0" and whole[8] == "Apache-2.0" and whole[2] is None
    # a text of several paragraphs inside another is not an entire text
    assert found[2] == ["MIT"] and found[5] == [] and found[0] == found[1] == found[7] == found[9] == found[10] == found[None] == []
    docs = table(spark, SMALL, "documents")
    made = {r["doc_id"]: r["licenses"] for r in licenses.scan(docs).collect()}
    for r in docs.collect():
        forms = {brute_canonical(x) for x in [r["text"], *r["text"].split("\n")]}
        assert made[r["doc_id"]] == sorted({known[f] for f in forms if f in known})
    assert licenses.scan(empty).collect() == []
    own = spark.createDataFrame([("own", "My own Licence!")], "license string, text string")
    assert [r["license"] for r in licenses.scan(spark.createDataFrame([(1, "my own license")], "doc_id long, text string"), own).collect()] == ["own"]
    assert docs.where(F.lit(True)).count() == 200


def test_texts_of_an_id_and_copyright_lines(spark, tmp_path):
    mit, isc = licenses.KNOWN["MIT"][1], licenses.KNOWN["ISC"][0]
    heads = ["Copyright (c) Jane Doe", "Copyright <YEAR> <HOLDER>", "Copyright Jane Doe, 2020", "(c) 2001-2003 Jane Doe", "© 2020 J. Doe. All rights reserved.", "Copyright J. Doe and others"]
    wrapped = mit.replace("The above copyright notice", "The above\ncopyright notice")
    rows = [(1, "plain text"), (1, isc), (1, mit), (1, mit), *((10 + i, h + "\n" + mit) for i, h in enumerate(heads)), (20, wrapped)]
    made = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["license"] or "" for r in made if r["doc_id"] == 1) == ["", "ISC", "MIT", "MIT"]
    assert [r["doc_id"] for r in made if r["doc_id"] >= 10 and r["license"] != "MIT"] == []
    (tmp_path / "Own-1.0.txt").write_text("Copyright 2020 Me\nDo what you like, but keep this text.\n\nNo warranty.")
    (tmp_path / "Other-2").write_text("Another text.")
    known = licenses.read_texts(spark, str(tmp_path))
    texts = [(1, "Copyright (c) You\ndo what you like but keep this\ntext\nno warranty"), (2, "another TEXT"), (3, "another")]
    assert {r["doc_id"]: r["license"] for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()} == {1: "Own-1.0", 2: "Other-2", 3: None}
