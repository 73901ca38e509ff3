"""Registered queries of the training-data operators, with their oracle SQL.

Each ``opN_*`` query reads a whole table and returns its operator's full
result in the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import embed_dedup, html, huffman, langid, licenses, merkle, mixing, ngram_join, outliers, packing, phrases, ppm, sharding
from ledgerlens.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, installed alike on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


ORACLE["op9_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(least(s.doc_id, coalesce(c.b, s.doc_id)) AS BIGINT) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) c ON c.a = s.doc_id
"""

ORACLE["op10_pivot_near_dup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, CAST(least(e.vec_id, coalesce(c.b, e.vec_id)) AS BIGINT) AS component_id,
       e.vec_id <= coalesce(c.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ORACLE["op11_merkle_manifest"] = """
WITH RECURSIVE
leaf AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS g, text,
         concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM documents),
node0 AS (
  SELECT *, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf FROM leaf),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM node0),
up(lv, g, pos, node, total) AS (
  SELECT 0, g, pos, leaf, count(*) OVER (PARTITION BY g) FROM ranked
  UNION ALL
  SELECT lv + 1, g, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + 7) // 8 FROM up WHERE total > 1 GROUP BY lv, g, pos // 8),
sub AS (SELECT g, node AS subroot, lv AS height, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM up WHERE total = 1),
top(lv, pos, node, total) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT lv + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + 7) // 8 FROM top WHERE total > 1 GROUP BY lv, pos // 8),
runs AS (
  SELECT g, lv, pos // 8 AS run, string_agg(node, '' ORDER BY pos) AS digits FROM up WHERE total > 1 GROUP BY g, lv, pos // 8),
top_runs AS (
  SELECT lv, pos // 8 AS run, string_agg(node, '' ORDER BY pos) AS digits FROM top WHERE total > 1 GROUP BY lv, pos // 8),
step AS (
  SELECT r.g, r.pos, x.lv AS k, (r.pos // CAST(pow(8, x.lv) AS BIGINT)) % 8 AS i, x.digits
  FROM ranked r JOIN runs x ON x.g = r.g AND x.run = r.pos // CAST(pow(8, x.lv + 1) AS BIGINT)
  UNION ALL
  SELECT r.g, r.pos, s.height + x.lv, (s.pos // CAST(pow(8, x.lv) AS BIGINT)) % 8, x.digits
  FROM ranked r JOIN sub s ON s.g = r.g JOIN top_runs x ON x.run = s.pos // CAST(pow(8, x.lv + 1) AS BIGINT)),
flank AS (SELECT g, pos, k, substring(digits, 1, i * 64) AS l, substring(digits, i * 64 + 65) AS r FROM step),
proof AS (SELECT g, pos, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256, count(*) AS steps FROM flank GROUP BY g, pos),
crc(doc_id, k, c) AS (
  SELECT DISTINCT doc_id, 0, 4294967295 FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, k + 1, CASE WHEN k % 9 = 0 THEN xor(c, ascii(substring(CAST(doc_id AS VARCHAR), k // 9 + 1, 1)))
                             WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
  FROM crc WHERE k < 9 * strlen(CAST(doc_id AS VARCHAR))),
marked AS (SELECT doc_id FROM crc WHERE k = 9 * strlen(CAST(doc_id AS VARCHAR)) AND xor(c, 4294967295) % 3 = 0),
given AS (
  SELECT g, pos, sha256(concat(head, coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))) AS node
  FROM ranked WHERE doc_id IN (SELECT doc_id FROM marked)),
fold(g, pos, k, node) AS (
  SELECT r.g, r.pos, 0, coalesce(t.node, r.leaf) FROM ranked r LEFT JOIN given t ON t.g = r.g AND t.pos = r.pos
  UNION ALL
  SELECT f.g, f.pos, f.k + 1, sha256(concat(s.l, f.node, s.r)) FROM fold f JOIN flank s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k)
SELECT r.doc_id, r.lang, r.leaf, s.subroot, t.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM ranked r JOIN sub s ON s.g = r.g CROSS JOIN (SELECT node FROM top WHERE total = 1) t
LEFT JOIN proof p ON p.g = r.g AND p.pos = r.pos
JOIN fold f ON f.g = r.g AND f.pos = r.pos AND f.k = coalesce(p.steps, 0)
"""

ORACLE["op13_setm_phrases"] = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS piece, w FROM (
    SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents))),
gram AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM piece, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM piece GROUP BY lang),
word AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f),
cut AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, j.j, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS score
  FROM word c JOIN (VALUES (1), (2), (3)) j(j) ON j.j < c.k
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j.j], ' ') AND x.k = j.j
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j.j + 1:c.k], ' ') AND y.k = c.k - j.j),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT q.lang, m.m AS k, array_to_string(q.w[i.i:i.i + m.m - 1], ' ') AS phrase, max(q.f) AS around
  FROM word q JOIN (VALUES (2), (3)) m(m) ON m.m < q.k JOIN (VALUES (1), (2), (3)) i(i) ON i.i + m.m - 1 <= q.k GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.k = b.k AND s.phrase = b.phrase
  WHERE s.around IS NULL OR 100 * s.around < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""


@query
def op1_entropy_mix(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.mix(table(spark, d, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query
def op4_shard_best_fit(spark: SparkSession, d: str) -> DataFrame:
    out = sharding.shard(table(spark, d, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_pack_best_fit(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), tokenizer_path("word_bpe_49k.json"))


def remainder(key: str, by: int):
    """crc32 of the key as text, modulo ``by``."""
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % by


@query
def op2_ppm_score(spark: SparkSession, d: str) -> DataFrame:
    return ppm.score(table(spark, d, "documents"), remainder("doc_id", 5) == 1)


@query
def op6_langid(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(table(spark, d, "documents"), remainder("doc_id", 3) == 1, tokenizer_path("piece_bpe_32k.model"))


@query
def op3_mcd_rules(spark: SparkSession, d: str) -> DataFrame:
    return outliers.rules(table(spark, d, "documents"))


@query
def op9_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.join(table(spark, d, "documents"))


@query
def op5_html_main_text(spark: SparkSession, d: str) -> DataFrame:
    return html.extract(table(spark, d, "pages"))


@query
def op10_pivot_near_dup(spark: SparkSession, d: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, d, "embeddings"))


@query
def op8_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.manifest(table(spark, d, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                           suspect={"text": F.translate("text", *LOWER)}, where=remainder("doc_id", 3) == 0)


@query
def op12_huffman_ids(spark: SparkSession, d: str) -> DataFrame:
    return huffman.round_trip(table(spark, d, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op13_setm_phrases(spark: SparkSession, d: str) -> DataFrame:
    return phrases.mine(table(spark, d, "documents"))
