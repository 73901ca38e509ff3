"""Training corpus from raw documents: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.

Defined cases: null and empty texts go in the first stage (no language); ids
may be null or repeated, with the same text or another; further columns travel
along; an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import langid, mixing, ngram_join, outliers, packing
from ledgerlens.llm.common import stored
from ledgerlens.llm.queries import remainder, tokenizer_path
from ledgerlens.session import importable_in_workers
from ledgerlens.sources.tables import table

#: a language is accepted at this posterior probability
LEAST_SCORE = 0.5

#: the stages cannot be expressed in SQL; tests hold them against brute force
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or of doubtful language, go."""
    importable_in_workers(spark)
    apply = langid.fit(docs, remainder("doc_id", 3) == 1, tokenizer_path("piece_bpe_32k.model"))
    found = apply(docs.select(F.struct(*docs.columns).alias("row")), text_field="text")
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, and robust outliers of their language and source, go."""
    rows = outliers.measure(docs.select(F.struct(*docs.columns).alias("row")), "row.text", "row.lang", "row.source")
    rows = stored(rows, "pipeline-measured")
    return outliers.judge(rows, outliers.fit(rows)).where("kept").select("row.*")


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast hint for ids after their count was checked."""
    return F.broadcast(ids) if ids.count() <= ngram_join.BROADCAST_ROWS else ids


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that of the smallest id
    (null last), then of the smallest hash of all its columns.  Rows are told
    apart by numbers of their own, so rows that share an id but not a text are
    decided one by one."""
    importable_in_workers(spark)
    rows = stored(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "pipeline-rows")
    found = stored(ngram_join.join(rows.select("row", F.col("doc.text").alias("text")), key="row"), "pipeline-groups")
    order = rows.select("row", F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), F.xxhash64(*(F.col("doc")[c] for c in docs.columns)).alias("hash"))
    alone = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    grouped = found.join(_small(stored(alone.select("component_id"), "pipeline-shared")), "component_id", "left_semi")
    grouped = stored(order.join(_small(stored(grouped.select("row", "component_id"), "pipeline-grouped")), "row"), "pipeline-ordered")
    first = grouped.groupBy("component_id").agg(F.min(F.struct("none", "id", "hash", "row")).alias("first")).select(F.col("first.row").alias("row"))
    gone = grouped.select("row").join(_small(stored(first, "pipeline-first")), "row", "left_anti")
    return rows.join(_small(stored(gone, "pipeline-gone")), "row", "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 4096 tokens."""
    importable_in_workers(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix_sources), ("best-fit packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
