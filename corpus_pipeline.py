"""A corpus pipeline over ``documents``: five operators of ``feedgate.llm``, each on what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again
as the next one's ``docs``.  All but the last keep the columns of ``docs``, whatever they are.
Null and empty texts, ties and repeated rows are as in the operators' docstrings: they pass the
quality and benchmark stages, have fingerprint 0 in the near-duplicate stage (one such document
stays), and take no part in a mix, which has only words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedgate.llm import decontaminate, hilbert, mixing, quality, simhash
from feedgate.llm.common import staged, table

#: Shards of the finished corpus.
SHARDS = 8


def _kept(docs: DataFrame, operator, column: str, condition) -> DataFrame:
    """The rows for which an operator's added ``column`` meets a condition, with their own columns.

    A column of ``docs`` that has the added one's name stands aside meanwhile.
    """
    aside = f"_own_{column}"
    while aside in docs.columns:
        aside += "_"
    found = operator(docs.withColumnRenamed(column, aside)).filter(condition)
    return found.select(*[F.col(f"`{aside if c == column else c}`").alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good; trained on the labels of documents that are here."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    good = quality.predicted(F.col("score")) == 1
    return _kept(docs, lambda d: quality.score_quality(d, weights), "score", good)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    items = table(spark, sf_dir, "benchmark")
    return _kept(docs, lambda d: decontaminate.find_items(d, items), "items", F.size("items") == 0)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken, up to twice."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents along a Hilbert curve over source, language and size, in shards."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    dims = [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), size]
    ties = [F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.col("doc_id"), size]
    own = [c for c in docs.columns if c not in ("hilbert", "shard", "slot")]
    return hilbert.hilbert_shards(docs.select(*[F.col(f"`{c}`") for c in own]), dims, ties, SHARDS)


STAGES = [
    ("quality", good_quality),
    ("near-duplicates", near_distinct),
    ("benchmarks", without_benchmarks),
    ("mix", mixed),
    ("shards", sharded),
]

#: None: a trained model and XXH64 fingerprints cannot be expressed in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written below ``spark.checkpoint.dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
