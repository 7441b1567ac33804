"""Exact duplicates by skew-safe combining: local, per salted digest group, global."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.llm.common import SPACES, staged

#: Ways a group of copies is dealt out before its winners meet.
SALTS = 16


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one blank; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Each row's group of equal normalised texts: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Three combining steps, each grouping by digest *and* content, so rows only meet when their
    whole texts are equal: every task combines its own rows (map-side aggregation), salted groups
    combine the tasks' winners, and the winners of the salts combine globally.  A group of any size
    therefore sends one row per task and salt.  Documents then find their group through a narrow
    key (digest, second hash, length); a key that two contents share stops the job.  That join's
    hot keys are split by adaptive execution.

    Null texts count as empty.  The smallest doc_id stays; null ids stay only where all are null.
    Rows that repeat a doc_id with an equal text are one document and marked alike.  Other columns
    of ``docs`` are ignored; no rows give no rows.
    """
    text = normalised(F.col("text"))
    rows = docs.select("doc_id", text.alias("_text")).withColumn("_sha", F.sha2("_text", 256))
    salted = rows.groupBy("_sha", "_text", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("_salt"))
    winners = salted.agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    groups = (
        winners.groupBy("_sha", "_text")
        .agg(F.min("_first").alias("keep_id"), F.sum("_rows").alias("group_size"))
        .select(*_key(), "keep_id", "group_size")
    )
    unique = groups.groupBy("_sha", "_second", "_length").agg(
        F.count(F.lit(1)).alias("_contents"),
        F.first("keep_id").alias("keep_id"),
        F.first("group_size").alias("group_size"),
    )
    # Written, so that the join below reads plain rows on both sides and hot keys can be split.
    unique = staged(unique, "exact-groups")
    found = rows.select("doc_id", *_key()).join(unique, ["_sha", "_second", "_length"])
    return found.filter(
        F.assert_true(F.col("_contents") == 1, F.lit("two texts share digest, hash and length")).isNull()
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _key() -> list[Column]:
    return ["_sha", F.xxhash64("_text").alias("_second"), F.octet_length("_text").alias("_length")]


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a repeated row stays repeated."""
    groups = exact_groups(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    sha = F.sha2(normalised(F.col("text")), 256)
    kept = groups.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    return docs.join(kept, docs.doc_id.eqNullSafe(F.col("_id")) & (sha == F.col("_sha")), "left_semi")
