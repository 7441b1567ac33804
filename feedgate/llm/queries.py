"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedgate.llm import collocations, decontaminate, exact_dedup, hilbert, language, line_dedup, minhash, mixing
from feedgate.llm import periodic, quality, simhash, token_files, url_filter
from feedgate.llm.common import SPACES, held_out, table

#: The tokenizer of the contract; operators take any path.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Fixed values of the contract: verdict, host, start of the path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dims = [F.col("source"), F.col("lang"), F.col("size")]
    ties = [F.col("text_crc32"), F.col("doc_id"), F.col("size")]
    return hilbert.hilbert_shards(rows, dims, ties, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def op4_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    return mixing.fair_mix(entries).entries.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        quality.predicted(F.col("score")).alias("predicted"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = token_files.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return token_files.read_tokens(parts).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans"
    )


def op8_bm25_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")


def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op10_line_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def _with_periods(docs: DataFrame) -> DataFrame:
    """The contract's text: in a tenth of the documents the words repeat from some word on."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACES), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    tenth = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    tenth = tenth.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    start = F.when(F.col("n") > 0, F.expr("cast(g % n as int)"))
    tenth = tenth.withColumn("a", start).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    text = F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.expr("slice(w, 1, a)"), again), " "))
    return tenth.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
    )))
    return (
        periodic.find_runs(docs).withColumn("longest", longest)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
            F.col("longest.length"), (-F.col("longest.period")).alias("period"),
            F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
            F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_minhash_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert_shards, op2_quality_ftrl, op3_token_files, op4_fair_mix, op5_exact_dedup,
        op6_simhash_golay, op7_language_spans, op8_bm25_decontaminate, op9_url_templates, op10_line_mph,
        op11_periodic_runs, op12_collocations, op13_minhash_postings,
    )
}
