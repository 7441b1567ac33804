"""The pipeline: what each stage keeps, by brute force, and awkward documents in all of them."""

import os

import pytest
from llm.conftest import rows_of
from llm.test_simhash import grouped, near, plain_fingerprint
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from feedgate.llm import decontaminate, mixing, quality
from feedgate.llm.common import staged

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def stages_of(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


@given
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, good, distinct, clean, mixed, sharded = stages_of(spark, docs, SF)
    assert all(x.columns == docs.columns for x in (good, distinct, clean, mixed))

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in start.collect()} - {r.doc_id for r in good.collect()}
    assert gone and sum(labels.get(i) == 1 for i in gone) <= 0.05 * len(gone) + 1
    weights = quality.train(start, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {r.doc_id: r.score for r in quality.score_quality(start, weights).collect()}
    assert gone == {i for i, s in scored.items() if s < quality.THRESHOLD}

    prints = {r.doc_id: plain_fingerprint(r.text) for r in good.collect()}
    roots = grouped([(p, p) for p in prints.values()] + near(sorted(set(prints.values()))))
    least = {}
    for i in sorted(prints, reverse=True):
        least[roots[prints[i]]] = i
    assert {r.doc_id for r in distinct.collect()} == set(least.values())

    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in distinct.collect() if any(x in " ".join(r.text.lower().split()) for x in items)}
    assert holds and {r.doc_id for r in clean.collect()} == {r.doc_id for r in distinct.collect()} - holds

    taken = mixing.fair_mix(clean.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))).entries
    want = {r.doc_id: r.copies for r in taken.collect() if r.copies and r["size"]}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == want and max(want.values()) == 2

    assert rows_of(sharded, *docs.columns) == rows_of(mixed, *docs.columns)
    assert {r.shard for r in sharded.collect()} == set(range(corpus_pipeline.SHARDS))


def test_awkward_documents(spark, awkward, tables):
    sf_dir = tables(
        documents=awkward,
        labels=spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, "a line that stands in many documents over and over")], "item_id bigint, text string"),
    )
    *kept, last = stages_of(spark, awkward, sf_dir)
    assert all(x.columns == awkward.columns for x in kept)
    assert last.columns == [*awkward.columns, "hilbert", "shard", "slot"]


def test_nothing(spark, nothing, tables):
    sf_dir = tables(
        documents=nothing,
        labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"),
        benchmark=spark.createDataFrame([], "item_id bigint, text string"),
    )
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


@given
@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") or n == "pipeline"])
def test_registered_on_awkward_tables(spark, awkward, nothing, tables, name):
    """Every query on awkward rows and on empty tables."""
    pages = spark.createDataFrame([(1, None), (2, "http://a.org/x"), (None, "")], "page_id bigint, url string")
    rows = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, "a line that stands in many documents over and over")], "item_id bigint, text string")
    full = tables(documents=rows, labels=labels, benchmark=items, pages=pages)
    got = entry.queries()[name](spark, full)
    if name not in ("op8_bm25_decontaminate", "op12_collocations", "pipeline"):  # these have no row per document
        assert got.count() == (3 if name == "op9_url_templates" else rows.count())
    os.makedirs(f"{full}/none")
    for table, frame in (("documents", rows), ("labels", labels), ("benchmark", items), ("pages", pages)):
        frame.limit(0).write.parquet(f"{full}/none/{table}.parquet")
    assert entry.queries()[name](spark, f"{full}/none").count() == 0
