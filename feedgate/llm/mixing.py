"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedgate.llm.common import WORDS, in_order, staged, with_running

#: Weights given to the sources in order, again and again.
WEIGHTS = (5, 2, 1)
#: Times a document may be taken.
COPIES = 2


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = 150, copies: int = COPIES) -> DataFrame:
    """``source, source_rank, source_size, source_start, target`` from rows of ``source, size``.

    Sources by code point, null last, weigh ``weights``, repeating, and share ``percent`` of all
    sizes.  A target stops at ``copies`` times its source's size; what is over is shared again by
    weight until none is above.  Sorted by size per weight, the sources that stop are the first
    ones, so one pass of running sums finds the level at which the others share.

    One row per source: a mix is configured per source, so these windows see that list only.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_rank", F.row_number().over(by_name) - 1)
        .withColumn("source_start", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("_weight", F.get(cycle, F.col("source_rank") % len(weights)))
        .withColumn("_cap", F.col("source_size") * copies)
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tight = Window.orderBy(F.col("_cap") / F.col("_weight"), "source_rank")
    fuller = tight.rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("_total") * F.lit(percent) / F.lit(100.0) - F.col("_stopped")
    return (
        sources.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_stopped", F.coalesce(F.sum("_cap").over(fuller), F.lit(0)))
        .withColumn("_left", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(fuller), F.lit(0)))
        .withColumn("_level", share / F.col("_left"))
        # The first source that stays below its cap fixes the level for all after it.
        .withColumn("_level", F.min(F.when(F.col("_level") * F.col("_weight") < F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), F.col("source_rank"), F.col("_level").alias("level")))).over(everything)["level"])
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap").cast("double"))))
        .select("source", "source_rank", "source_size", "source_start", "target")
    )


@dataclass
class Mix:
    """``entries``: each row with ``copies``; ``stream``: the copies taken, in order of ``position``."""

    entries: DataFrame
    stream: DataFrame


def fair_mix(entries: DataFrame, weights=WEIGHTS, percent: int = 150, copies: int = COPIES) -> Mix:
    """Queue shuffled documents fairly and take the first ones up to the budget.

    ``entries`` has ``doc_id, source, size`` (and other columns, which stay).  Within its source
    each document stands in a fixed shuffled order (MD5 of its id), and the whole source follows
    itself ``copies`` times.  The virtual finish time of a copy is the source's size up to and with
    it divided by the source's target.  All copies are range-sorted by finish time and cut where
    their sizes reach the budget, the sum of the targets.

    The running size within a source is the running size in the global order (source, shuffle)
    less the source's start, so a hot source is spread over tasks like any other rows.

    Null sources are one source, the last.  Empty documents have size 0 and take nothing.  Sources
    without words have target 0.  Rows that repeat id, source and size tie and are taken alike;
    a null id is shuffled as ''.  No rows give no rows.
    """
    shuffle = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    entries = entries.withColumn("_shuffle", shuffle)
    order = [F.asc_nulls_last("source"), F.col("_shuffle"), F.col("doc_id"), F.col("size")]
    placed = in_order(entries, order, "mix-queues")
    targets = staged(source_targets(placed.select("source", "size"), weights, percent, copies), "mix-targets")
    queued = with_running(placed, "size", "_running")
    names = [F.col(c) for c in targets.columns if c != "source"]
    queued = queued.join(
        targets.select(F.col("source").alias("_source"), *names), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    queued = staged(queued.withColumn("_running", F.col("_running") - F.col("source_start")), "mix-running")

    each = queued.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    key = ["_finish", "source_rank", "_copy", "_shuffle", "doc_id", "size"]
    times = in_order(each.withColumn("_finish", _finish(F.col("_copy"))), [F.col(c) for c in key], "mix-times")
    budget = targets.agg(F.sum("target")).first()[0] or 0.0  # one number
    stream = with_running(times, "size", "position").filter(F.col("position") <= F.lit(budget))
    last = stream.agg(F.max(F.struct(*key)).alias("last")).first()["last"]  # one row: where the mix ends
    if last is None:
        taken = F.lit(0)
    else:
        schema = times.select(F.struct(*key).alias("k")).schema["k"].dataType
        end = F.struct(*[F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])
        within = [
            F.struct(_finish(F.lit(i)), "source_rank", F.lit(i), "_shuffle", "doc_id", "size") <= end
            for i in range(copies)
        ]
        taken = sum((w.cast("int") for w in within), F.lit(0))
    own = ["_running", "_shuffle", "source_start", "source_rank"]
    return Mix(
        queued.withColumn("copies", taken).drop(*own),
        stream.withColumn("position", F.col("position") - F.col("size")).drop(*own, "_copy", "_finish"),
    )


def _finish(copy: Column) -> Column:
    size = copy * F.col("source_size") + F.col("_running")
    return F.when(F.col("target") > 0, size / F.col("target")).otherwise(F.lit(0.0))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Documents without words are in no mix.  Rows that are equal in every column are taken alike.
    Rows are known by two hashes of 64 bits and their id.
    """
    def free(name: str) -> str:
        while name in docs.columns:
            name += "_"
        return name

    own = [F.col(f"`{c}`") for c in docs.columns]
    row, check, copy = free("_row"), free("_check"), free("_copy")
    rows = docs.withColumns({row: F.xxhash64(*own), check: F.xxhash64(F.lit("check"), *reversed(own))})
    entries = rows.select("source", word_count(F.col("text")).alias("size"), F.col(row).alias("_row"), F.col(check).alias("_check"), "doc_id")
    taken = (
        fair_mix(entries).entries.filter((F.col("copies") > 0) & (F.col("size") > 0))
        .groupBy("_row", "_check", "doc_id").agg(F.max("copies").alias("_copies"))
        .select(F.struct("_row", "_check", "doc_id").alias("k"), F.sequence(F.lit(1), F.col("_copies")).alias("each"))
    )
    # Two hashes and the id; structs are equal where both ids are null.
    same = F.struct(F.col(row).alias("_row"), F.col(check).alias("_check"), F.col("doc_id")).eqNullSafe(taken.k)
    return rows.join(taken, same).withColumn(copy, F.explode(taken.each)).select(*own)
