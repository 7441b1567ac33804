"""One ingestion run: read, parse, validate, protect, load, report."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedgate.contract import STAMPS, TableContract
from feedgate.operators import enrich, errors, load, parse, protect, reconcile, validate
from feedgate.plans import splitting
from feedgate.session import bucket_session, configure, work_dir
from feedgate.sinks.error_output import write_errors
from feedgate.sinks.target_table import append_bucketed, append_parquet
from feedgate.sources import csv_feed, json_feed, key_index as indexes, manifest, target as targets
from feedgate.sources.inventory import FeedError, check_feed, file_format


@dataclass(frozen=True)
class Run:
    """What a run left behind."""

    run_id: str
    staged: DataFrame
    report: DataFrame


def annotate(
    spark: SparkSession, path: str, fmt: str, contract: TableContract, **read_options
) -> DataFrame:
    """Feed rows, typed, with the reason why a row cannot be loaded."""
    if fmt == "csv":
        parsed = parse.parse_csv(
            csv_feed.read_csv_feed(spark, path, contract, **read_options), contract
        )
    else:
        parsed = parse.parse_json(
            json_feed.read_json_feed(spark, path, **read_options), contract
        )
    return validate.with_reason(parsed, contract)


def staged_rows(
    annotated: DataFrame, contract: TableContract, run_id: str, key: Column, at: Column | None = None
) -> DataFrame:
    """Every feed row once: a loadable row as it will be stored, an error row as its reason.

    Sensitive values are encrypted here and never stored in the clear; an error row keeps only
    its key.  ``_row_id`` is unique, and lasting once the rows are written.
    """
    loadable = F.col("_reason").isNull()
    stamped = enrich.stamped(annotated, run_id, at)
    blanked = stamped.withColumns(
        {
            f.name: F.when(loadable, F.col(f.name))
            for f in contract.fields
            if f.name != contract.key
        }
    )
    sealed = protect.protected(blanked, contract, key)
    return sealed.select(
        "_source_file",
        "_at",
        "_reason",
        F.monotonically_increasing_id().alias("_row_id"),
        *[load.stored_value(f).alias(f.name) for f in contract.fields],
        *STAMPS.names,
    )


def ingest(
    spark: SparkSession,
    path: str,
    fmt: str,
    contract: TableContract,
    encryption_key: str | bytes,
    target: str,
    error_path: str,
    run_id: str | None = None,
    buckets: int | None = None,
    key_index: bool = False,
    **read_options,
) -> Run:
    """Load a feed into ``target`` and write its errors to ``error_path``.

    The feed is read and parsed once: its rows are staged in a written table below
    ``spark.checkpoint.dir``, and so are its keys; load, error output and report all start from
    there.  That also fixes the cipher texts, which differ each time they are computed, and lets
    the later steps go on after lost executors without parsing again.

    ``target`` is a parquet folder, or with ``buckets`` a catalog table bucketed by key.  One
    writer at a time: neither kind has transactions.  With ``key_index`` a folder has an index of
    its files' keys (:mod:`feedgate.sources.key_index`), and the load looks for stored keys only in
    files that may hold them.
    """
    configure(spark)
    run_id = run_id or enrich.new_run_id()
    files = check_feed(
        spark, path, fmt, read_options.get("glob"), read_options.get("skip_empty", False)
    )

    annotated = annotate(spark, path, fmt, contract, checked=files, **read_options)
    staging = work_dir(spark, f"staged-{contract.name}")
    staged_rows(
        annotated, contract, run_id, protect.key_column(spark, encryption_key)
    ).write.parquet(staging)
    staged = spark.read.parquet(staging)
    ordered, row_id = load.numbered(staged, "_row_id")

    failed = staged.filter(F.col("_reason").isNotNull())
    write_errors(errors.error_records(failed, run_id), error_path, run_id)

    path_of_keys = work_dir(spark, f"keys-{contract.name}")
    load.key_table(ordered, contract.key, row_id, F.col("_reason").isNull()).write.parquet(path_of_keys)
    keys = spark.read.parquet(path_of_keys)

    if buckets:
        targets.ensure_target_table(spark, target, contract, buckets)
        spark.catalog.refreshTable(target)
        session = bucket_session(spark, buckets)
        ordered, row_id = load.numbered(session.read.parquet(staging), "_row_id")
        valid = ordered.filter(F.col("_reason").isNull())
        first = load.rows_to_insert(
            session, valid, session.read.parquet(path_of_keys), None, contract.key, row_id
        )
        rows = load.absent_rows(first, session.table(target), contract.key)
        append_bucketed(rows, target, contract)
        spark.catalog.refreshTable(target)  # written by another session
        after = spark.table(target)
    else:
        targets.ensure_target(spark, target, contract)
        valid = ordered.filter(F.col("_reason").isNull())
        if key_index:
            stored = indexes.rows_that_may_match(spark, target, contract, valid)
        else:
            stored = targets.read_target(spark, target, contract)
        rows = load.rows_to_insert(spark, valid, keys, stored, contract.key, row_id)
        append_parquet(rows.select(*[c.name for c in contract.target_schema]), target)
        if key_index:
            indexes.refresh(spark, target, contract)
        after = targets.read_target(spark, target, contract)

    counts = reconcile.reconcile(keys, failed, after, contract.key, run_id)
    summary = reconcile.run_summary(counts, run_id, path, fmt, files.file_count, False)
    report = work_dir(spark, f"report-{contract.name}")
    summary.write.parquet(report)
    return Run(run_id, staged, spark.read.parquet(report))


def ingest_announced(
    spark: SparkSession,
    control_file: str,
    contract: TableContract,
    encryption_key: str | bytes,
    target: str,
    error_path: str,
    threshold_bytes: int,
    run_id: str | None = None,
    buckets: int | None = None,
    **read_options,
) -> Run:
    """Load the feed file one manifest announces, split first if it exceeds ``threshold_bytes``.

    The report also compares the announced with the read row count.  ``read_options`` are those
    of ``ingest``: JSON lines, headers per file, quoted line breaks.  A folder of several
    manifests is for :func:`ingest_all_announced`.
    """
    configure(spark)
    announced = manifest.read_manifests(spark, control_file, glob="*").take(2)
    if not announced:
        raise FeedError(f"nothing to announce a feed in {control_file}")
    if len(announced) > 1:
        raise FeedError(f"{control_file} holds several manifests: load them with ingest_all_announced")
    return _ingest_one(
        spark, announced[0], contract, encryption_key, target, error_path, threshold_bytes, run_id,
        buckets, read_options,
    )


def ingest_all_announced(
    spark: SparkSession,
    control_folder: str,
    contract: TableContract,
    encryption_key: str | bytes,
    target: str,
    error_path: str,
    threshold_bytes: int,
    buckets: int | None = None,
    csv_options: dict | None = None,
    json_options: dict | None = None,
) -> DataFrame:
    """Load the feeds of all manifests of a folder, one run each, in order of their names.

    One report row per manifest: ``loaded``, or ``refused`` with the reason; a refused one does not
    stop the others.  A run is a series of Spark jobs, so the driver goes through the manifests.
    """
    configure(spark)
    options = {"csv": csv_options or {}, "json": json_options or {}}
    reports = []
    for announced in manifest.read_manifests(spark, control_folder, glob="*").orderBy("manifest").collect():
        label = F.regexp_extract(F.lit(announced.manifest), "([^/]*)$", 1).alias("manifest")
        try:
            chosen = options.get((announced.file_path or "").rsplit(".", 1)[-1].lower(), {})
            run = _ingest_one(
                spark, announced, contract, encryption_key, target, error_path, threshold_bytes, None,
                buckets, chosen,
            )
        except FeedError as problem:
            reports.append(
                spark.range(1).select(label, F.lit("refused").alias("outcome"), F.lit(str(problem)).alias("reason"))
            )
        else:
            outcome = F.lit("loaded").alias("outcome"), F.lit(None).cast("string").alias("reason")
            reports.append(run.report.select(label, *outcome, "*"))
    if not reports:
        raise FeedError(f"no manifests in {control_folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def _ingest_one(
    spark, announced, contract, encryption_key, target, error_path, threshold_bytes, run_id, buckets,
    read_options,
) -> Run:
    if announced.violation:
        raise FeedError(announced.violation)
    fmt = file_format(announced.file_path)
    files = {k: v for k, v in read_options.items() if k in ("glob", "skip_empty")}
    size = check_feed(spark, announced.file_path, fmt, **files).total_bytes
    feed, options = announced.file_path, dict(read_options)
    if size > threshold_bytes:
        feed = work_dir(spark, f"parts-{contract.name}")
        splitting.split_feed(
            spark, announced.file_path, feed, fmt, threshold_bytes,
            layout=read_options.get("layout", "document"), **files,
        )
        options |= {"glob": "part-*", "skip_empty": True}
    run = ingest(
        spark, feed, fmt, contract, encryption_key, target, error_path, run_id, buckets, **options
    )
    expected = F.lit(announced.expected_records).cast("bigint")
    report = run.report.withColumns(
        {
            "input_directory": F.lit(announced.file_path),
            "split": F.lit(size > threshold_bytes),
            "announced_records": expected,
            "announced_status": F.when(F.col("input_records") == expected, "matched").otherwise(
                "mismatch"
            ),
        }
    )
    return replace(run, report=report)
