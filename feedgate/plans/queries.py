"""One query per operator group of the inventory, each over whole given tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedgate.contract import Field, TableContract
from feedgate.functions import csv_cells, decimals, json_fields, uuids
from feedgate.operators import (
    enrich,
    errors,
    load,
    parse,
    protect,
    readback,
    reconcile,
    running,
    validate,
)
from feedgate.plans import feeds, ingestion, splitting, tables
from feedgate.plans.employee import EMPLOYEE
from feedgate.plans.feeds import EARLIER_ID, RENDERED_GLOB, RUN_ID, TEST_KEY, TRACED
from feedgate.session import configure, work_dir
from feedgate.sinks import error_output, feed_writer
from feedgate.sources import csv_feed, csv_records, errors as error_source, inventory, json_feed
from feedgate.sources import key_index, manifest, replay, target

INSTANT = "2024-06-01 12:00:00"
PART_BYTES = 65_536


def _src_row():
    return F.col("src_row").cast("bigint").alias("src_row")


def _instant():
    return F.lit(INSTANT)


# --- feeds in their shapes ---------------------------------------------------------------


def _text_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The employee feed as raw text columns, straight from the tables."""
    return feeds.in_flight(feeds.employee_rows(spark, sf))


def _csv_feed(spark: SparkSession, sf: str, **options) -> DataFrame:
    return csv_feed.read_csv_feed(
        spark, feeds.rendered(spark, sf, "csv"), TRACED, skip_empty=True, **options
    )


def _json_feed(spark: SparkSession, sf: str) -> DataFrame:
    return json_feed.read_json_feed(
        spark, feeds.rendered(spark, sf, "json"), glob=RENDERED_GLOB["json"], skip_empty=True
    )


def _json_lines(spark: SparkSession, sf: str) -> DataFrame:
    return json_feed.read_json_feed(
        spark, feeds.rendered(spark, sf, "lines"), layout="lines", glob=RENDERED_GLOB["lines"],
        skip_empty=True,
    )


def _json_large(spark: SparkSession, sf: str) -> DataFrame:
    return json_feed.read_large_documents(
        spark, feeds.rendered(spark, sf, "json"), -1, RENDERED_GLOB["json"]
    )


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_csv(_text_feed(spark, sf), TRACED)


def _annotated(spark: SparkSession, sf: str) -> DataFrame:
    return validate.with_reason(_parsed(spark, sf), TRACED)


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return validate.valid_rows(_annotated(spark, sf))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    return _error_records(_annotated(spark, sf))


def _error_records(annotated: DataFrame) -> DataFrame:
    return errors.error_records(validate.error_rows(annotated), RUN_ID, _instant(), True)


class _Staged:
    """A judged feed, derived once: written with row ids, and its key table."""

    def __init__(self, spark: SparkSession, annotated: DataFrame, key: str):
        self.spark, self.key = spark, key
        rows = _written(annotated.withColumn("_row_id", F.monotonically_increasing_id()), "feed")
        self.rows, self.row_id = load.numbered(rows, "_row_id")
        self.valid = validate.valid_rows(self.rows)
        loadable = F.col("_reason").isNull()
        self.keys = _written(load.key_table(self.rows, key, self.row_id, loadable), "keys")

    def new_rows(self, target: DataFrame | None = None) -> DataFrame:
        """The first loadable row of each key, and with a target only of those it lacks."""
        return load.rows_to_insert(self.spark, self.valid, self.keys, target, self.key, self.row_id)

    def stored_before(self) -> DataFrame:
        """A target that holds every third valid row already, from an earlier run."""
        stored = self.new_rows().filter(F.col("src_row").cast("bigint") % 3 == 0)
        return _written(stored.withColumn("execution_id", F.lit(EARLIER_ID)), "stored")

    def stored_after(self) -> DataFrame:
        before = self.stored_before()
        return before.unionByName(self.new_rows(before).withColumn("execution_id", F.lit(RUN_ID)))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _staged(spark: SparkSession, sf: str) -> _Staged:
    return _Staged(spark, _annotated(spark, sf), EMPLOYEE.key)


def _plain(rows: DataFrame) -> DataFrame:
    """Typed rows in comparable types: lists joined, JSON by its members."""
    contact = readback.contact(F.col("emergency_contact"))
    return rows.select(
        _src_row(),
        *[c for c in TRACED.columns[:13] if c != "salary"],
        decimals.as_decimal(F.col("salary"), "decimal(18,2)").alias("salary"),
        F.array_join("skills", "|").alias("skills"),
        F.get_json_object("address", "$.city").alias("city"),
        contact["name"].alias("contact_name"),
        contact["phone"].alias("contact_phone"),
        "_parse_error",
    ).withColumnRenamed("_parse_error", "parse_error")


# --- sources and parsing -----------------------------------------------------------------


def feed_inventory(spark: SparkSession, sf: str) -> DataFrame:
    files = inventory.feed_inventory(spark, feeds.rendered(spark, sf, "csv"), "csv")
    header = len(",".join(feeds.csv_header())) + 1
    summary = inventory.inventory_summary(files, threshold_bytes=1 << 40)
    return summary.select(
        (F.col("file_count") > 0).alias("has_files"),
        "oversized_files",
        (F.col("total_bytes") - F.col("file_count") * header).alias("data_bytes"),
    )


def read_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_columns(_csv_feed(spark, sf))


def read_csv_per_file_headers(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_columns(_csv_feed(spark, sf, headers="per_file"))


def _raw_columns(feed: DataFrame) -> DataFrame:
    return feed.select(_src_row(), *feeds.CSV_COLUMNS)


def parse_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(parse.parse_csv(_csv_feed(spark, sf), TRACED))


def parse_json_rows(read: Callable, spark: SparkSession, sf: str) -> DataFrame:
    return _plain(parse.parse_json(read(spark, sf), TRACED))


def _cell_query(columns: dict[str, str], cast: str | None = None) -> Callable:
    """Values and messages of some columns of the text feed, all of one kind."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        out = [_src_row()]
        for name, kind in columns.items():
            value = csv_cells.value(kind, F.col(name))
            error = csv_cells.error(kind, F.col(name), value, name)
            shown = F.array_join(value, "|") if kind == "list" else value
            out.append((shown.try_cast(cast) if cast else shown).alias(name))
            if error is not None:
                out.append(error.alias(f"{name}_error"))
        return _text_feed(spark, sf).select(*out)

    return query


def parse_uuid_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of five short groups, made of customer numbers, in canonical form."""
    feeds.register(spark, sf, ["customer"])
    text = F.concat_ws("-", "c_custkey", "c_nationkey", F.lit("A"), F.lit("00bC"), "c_custkey")
    return spark.table("customer").select(
        "c_custkey",
        uuids.canonical(text, lenient=True).alias("lenient"),
        uuids.canonical(text).alias("strict"),
    )


def parse_decimal_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts with plus signs, leading zeros, bare points and exponents as plain decimals."""
    feeds.register(spark, sf, ["orders"])
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    form = F.col("o_orderkey") % 5
    text = (
        F.when(form == 0, F.concat(F.lit("+00"), cents, F.lit(".50")))
        .when(form == 1, F.concat(F.lit("-"), cents, F.lit("e-2")))
        .when(form == 2, F.concat(F.lit("."), cents, F.lit("E+3")))
        .when(form == 3, F.concat(cents, F.lit(".")))
        .otherwise(F.concat(cents, F.lit("-")))
    )
    return spark.table("orders").select("o_orderkey", decimals.plain(text).alias("amount"))


def csv_cells_of_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document cut as a CSV line; each ``e`` counts as a quote."""
    feeds.register(spark, sf, ["documents"])
    lines = spark.table("documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    quoted = lines.withColumn("line", F.translate("line", "e", '"'))
    plain = F.transform(csv_cells.cells(F.col("line")), csv_cells.unquoted)
    cut = quoted.withColumns({"count": F.size(plain), "digest": F.md5(F.array_join(plain, "\x01"))})
    return csv_cells.bound(cut, {"first": 0, "second": 1, "third": 2})


def parse_first_error(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(_src_row(), F.col("_parse_error").alias("parse_error"))


def parse_all_errors(spark: SparkSession, sf: str) -> DataFrame:
    every = parse.parse_csv(_text_feed(spark, sf), TRACED, all_errors=True)
    return every.select(_src_row(), F.col("_parse_error").alias("parse_errors"))


def json_element_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Bad elements of JSON arrays are errors; their neighbours in the same array load."""
    rows = validate.with_reason(parse.parse_json(_json_feed(spark, sf), TRACED), TRACED)
    return rows.agg(
        F.count("*").alias("elements"),
        F.count("_parse_error").alias("parse_errors"),
        F.count("_reason").alias("errors"),
        F.count_if(F.col("_reason").isNull()).alias("valid"),
    )


def null_policy_csv(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse.parse_csv(_csv_feed(spark, sf), TRACED)
    return _null_policy(parsed)


def null_policy_json(spark: SparkSession, sf: str) -> DataFrame:
    return _null_policy(parse.parse_json(_json_feed(spark, sf), TRACED))


def _null_policy(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count_if(F.col("first_name") == " ").alias("blank_first_names"),
        F.count_if(F.col("department") == " ").alias("blank_departments"),
        F.count_if(F.col("employee_id").isNull()).alias("null_ids"),
        F.count_if(F.col("manager_id").isNull()).alias("null_managers"),
        F.count_if(F.col("salary").isNull()).alias("null_salaries"),
        F.count_if(F.col("is_active").isNull()).alias("null_flags"),
        F.count_if(F.size("skills") == 0).alias("empty_skills"),
        F.count_if(F.col("skills").isNull()).alias("null_skills"),
        F.count_if(F.col("address").isNull()).alias("null_addresses"),
    )


# --- validation, routing, errors ---------------------------------------------------------


def validate_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.with_violations(_parsed(spark, sf), TRACED)
    return rows.select(
        _src_row(),
        F.size("_violations").alias("broken_rules"),
        F.array_join("_violations", "; ").alias("violations"),
    )


def violations_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return validate.violations_by_rule(_parsed(spark, sf), TRACED)


def route_valid(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_annotated(spark, sf).filter(F.col("_reason").isNull())).drop("parse_error")


def route_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(spark, sf).select(
        F.col("_at.seq").alias("src_row"), "execution_id", "source_file", "error_reason",
        "timestamp",
    )


def error_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Errors written as JSON lines, one folder per feed file, and read back."""
    path = work_dir(spark, "errors")
    stamped = _errors(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    error_output.write_errors(stamped, path, RUN_ID)
    return error_source.read_error_lines(spark, path).select(
        "feed_file", "executionId", "sourceFile", "errorReason", "timestamp"
    )


def errors_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Refused rows fetched again from their bytes in the feed files: the same rows, the same reasons."""
    path = feeds.rendered(spark, sf, "csv")
    judged = validate.with_reason(parse.parse_csv(_csv_feed(spark, sf, multiline=True), TRACED), TRACED)
    records = errors.error_records(validate.error_rows(judged), RUN_ID, _instant(), True)
    kept = _written(records, "refused")
    header = csv_feed.first_header(spark, inventory.check_feed(spark, path, "csv", skip_empty=True).first_path)
    again = csv_feed.bind_cells(replay.refused_records(kept), header, TRACED)
    reasons = validate.with_reason(parse.parse_csv(again, TRACED), TRACED)
    return reasons.join(kept.select("_at", "error_reason"), "_at").select(
        _src_row(), F.col("_reason").alias("reason"), (F.col("_reason") == F.col("error_reason")).alias("same_reason")
    )


def errors_per_file(spark: SparkSession, sf: str) -> DataFrame:
    return errors.errors_per_file(_errors(spark, sf))


def first_errors_per_file(spark: SparkSession, sf: str) -> DataFrame:
    return errors.first_errors(_errors(spark, sf), 5).select(
        "source_file", "position", F.col("_at.seq").alias("src_row"), "error_reason"
    )


# --- load --------------------------------------------------------------------------------


def first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return load.first_wins(_valid(spark, sf), EMPLOYEE.key).select(EMPLOYEE.key, _src_row())


def first_wins_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """First line item per return flag: three keys, each with a third of the table."""
    feeds.register(spark, sf, ["lineitem"])
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    first = load.first_wins(spark.table("lineitem"), "l_returnflag", order)
    return first.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    feed = _staged(spark, sf)
    return feed.new_rows(feed.stored_before()).select(EMPLOYEE.key, _src_row())


def rerun_is_noop(spark: SparkSession, sf: str) -> DataFrame:
    feed = _staged(spark, sf)
    return feed.new_rows(_written(feed.stored_after(), "stored")).agg(F.count("*").alias("inserted"))


def insert_with_key_index(spark: SparkSession, sf: str) -> DataFrame:
    """Late orders, a third of them with new keys, into a target of all orders in files by date.

    The key index names the files that may hold one of the keys; no other is opened.
    """
    feeds.register(spark, sf, ["orders"])
    contract = TableContract("order", "id", (Field("id"), Field("day")))
    day = F.col("o_orderdate").cast("string").alias("day")
    orders = spark.table("orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), day)
    stored = orders
    for f in contract.target_schema.fields[2:]:
        stored = stored.withColumn(f.name, F.lit(None).cast(f.dataType))
    place = work_dir(spark, "indexed")
    stored.repartitionByRange(16, "day").write.parquet(place)
    key_index.refresh(spark, place, contract)
    late = orders.filter("day >= '2001-03-01'")
    third = F.substring("id", 2, 20).cast("bigint") % 3 == 0
    feed = _written(late.withColumn("id", F.when(third, F.concat(F.lit("new "), "id")).otherwise(F.col("id"))), "late")
    opened = key_index.files_to_read(spark, place, feed, "id")
    new = load.new_rows(feed, key_index.rows_that_may_match(spark, place, contract, feed), "id", order=["day"])
    return new.select("id", F.lit(len(opened) < 16).alias("fewer_files"))


def matched_keys(spark: SparkSession, sf: str) -> DataFrame:
    feed = _staged(spark, sf)
    matched = reconcile.matched_count(feed.stored_before(), feed.keys, EMPLOYEE.key)
    return reconcile.feed_counts(feed.keys).select("*", matched.scalar().alias("matched_records"))


def stamped_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = enrich.stamped(_valid(spark, sf), RUN_ID, _instant())
    stored = load.target_projection(rows, EMPLOYEE)
    return stored.select(
        "employee_id",
        "first_name",
        "currency",
        F.length("currency").alias("currency_width"),
        F.array_join("skills", "|").alias("skills"),
        F.col("ingestion_timestamp").alias("ingested_at"),
        "execution_id",
    )


# --- reconciliation and reports ----------------------------------------------------------


def stamped_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """A run over files under an identifier of its own: one run, one instant, each row its file's time."""
    valid = validate.valid_rows(validate.with_reason(parse.parse_csv(_csv_feed(spark, sf), TRACED), TRACED))
    rows = _written(enrich.stamped(valid, enrich.new_run_id()).select(
        "execution_id", "ingestion_timestamp", "source_creation_time", F.col("_source_file").alias("file")
    ), "stamped")
    files = inventory.feed_inventory(spark, feeds.rendered(spark, sf, "csv"), "csv").select("file_name", "modified_at")
    named = rows.withColumn("file_name", F.regexp_extract("file", "([^/]*)$", 1)).join(files, "file_name", "left")
    return named.agg(
        F.count("*").alias("rows"), F.count_distinct("execution_id").alias("runs"),
        F.count_distinct("ingestion_timestamp").alias("instants"),
        F.count_if(F.col("source_creation_time") == F.col("modified_at")).alias("rows_with_their_files_time"),
    )


def refusals(spark: SparkSession, sf: str) -> DataFrame:
    """What a run refuses before it starts: no files, empty files, no records, a short key."""
    feeds.register(spark, sf, ["nation"])
    names = spark.table("nation").select(F.col("n_name").alias("line"))
    texts, empty, blank = (work_dir(spark, f"refused-{kind}") for kind in ("texts", "empty", "blank"))
    names.select("line").write.text(texts)
    names.filter("line is null").coalesce(1).write.text(empty)
    feed_writer.write_csv_lines(names.select(F.lit(" ").alias("line")), "id,body", blank)
    calls = {
        "no files": lambda: inventory.check_feed(spark, texts, "csv"),
        "empty file": lambda: inventory.check_feed(spark, empty, "json", "*.txt"),
        "no records": lambda: splitting.split_feed(spark, blank, work_dir(spark, "refused-parts"), "csv", 1 << 20, skip_empty=True),
        "short key": lambda: protect.key_column(spark, "short"),
    }
    found = []
    for case, call in calls.items():
        try:
            call()
            found.append((case, None))
        except ValueError as problem:  # FeedError among them
            found.append((case, re.split(" at |: |, got", str(problem))[0]))
    return spark.createDataFrame(found, "case string, message string")


def _report(spark: SparkSession, sf: str) -> DataFrame:
    feed = _staged(spark, sf)
    return reconcile.reconcile(
        feed.keys, _error_records(feed.rows), feed.stored_after(), EMPLOYEE.key, RUN_ID
    )


def reconcile_differences(spark: SparkSession, sf: str) -> DataFrame:
    """All orders against a target that lacks some and has others besides: exactly those keys."""
    feeds.register(spark, sf, ["orders"])
    feed = spark.table("orders").select(F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("key"))
    extra = spark.table("orders").filter("o_orderkey % 89 = 7").select(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("key"))
    stored = feed.filter("cast(substring(key, 2) as bigint) % 97 <> 5").union(extra)
    return reconcile.differing_keys(feed, stored, "key")


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.run_summary(_report(spark, sf), RUN_ID, "feeds/in", "csv", 4, True).drop(
        "finished_at"
    )


def control_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests written for every feed file - one of them wrong - against the rows read."""
    rows = feeds.employee_rows(spark, sf)
    counts = rows.groupBy("feed_file").agg(F.count("*").alias("n"))
    announced = F.when(F.col("feed_file") == "feed_2", F.col("n") + 1).otherwise(F.col("n"))
    text = F.concat(
        F.lit("# announced\nfile_name = "),
        F.col("feed_file"),
        F.lit("\nfile_path=data/in/"),
        F.col("feed_file"),
        F.lit("\nrecord_count: "),
        F.when(F.col("feed_file") == "feed_3", F.lit("many")).otherwise(
            announced.cast("string")
        ),
    )
    path = work_dir(spark, "manifests")
    (
        counts.select("feed_file", text.alias("value"))
        .write.partitionBy("feed_file")
        .text(path)
    )
    manifests = manifest.read_manifests(spark, f"{path}/feed_file=*")
    read = reconcile.records_per_file(_text_feed(spark, sf))
    return reconcile.control_totals(manifests, read)


# --- split -------------------------------------------------------------------------------


def split_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Part number of every order's line when parts hold 64 KB of text each."""
    feeds.register(spark, sf, ["orders"])
    lines = spark.table("orders").select(
        "o_orderkey",
        F.octet_length(
            F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                        "o_orderstatus", "o_orderpriority")
        ).cast("bigint").alias("bytes"),
    )
    placed = running.running_total(lines, "o_orderkey", F.col("bytes"), "start", fan=1024)
    return placed.select(
        "o_orderkey", "start", (F.floor(F.col("start") / PART_BYTES) + 1).alias("part")
    )


def split_plan_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Parts a split of the documents by text size would give, with rows and bytes of each."""
    feeds.register(spark, sf, ["documents"])
    sized = spark.table("documents").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("bytes")
    )
    placed = running.running_total(sized, "doc_id", F.col("bytes"), "start")
    return (
        placed.groupBy((F.floor(F.col("start") / PART_BYTES) + 1).alias("part"))
        .agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))
    )


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by source as files: bytes, whether above the threshold, number of parts."""
    feeds.register(spark, sf, ["documents"])
    files = spark.table("documents").groupBy(F.col("source").alias("file_name")).agg(
        F.sum(F.octet_length("text")).cast("bigint").alias("bytes")
    )
    return splitting.needs_split(files, PART_BYTES)


def _split(spark: SparkSession, sf: str, layout: str) -> str:
    """The rendered feed in parts: sixteen of them, or more so that none exceeds 128 MB."""
    feed, glob = feeds.rendered(spark, sf, layout), RENDERED_GLOB[layout]
    fmt = "csv" if layout == "csv" else "json"
    total = inventory.check_feed(spark, feed, fmt, glob, skip_empty=True).total_bytes
    out = work_dir(spark, f"parts-{layout}")
    splitting.split_feed(
        spark, feed, out, fmt, min(max(total // 16, 1024), 128 << 20), prefix=None,
        layout="lines" if layout == "lines" else "document", glob=glob, skip_empty=True,
    )
    return out


def split_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_columns(
        csv_feed.read_csv_feed(spark, _split(spark, sf, "csv"), TRACED, skip_empty=True)
    )


def split_json_roundtrip(layout: str, spark: SparkSession, sf: str) -> DataFrame:
    read_back = json_feed.read_json_feed(
        spark, _split(spark, sf, layout), glob="part-*", skip_empty=True,
        layout="lines" if layout == "lines" else "document",
    )
    return _plain(parse.parse_json(read_back, TRACED))


# --- protection and read-back ------------------------------------------------------------


def protect_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    key = protect.key_column(spark, TEST_KEY)
    sealed = protect.protected(_valid(spark, sf), EMPLOYEE, key)
    plain = protect.unprotected(sealed, EMPLOYEE, key)
    return plain.select(
        _src_row(), "phone_number", "salary",
        readback.contact(F.col("emergency_contact"))["phone"].alias("contact_phone"),
    )


def protect_layout(spark: SparkSession, sf: str) -> DataFrame:
    key = protect.key_column(spark, TEST_KEY)
    sealed = _valid(spark, sf).select(
        _src_row(),
        F.col("phone_number").alias("plain"),
        protect.encrypted(F.col("phone_number"), key).alias("text"),
        protect.encrypted(F.col("salary"), key).alias("salary_text"),
    )
    return sealed.select(
        "src_row",
        F.length("text").alias("text_length"),
        F.length(F.unbase64("text")).alias("byte_length"),
        (F.instr("text", "\n") > 0).alias("has_breaks"),
        F.col("salary_text").isNull().alias("salary_absent"),
        (F.col("text") == F.col("plain")).alias("shows_plain"),
    )


def protect_json_key(spark: SparkSession, sf: str) -> DataFrame:
    key = protect.key_column(spark, TEST_KEY)
    sealed = protect.protected(_valid(spark, sf), EMPLOYEE, key)
    before = readback.contact(F.col("emergency_contact"))
    return sealed.select(
        _src_row(),
        before["name"].alias("contact_name"),
        before["relationship"].alias("contact_relationship"),
        before["email"].alias("contact_email"),
        F.length(before["phone"]).alias("phone_text_length"),
        protect.decrypted(before["phone"], key).alias("contact_phone"),
    )


def protect_blank_cipher(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversations encrypted; where blanks stand for the cipher text, nothing is read back."""
    feeds.register(spark, sf, ["conversations"])
    contract = TableContract("turn", "id", (Field("id"), Field("text", protect=True)))
    key = protect.key_column(spark, TEST_KEY)
    blank = F.col("turn") % 3 == 0
    sealed = spark.table("conversations").select(
        "conv_id", "turn", F.when(blank, "  ").otherwise(protect.encrypted(F.col("text"), key)).alias("text")
    )
    return protect.unprotected(sealed, contract, key).select(
        "conv_id", "turn", F.col("text").isNull().alias("absent"), F.md5("text").alias("digest")
    )


def protect_wrong_key(spark: SparkSession, sf: str) -> DataFrame:
    """With another key the tolerant form gives NULL for every value."""
    sealed = protect.protected(_valid(spark, sf), EMPLOYEE, protect.key_column(spark, TEST_KEY))
    other = protect.key_column(spark, TEST_KEY[::-1])
    return sealed.agg(
        F.count("*").alias("rows"),
        F.count(protect.decrypted(F.col("phone_number"), other, strict=False)).alias("readable"),
    )


def _served(stored: DataFrame, key) -> DataFrame:
    return readback.newest_records(stored, EMPLOYEE, key, contact_column="emergency_contact")


def _flat(served: DataFrame, *more: str) -> DataFrame:
    contact = F.col("emergency_contact")
    return served.select(
        *[f.name for f in EMPLOYEE.fields if f.kind in ("text", "uuid", "date", "boolean")],
        F.col("salary").cast("decimal(18,2)").alias("salary"),
        F.array_join("skills", "|").alias("skills"),
        F.try_variant_get("address", "$.city", "string").alias("city"),
        contact["name"].alias("contact_name"),
        contact["phone"].alias("contact_phone"),
        contact["email"].alias("contact_email"),
        "execution_id",
        *more,
    )


def serve_newest_first(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows of two runs and some without a time, decrypted, with their place in the order."""
    key = protect.key_column(spark, TEST_KEY)
    row = F.col("src_row").cast("bigint")
    timed = _staged(spark, sf).new_rows().withColumns(
        {
            "ingestion_timestamp": F.when(row % 10 == 0, F.lit(None))
            .when(row % 2 == 0, F.lit("2024-06-01 12:00:00"))
            .otherwise(F.lit("2024-06-02 12:00:00"))
            .cast("timestamp"),
            "execution_id": F.lit(RUN_ID),
            "source_creation_time": F.lit(None).cast("timestamp"),
        }
    )
    stored = load.target_projection(protect.protected(timed, EMPLOYEE, key), EMPLOYEE)
    served = _served(stored, key).withColumn("_at", F.monotonically_increasing_id())
    flat = _flat(served.withColumn("execution_id", F.col("ingestion_timestamp").cast("string")), "_at")
    # Written as it is served; a row's number is the rows of earlier partitions and its own place.
    flat = _written(flat, "served").withColumn("part", F.shiftright("_at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = flat.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    place = F.col("start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return flat.join(starts, "part").withColumn("place", place).drop("part", "start", "_at")


# --- whole runs --------------------------------------------------------------------------


def _run(spark: SparkSession, sf: str, fmt: str, runs: int = 1) -> tuple[str, ingestion.Run]:
    place, bad = work_dir(spark, "target"), work_dir(spark, "errors")
    options = {"glob": RENDERED_GLOB[fmt], "skip_empty": True}
    for _ in range(runs):
        run = ingestion.ingest(
            spark, feeds.rendered(spark, sf, fmt), fmt, EMPLOYEE, TEST_KEY, place, bad,
            run_id=RUN_ID, **options,
        )
    return place, run


def ingest_run(fmt: str, spark: SparkSession, sf: str) -> DataFrame:
    """Feed files -> encrypted target -> decrypted records."""
    place, _ = _run(spark, sf, fmt)
    stored = spark.read.parquet(place)
    return _flat(_served(stored, protect.key_column(spark, TEST_KEY)))


def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a second run over the same feed: everything is there already."""
    _, run = _run(spark, sf, "csv", runs=2)
    return run.report.select(
        "execution_id", "file_format", "input_records", "error_records", "expected_records",
        "distinct_keys", "duplicates_in_feed", "total_records", "status", "state",
    )


def ingest_staged_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of a run by reason, from its staged rows."""
    _, run = _run(spark, sf, "csv")
    return (
        run.staged.filter(F.col("_reason").isNotNull())
        .groupBy(F.col("_reason").alias("error_reason"))
        .agg(F.count("*").alias("errors"))
    )


def ingest_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs into a table bucketed by key: the second finds every key."""
    table = f"feedgate_{uuid.uuid4().hex}"
    target.ensure_target_table(spark, table, EMPLOYEE, 8, work_dir(spark, "bucketed"))
    for _ in range(2):
        ingestion.ingest(
            spark, feeds.rendered(spark, sf, "csv"), "csv", EMPLOYEE, TEST_KEY, table,
            work_dir(spark, "errors"), run_id=RUN_ID, buckets=8, skip_empty=True,
        )
    return _flat(_served(spark.table(table), protect.key_column(spark, TEST_KEY)))


def ingest_announced(spark: SparkSession, sf: str) -> DataFrame:
    """A run from a manifest that announces one row too many; the feed is split first."""
    folder = f"{work_dir(spark, 'announced')}/staff.csv"
    rows = feeds.employee_rows(spark, sf)
    feed_writer.write_csv_rows(rows.select(*feeds.CSV_COLUMNS), folder)
    size = inventory.check_feed(spark, folder, "csv").total_bytes
    control = work_dir(spark, "control")
    lines = F.concat(
        F.lit(f"file_name=staff.csv\nfile_path={folder}\nrecord_count="),
        (F.count("*") + 1).cast("string"),
    )
    rows.agg(lines.alias("value")).write.text(control)
    run = ingestion.ingest_announced(
        spark, control, EMPLOYEE, TEST_KEY, work_dir(spark, "target"), work_dir(spark, "errors"),
        threshold_bytes=min(max(size // 8, 1024), 128 << 20), run_id=RUN_ID,
    )
    return run.report.select(
        "execution_id", "split", (F.col("input_file_count") > 1).alias("several_parts"),
        "input_records", "error_records", "new_records", "total_records", "distinct_keys",
        "announced_records", "announced_status",
    )


def errors_of_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs write their errors to one folder, the second one twice: each keeps its own."""
    path, stamped = work_dir(spark, "errors"), _errors(spark, sf)
    rows = _written(stamped.withColumn("timestamp", F.col("timestamp").cast("timestamp")), "error-rows")
    for run_id in (EARLIER_ID, RUN_ID, RUN_ID):
        error_output.write_errors(rows.withColumn("execution_id", F.lit(run_id)), path, run_id)
    lines = error_source.read_error_lines(spark, path)
    return lines.groupBy("execution_id", "executionId", "feed_file").agg(F.count("*").alias("errors"))


def ingest_all_announced(spark: SparkSession, sf: str) -> DataFrame:
    """Three manifests of one folder: a CSV feed, a count that is no number, a JSON-lines feed."""
    csv = f"{work_dir(spark, 'announced')}/staff.csv"
    lines = f"{work_dir(spark, 'announced')}/staff.json"
    rows = feeds.employee_rows(spark, sf)
    feed_writer.write_csv_rows(rows.select(*feeds.CSV_COLUMNS), csv)
    feed_writer.write_json_lines(feeds.json_record(rows), f"{lines}-text")
    spark.read.text(f"{lines}-text").write.option("compression", "none").text(lines)
    control = work_dir(spark, "control")
    announced = {"a": (csv, "{n}"), "b": (csv, "about {n}"), "c": (lines, "{n}")}
    for name, (feed, count) in announced.items():
        start, end = count.split("{n}")
        text = F.concat(
            F.lit(f"# announced\nfile_name : staff\nfile_path=\\\n   {feed}\nrecord_count\t= {start}"),
            F.count("*").cast("string"), F.lit(f"{end} \t"),
        )
        rows.agg(text.alias("value")).coalesce(1).write.text(f"{control}/name={name}")
    report = ingestion.ingest_all_announced(
        spark, f"{control}/name=*", EMPLOYEE, TEST_KEY, work_dir(spark, "target"),
        work_dir(spark, "errors"), threshold_bytes=128 << 20, csv_options={"skip_empty": True},
        json_options={"layout": "lines", "glob": "*.txt", "skip_empty": True},
    )
    return report.select(
        "outcome", "reason", "input_records", "new_records", "total_records", "announced_status"
    )


def split_keeps_winners(spark: SparkSession, sf: str) -> DataFrame:
    """Records with few keys: the split array loads the same first record of each as the whole one."""
    feeds.register(spark, sf, ["orders"])
    contract = TableContract("order", "key", (Field("key"), Field("row")))
    members = F.struct(F.concat(F.lit("k"), F.col("o_custkey") % 300).alias("key"), F.col("o_orderkey").alias("row"))
    records = spark.table("orders").repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey")
    whole, parts = work_dir(spark, "whole"), work_dir(spark, "parts")
    feed_writer.write_json_arrays(records.select(F.to_json(members).alias("element")), whole)
    size = inventory.check_feed(spark, whole, "json", "*.txt", skip_empty=True).total_bytes
    splitting.split_feed(
        spark, whole, parts, "json", max(1024, min(size // 20, 128 << 20)), glob="*.txt", skip_empty=True
    )
    loaded = []
    for path in (whole, parts):
        feed = json_feed.read_json_feed(spark, path, glob="part-*", skip_empty=True)
        judged = validate.with_reason(parse.parse_json(feed, contract), contract)
        first = _Staged(spark, judged, "key").new_rows()
        loaded.append(first.select("key", F.col("row").cast("bigint").alias("row")))
    one, two = loaded
    return one.join(two.withColumnRenamed("row", "split_row"), "key", "full")


def documents_any_size(spark: SparkSession, sf: str) -> DataFrame:
    """JSON documents of all kinds read whole, cut at borders, and after a split: the same rows.

    A document holds the customers of one nation; its kind follows from the nation's number.
    """
    feeds.register(spark, sf, ["customer"])
    one = F.to_json(F.struct(F.col("c_custkey").alias("k"), F.struct(F.col("c_name").alias("n")).alias("o")))
    kind = F.col("c_nationkey") % 7
    rows = spark.table("customer").select(
        "c_nationkey", "c_custkey",
        F.when(kind == 1, F.col("c_custkey").cast("string"))
        .when(kind == 2, F.concat(F.lit("["), one, F.lit("]")))
        .when((kind == 3) & (F.col("c_custkey") % 2 == 0), F.lit("null"))
        .otherwise(one).alias("element"),
    )
    # A list of one nation's customers: the documents are as large as the table allows.
    listed = F.array_sort(F.collect_list(F.struct("c_custkey", "element")))["element"]
    inner = F.array_join("elements", ", ")
    kind = F.col("c_nationkey") % 7
    text = (
        F.when(kind == 4, F.concat(F.lit('{"all": ['), inner, F.lit('], "k": -1}')))
        .when(kind == 5, F.concat(F.lit("["), inner, F.lit(", {")))
        .when(kind == 6, F.concat(F.lit("["), inner, F.lit(', {"k": x}]')))
        .otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    )
    documents = rows.groupBy("c_nationkey").agg(listed.alias("elements")).select(
        F.col("c_nationkey").alias("doc"), text.alias("value")
    )
    path, parts = work_dir(spark, "kinds"), work_dir(spark, "kinds-parts")
    documents.write.partitionBy("doc").text(path)
    splitting.split_feed(spark, path, parts, "json", 1 << 14, glob="*.txt", skip_empty=True)
    found = []
    for mode, folder, limit in (("whole", path, 1 << 40), ("cut", path, 0), ("split", parts, None)):
        feed = json_feed.read_json_feed(spark, folder, max_document_bytes=limit, glob="*.txt", skip_empty=True)
        record = F.col("record")
        found.append(
            feed.select(
                F.lit(mode).alias("mode"),
                F.coalesce("_doc_error", F.schema_of_variant(record)).alias("outcome"),
                F.try_variant_get(record, "$.k", "bigint").alias("k"),
            )
        )
    every = found[0].union(found[1]).union(found[2])
    outcome = F.when(F.col("outcome").startswith("OBJECT"), "object").when(
        F.col("outcome").startswith("ARRAY"), "array"
    ).when(F.col("outcome").startswith("Malformed"), "malformed").when(F.col("outcome") == "VOID", "null").otherwise("scalar")
    return every.groupBy("mode", outcome.alias("outcome")).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("k"), F.lit(0)).alias("keys")
    )


def json_nested_array(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in documents that wrap their array twice, parsed whole and cut at record borders."""
    feeds.register(spark, sf, ["orders"])
    documents = 6
    head = '{"meta": {"rows": [0, {"rows": 1}]}, "note": "\\"data\\": {", "data": {"of": "a, b", "rows": [{"k": 0, "t": ""}'
    record = F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.concat(F.lit('[,"]}'), "o_orderpriority").alias("t")))
    rows = spark.table("orders").select(
        F.pmod("o_orderkey", F.lit(documents)).cast("int").alias("doc"), F.col("o_orderkey").alias("at"),
        F.concat(F.lit(", "), record).alias("value"),
    )
    ends = [(d, at, text) for d in range(documents) for at, text in ((-1, head), (1 << 62, '], "more": [1]}, "rows": []}'))]
    rows = rows.union(spark.createDataFrame(ends, "doc int, at bigint, value string"))
    path = work_dir(spark, "nested")
    rows.repartitionById(documents, "doc").sortWithinPartitions("at").select("value").write.text(path)
    found = []
    for mode, limit in (("whole", 1 << 40), ("cut", 0)):
        feed = json_feed.read_json_feed(
            spark, path, max_document_bytes=limit, glob="*.txt", skip_empty=True, inside="data.rows"
        )
        record = F.col("record")
        found.append(feed.select(
            F.lit(mode).alias("mode"), F.col("_doc_error").alias("error"),
            F.try_variant_get(record, "$.k", "bigint").alias("k"), F.try_variant_get(record, "$.t", "string").alias("t"),
        ))
    return found[0].union(found[1])


def amounts_served_exactly(spark: SparkSession, sf: str) -> DataFrame:
    """Long, fine and huge amounts: parsed, encrypted, stored, read back and served as sent."""
    feeds.register(spark, sf, ["orders"])
    contract = TableContract("amount", "id", (Field("id"), Field("amount", "decimal", protect=True)))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    form = F.col("o_orderkey") % 3
    text = (
        F.when(form == 0, F.concat(F.lpad(cents, 30, "7"), F.lit("."), F.lpad(cents, 15, "3")))
        .when(form == 1, F.concat(F.lit("-0."), F.lpad(cents, 15, "0")))
        .otherwise(F.concat(cents, F.lit("e"), F.lit(1000) + F.col("o_orderkey")))
    )
    key = protect.key_column(spark, TEST_KEY)
    feed = spark.table("orders").select(
        F.lit("orders").alias("_source_file"), F.col("o_orderkey").alias("_at"),
        F.lit(None).cast("timestamp").alias("_source_time"),
        F.col("o_orderkey").cast("string").alias("id"), text.alias("amount"),
    )
    judged = validate.with_reason(parse.parse_csv(feed, contract), contract)
    stamped = enrich.stamped(validate.valid_rows(judged), RUN_ID, _instant())
    stored = _written(load.target_projection(protect.protected(stamped, contract, key), contract), "amounts")
    return readback.records(stored, contract, key).select(F.col("id").cast("bigint").alias("id"), "amount")


def split_csv_multiline_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, with their line breaks and blank lines, through a CSV split."""
    path, parts = work_dir(spark, "documents-csv"), work_dir(spark, "documents-parts")
    feed_writer.write_csv_rows(_whole_texts(spark, sf, "documents", "doc_id", "text"), path)
    size = inventory.check_feed(spark, path, "csv", skip_empty=True).total_bytes
    splitting.split_feed(spark, path, parts, "csv", max(1024, min(size // 12, 128 << 20)), skip_empty=True)
    return _digests(
        csv_feed.read_csv_feed(spark, parts, _text_contract(), multiline=True, skip_empty=True)
    )


#: Characters that reading or writing CSV could take for signs of its own.
SIGNS = "\uffff\ufffe\ufdd0\ufdd1\x00"


def csv_any_character(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with odd characters at line starts and inside cells: read, split, and read again."""
    feeds.register(spark, sf, ["documents"])
    sign = F.element_at(F.array(*[F.lit(c) for c in SIGNS]), (F.col("doc_id") % len(SIGNS) + 1).cast("int"))
    flat = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]+", " ")
    rows = spark.table("documents").select("doc_id", sign.alias("sign"), flat.alias("flat"))
    body = F.concat(F.substring("flat", 1, 10), "sign", F.expr("substring(flat, 11)"))
    quoted = F.concat(F.lit('"'), F.replace(body, F.lit('"'), F.lit('""')), F.lit('"'))
    lines = rows.select(F.concat("sign", F.col("doc_id").cast("string"), F.lit(","), quoted).alias("line"))
    path, parts = work_dir(spark, "signs"), work_dir(spark, "signs-parts")
    feed_writer.write_csv_lines(lines, "id,body", path)
    size = inventory.check_feed(spark, path, "csv", skip_empty=True).total_bytes
    splitting.split_feed(spark, path, parts, "csv", max(1024, min(size // 12, 128 << 20)), skip_empty=True)
    found = []
    for mode, folder in (("whole", path), ("split", parts)):
        feed = csv_feed.read_csv_feed(spark, folder, _text_contract(), skip_empty=True)
        found.append(feed.select(
            F.lit(mode).alias("mode"), F.md5("id").alias("id"),
            F.length("body").cast("bigint").alias("characters"), F.md5("body").alias("digest"),
        ))
    return found[0].union(found[1])


def _documents_csv(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Whole documents as CSV files with quoted line breaks, and their bytes."""
    path = work_dir(spark, "documents-csv")
    feed_writer.write_csv_rows(_whole_texts(spark, sf, "documents", "doc_id", "text"), path)
    return path, inventory.check_feed(spark, path, "csv", skip_empty=True).total_bytes


def csv_quoted_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with quoted line breaks, cut in blocks of three sizes."""
    path, size = _documents_csv(spark, sf)
    found = []
    for label, block in (("many", max(1 << 14, size // 60)), ("few", max(1 << 16, size // 5)), ("default", None)):
        records = csv_records.read_records(spark, path, block_bytes=block)
        data = csv_feed.bind_cells(csv_feed.data_records(records, "id,body"), "id,body", _text_contract())
        found.append(_digests(data).withColumn("blocks", F.lit(label)))
    return found[0].union(found[1]).union(found[2])


def split_even_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of very different length split by bytes: no part above the threshold and one record."""
    (path, size), parts = _documents_csv(spark, sf), work_dir(spark, "even-parts")
    threshold = max(1024, min(size // 25, 128 << 20))
    written = splitting.split_feed(spark, path, parts, "csv", threshold, skip_empty=True)
    longest = csv_records.read_records(spark, path).agg(F.max("_bytes").alias("bytes")).scalar()
    above = written.filter(F.col("bytes") > threshold + len("id,body\n") + longest).agg(F.count("*").alias("n"))
    most = written.filter(F.col("bytes") > 0).agg(F.count("*").alias("n"))
    records = csv_records.read_records(spark, parts, "part-*").filter(~F.col("_first"))
    return records.agg(F.count("*").alias("records")).select(
        "records", above.scalar().alias("parts_too_large"),
        (most.scalar() <= -(-size // threshold)).alias("no_more_parts_than_needed"),
    )


# --- the same operators over other tables ------------------------------------------------


def _shipments(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse.parse_csv(tables.shipment_rows(spark, sf), tables.SHIPMENT)
    return validate.with_reason(parsed, tables.SHIPMENT)


def shipments_by_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _shipments(spark, sf)
        .groupBy(F.coalesce(F.col("_reason"), F.lit("valid")).alias("outcome"))
        .agg(F.count("*").alias("rows"))
    )


def shipments_one_array(spark: SparkSession, sf: str) -> DataFrame:
    """All shipments in one JSON array, cut at record borders whatever its size, by outcome."""
    path, contract = tables.rendered_shipments(spark, sf, "one"), tables.SHIPMENT
    feed = json_feed.read_json_feed(spark, path, max_document_bytes=0, glob="*.txt", skip_empty=True)
    outcome = F.coalesce("_reason", F.lit("valid")).alias("outcome")
    judged = validate.with_reason(parse.parse_json(feed, contract), contract)
    return judged.groupBy(outcome).agg(F.count("*").alias("rows"))


def shipments_in_files(layout: str, spark: SparkSession, sf: str) -> DataFrame:
    """Shipments read from CSV files, JSON lines or JSON arrays, by outcome."""
    path, contract = tables.rendered_shipments(spark, sf, layout), tables.SHIPMENT
    if layout == "csv":
        parsed = parse.parse_csv(
            csv_feed.read_csv_feed(spark, path, contract, skip_empty=True), contract
        )
    else:
        feed = json_feed.read_json_feed(
            spark, path, layout="lines" if layout == "lines" else "document",
            glob=RENDERED_GLOB[layout], skip_empty=True,
        )
        parsed = parse.parse_json(feed, contract)
    outcome = F.coalesce("_reason", F.lit("valid")).alias("outcome")
    return (
        validate.with_reason(parsed, contract).groupBy(outcome).agg(F.count("*").alias("rows"))
    )


def shipments_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return validate.violations_by_rule(
        parse.parse_csv(tables.shipment_rows(spark, sf), tables.SHIPMENT), tables.SHIPMENT
    )


def _shipment_files(spark: SparkSession, sf: str) -> _Staged:
    """Shipments from CSV files in feed order, judged."""
    path, contract = tables.rendered_shipments(spark, sf, "ordered"), tables.SHIPMENT
    parsed = parse.parse_csv(csv_feed.read_csv_feed(spark, path, contract, skip_empty=True), contract)
    return _Staged(spark, validate.with_reason(parsed, contract), "shipment_id")


def shipments_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _shipment_files(spark, sf).new_rows().select(
        "shipment_id", "ship_date", decimals.as_decimal(F.col("net"), "decimal(12,2)").alias("net"),
        "returned", "status",
    )


def shipments_new(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments to insert where the finished orders' lines are stored already."""
    feeds.register(spark, sf, ["orders"])
    done = spark.table("orders").filter("o_orderstatus = 'F'")
    lines = F.explode(F.sequence(F.lit(1), F.lit(7))).alias("line")
    key = F.concat(
        F.lit("00000000-0000-4000-8"), F.lpad(F.col("line").cast("string"), 3, "0"), F.lit("-"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
    )
    stored = done.select("o_orderkey", lines).select(key.alias("shipment_id"))
    feed = _shipment_files(spark, sf)
    return feed.new_rows(stored).select("shipment_id", "ship_date", "returned")


def shipment_errors_per_flag(spark: SparkSession, sf: str) -> DataFrame:
    failed = errors.error_records(validate.error_rows(_shipments(spark, sf)), RUN_ID, _instant())
    return errors.errors_per_file(failed)


def shipment_first_errors(spark: SparkSession, sf: str) -> DataFrame:
    failed = errors.error_records(
        validate.error_rows(_shipments(spark, sf)), RUN_ID, _instant(), True
    )
    return errors.first_errors(failed, 5).select(
        "source_file", "position", F.col("_at.l_partkey").alias("l_partkey"), "error_reason"
    )


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse.parse_csv(tables.document_rows(spark, sf), tables.DOCUMENT_RULES)
    return validate.with_reason(parsed, tables.DOCUMENT_RULES)


def document_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("_reason").alias("reason")
    )


def document_first_errors(spark: SparkSession, sf: str) -> DataFrame:
    failed = errors.error_records(validate.error_rows(_documents(spark, sf)), RUN_ID, _instant(), True)
    return errors.first_errors(failed, 5).select(
        "source_file", "position", F.col("_at").alias("doc_id"), "error_reason"
    )


def event_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON records: properties read from their JSON text, type-strict."""
    feeds.register(spark, sf, ["events"])
    record = F.try_parse_json("props")
    sent = F.col("sent")
    k, flag = json_fields.value("decimal", sent), json_fields.value("boolean", sent)
    rows = spark.table("events").select(
        "event_id", json_fields.raw("decimal", record, "k").alias("sent")
    )
    return rows.select(
        "event_id", k.try_cast("int").alias("k"),
        json_fields.error("decimal", sent, k, "k").alias("k_error"),
        flag.alias("flag"),
        json_fields.error("boolean", sent, flag, "k").alias("flag_error"),
    )


def customers_with_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Key matching on the given tables: customers that orders refer to, and the others."""
    feeds.register(spark, sf, ["customer", "orders"])
    customers = spark.table("customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    orders = spark.table("orders").select(F.col("o_custkey").alias("key"))
    absent = load.new_rows(customers, orders, "key", order=["c_mktsegment"])
    matched = reconcile.matched_count(customers, reconcile.feed_keys(orders, F.col("key")), "key")
    return absent.agg(F.count("*").alias("without_orders")).select(
        "without_orders", matched.scalar().alias("with_orders")
    )


def _text_contract() -> TableContract:
    return TableContract("texts", "id", (Field("id"), Field("body")))


def _whole_texts(spark: SparkSession, sf: str, table: str, key: str, body: str) -> DataFrame:
    feeds.register(spark, sf, [table])
    return spark.table(table).select(F.col(key).cast("string").alias("id"), F.col(body).alias("body"))


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").cast("bigint").alias("id"),
        F.length("body").cast("bigint").alias("characters"),
        F.md5("body").alias("digest"),
    )


def documents_csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, with their line breaks, through CSV files and back."""
    path = work_dir(spark, "documents-csv")
    feed_writer.write_csv_rows(_whole_texts(spark, sf, "documents", "doc_id", "text"), path)
    return _digests(
        csv_feed.read_csv_feed(spark, path, _text_contract(), multiline=True, skip_empty=True)
    )


def documents_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents through JSON lines and back."""
    path = work_dir(spark, "documents-json")
    rows = _whole_texts(spark, sf, "documents", "doc_id", "text")
    feed_writer.write_json_lines(rows.select(F.to_json(F.struct("id", "body")).alias("element")), path)
    read = json_feed.read_json_feed(spark, path, layout="lines", glob="*.txt", skip_empty=True)
    return _digests(parse.parse_json(read, _text_contract()))


def pages_json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Whole web pages through JSON arrays, cut at record borders, and back."""
    path = work_dir(spark, "pages-json")
    rows = _whole_texts(spark, sf, "pages", "page_id", "html")
    feed_writer.write_json_arrays(rows.select(F.to_json(F.struct("id", "body")).alias("element")), path)
    read = json_feed.read_large_documents(spark, path, -1, "*.txt")
    return _digests(parse.parse_json(read, _text_contract()))


def conversations_protected(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversation texts encrypted, checked for size, and decrypted."""
    feeds.register(spark, sf, ["conversations"])
    key = protect.key_column(spark, TEST_KEY)
    sealed = spark.table("conversations").select(
        "conv_id", "turn", protect.encrypted(F.col("text"), key).alias("sealed")
    )
    return sealed.select(
        "conv_id", "turn",
        F.length("sealed").alias("sealed_length"),
        F.md5(protect.decrypted(F.col("sealed"), key)).alias("digest"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_inventory": feed_inventory,
    "read_csv_roundtrip": read_csv_roundtrip,
    "read_csv_per_file_headers": read_csv_per_file_headers,
    "parse_csv_rows": parse_csv_rows,
    "parse_json_arrays": partial(parse_json_rows, _json_feed),
    "parse_json_lines": partial(parse_json_rows, _json_lines),
    "parse_json_large_arrays": partial(parse_json_rows, _json_large),
    "parse_uuid": _cell_query({"employee_id": "uuid", "manager_id": "uuid"}),
    "parse_date": _cell_query({"hire_date": "date"}),
    "parse_decimal": _cell_query({"salary": "decimal"}, "decimal(18,2)"),
    "parse_boolean": _cell_query({"is_active": "boolean"}),
    "parse_skills": _cell_query({"skills": "list"}),
    "parse_json_cells": _cell_query({"address": "json", "emergency_contact": "json"}),
    "parse_uuid_lenient": parse_uuid_lenient,
    "parse_decimal_forms": parse_decimal_forms,
    "csv_cells_of_text": csv_cells_of_text,
    "parse_first_error": parse_first_error,
    "parse_all_errors": parse_all_errors,
    "json_element_isolation": json_element_isolation,
    "null_policy_csv": null_policy_csv,
    "null_policy_json": null_policy_json,
    "validate_violations": validate_violations,
    "violations_by_rule": violations_by_rule,
    "route_valid": route_valid,
    "route_errors": route_errors,
    "error_lines": error_lines,
    "errors_replayed": errors_replayed,
    "errors_per_file": errors_per_file,
    "first_errors_per_file": first_errors_per_file,
    "first_wins": first_wins,
    "first_wins_hot_keys": first_wins_hot_keys,
    "insert_if_absent": insert_if_absent,
    "rerun_is_noop": rerun_is_noop,
    "insert_with_key_index": insert_with_key_index,
    "matched_keys": matched_keys,
    "stamped_rows": stamped_rows,
    "stamped_from_files": stamped_from_files,
    "refusals": refusals,
    "reconcile": _report,
    "reconcile_differences": reconcile_differences,
    "run_summary": run_summary,
    "control_totals": control_totals,
    "split_plan": split_plan,
    "split_plan_documents": split_plan_documents,
    "split_counts": split_counts,
    "split_csv_roundtrip": split_csv_roundtrip,
    "split_json_arrays_roundtrip": partial(split_json_roundtrip, "json"),
    "split_json_lines_roundtrip": partial(split_json_roundtrip, "lines"),
    "protect_roundtrip": protect_roundtrip,
    "protect_layout": protect_layout,
    "protect_json_key": protect_json_key,
    "protect_blank_cipher": protect_blank_cipher,
    "protect_wrong_key": protect_wrong_key,
    "serve_newest_first": serve_newest_first,
    "ingest_csv": partial(ingest_run, "csv"),
    "ingest_json": partial(ingest_run, "json"),
    "ingest_bucketed": ingest_bucketed,
    "ingest_announced": ingest_announced,
    "ingest_all_announced": ingest_all_announced,
    "errors_of_two_runs": errors_of_two_runs,
    "split_keeps_winners": split_keeps_winners,
    "documents_any_size": documents_any_size,
    "json_nested_array": json_nested_array,
    "amounts_served_exactly": amounts_served_exactly,
    "split_csv_multiline_roundtrip": split_csv_multiline_roundtrip,
    "csv_any_character": csv_any_character,
    "csv_quoted_blocks": csv_quoted_blocks,
    "split_even_parts": split_even_parts,
    "ingest_report": ingest_report,
    "ingest_staged_errors": ingest_staged_errors,
    "shipments_by_outcome": shipments_by_outcome,
    "shipments_csv_files": partial(shipments_in_files, "csv"),
    "shipments_json_lines": partial(shipments_in_files, "lines"),
    "shipments_json_arrays": partial(shipments_in_files, "json"),
    "shipments_one_array": shipments_one_array,
    "shipments_by_rule": shipments_by_rule,
    "shipments_first_wins": shipments_first_wins,
    "shipments_new": shipments_new,
    "shipment_errors_per_flag": shipment_errors_per_flag,
    "shipment_first_errors": shipment_first_errors,
    "document_reasons": document_reasons,
    "document_first_errors": document_first_errors,
    "event_properties": event_properties,
    "customers_with_orders": customers_with_orders,
    "documents_csv_multiline": documents_csv_multiline,
    "documents_json_lines": documents_json_lines,
    "pages_json_arrays": pages_json_arrays,
    "conversations_protected": conversations_protected,
}


def configured(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run
