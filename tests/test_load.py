"""First wins, insert-if-absent, errors, reconciliation, manifests, running totals."""

import random

import pytest
from conftest import RUN_ID, csv_text, record
from pyspark.sql import functions as F

from feedgate.operators import errors, load, reconcile, running
from feedgate.contract import Field, TableContract
from feedgate.plans.employee import EMPLOYEE
from feedgate.session import bucket_session
from feedgate.sources import csv_feed, manifest, target
from feedgate.sources.inventory import FeedError, feed_inventory, file_format, inventory_summary
from feedgate.sinks import target_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """20,000 rows; one key and one file hold more than a third of them."""
    return spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
        .alias("key"),
        F.when(F.col("id") % 3 == 0, "f0").otherwise(F.concat(F.lit("f"), F.col("id") % 7)).alias("file"),
        F.col("id").alias("at"),
    )


def test_first_wins_with_a_hot_key(hot):
    first = load.first_wins(hot, "key", order=["at"])
    assert "WindowGroupLimit" in plan(first) and "Partial" in plan(first)
    brute = {}
    for row in hot.orderBy("at").collect():
        brute.setdefault(row.key, row.at)
    assert {r.key: r["at"] for r in first.collect()} == brute


def test_new_rows(hot, spark):
    stored = spark.createDataFrame([("hot",), ("k1",), ("other",)], "key string")
    new = load.new_rows(hot, stored, "key", order=["at"])
    assert "LeftAnti" in plan(new)
    keys = [r.key for r in new.collect()]
    assert len(keys) == len(set(keys)) and not {"hot", "k1", "other"} & set(keys)
    assert set(keys) == {r.key for r in hot.select("key").distinct().collect()} - {"hot", "k1"}


@pytest.mark.parametrize("stored", ["few", "most", "none", "all"])
def test_rows_to_insert_equal_new_rows(hot, spark, tmp_path, stored):
    rows = hot.select("key", F.struct("at").alias("_at"), F.monotonically_increasing_id().alias("id"))
    if stored == "none":
        rows = rows.dropDuplicates(["key"])
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    share = {"few": "hash(key) % 10 = 0", "most": "hash(key) % 10 <> 0", "none": "false", "all": "true"}
    present = rows.select("key").distinct().filter(share[stored])
    keys = load.key_table(rows, "key", "id", F.lit(True))
    found = load.rows_to_insert(spark, rows, keys, present, "key", "id")
    assert found.exceptAll(load.new_rows(rows, present, "key")).isEmpty()
    assert found.count() == rows.select("key").distinct().count() - present.count()
    shown = plan(found)
    assert "Exchange hashpartitioning" not in shown  # the rows themselves do not move


def test_null_keys_are_never_new(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "key string, at int")
    stored = spark.createDataFrame([], "key string")
    assert [r.key for r in load.new_rows(rows, stored, "key", order=["at"]).collect()] == ["a"]


def test_bucketed_target_does_not_move(spark):
    contract = TableContract("b", "id", (Field("id"), Field("name")))
    spark.sql("DROP TABLE IF EXISTS bucketed_target")
    target.ensure_target_table(spark, "bucketed_target", contract, 4)
    target.ensure_target_table(spark, "bucketed_target", contract, 4)

    def rows(session, ids):
        return session.createDataFrame([(str(i), f"n{i}", i) for i in ids], "id string, name string, at int").select(
            "*", F.current_timestamp().alias("ingestion_timestamp"), F.lit(RUN_ID).alias("execution_id"),
            F.lit(None).cast("timestamp").alias("source_creation_time"),
        )

    session = bucket_session(spark, 4)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def new(ids):
        stored = session.table("bucketed_target")
        return load.absent_rows(load.first_wins(rows(session, ids), "id", ["at"]), stored, "id")

    for ids, expected in ((range(50), 50), (range(25, 80), 80), (range(80), 80)):
        target_table.append_bucketed(new(ids), "bucketed_target", contract)
        spark.catalog.refreshTable("bucketed_target")
        assert spark.table("bucketed_target").count() == expected
    shown = plan(new(range(9)))
    below = shown[shown.index("LeftAnti"):]
    (scan,) = [l for l in below.splitlines() if "FileScan" in l]
    assert "Bucketed: true" in scan
    # One exchange only, that of the new rows, with one row per key and task.
    assert below.count("Exchange") == 1 and "WindowGroupLimit" in below
    spark.sql("DROP TABLE bucketed_target")


def test_errors_per_file_and_first_errors(hot):
    failed = hot.select(F.col("file").alias("source_file"), F.struct("at").alias("_at"))
    counts = {r.source_file: r.errors for r in errors.errors_per_file(failed).collect()}
    brute = {}
    for row in hot.collect():
        brute.setdefault(row.file, []).append(row.at)
    assert counts == {f: len(v) for f, v in brute.items()} | {None: 20_000}
    first = errors.first_errors(failed, 5)
    assert "WindowGroupLimit" in plan(first)
    found = {}
    for r in first.collect():
        found.setdefault(r.source_file, []).append(r._at["at"])
    assert {f: sorted(v) for f, v in found.items()} == {f: sorted(v)[:5] for f, v in brute.items()}


def keyed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "employee_id string")


A, B, C = (f"7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f300{i}" for i in range(3))


def report(spark, feed, bad, stored):
    rows = spark.createDataFrame(stored, "employee_id string, execution_id string")
    return reconcile.reconcile(
        reconcile.feed_keys(feed, reconcile.readable_key(EMPLOYEE, F.col("employee_id"))),
        spark.createDataFrame([(i,) for i in range(bad)], "x int"), rows, "employee_id", RUN_ID,
    )


def test_reconcile_passes(spark):
    done = report(spark, keyed(spark, A, B.upper(), "bad"), 1, [(A, "old"), (B, RUN_ID), (C, "old")])
    row = done.first()
    assert row.asDict() == {
        "input_records": 3, "distinct_keys": 2, "duplicates_in_feed": 0, "error_records": 1,
        "matched_records": 2, "new_records": 1, "total_records": 3, "expected_records": 2,
        "existing_records": 1, "accounted_records": 2, "status": "passed",
    }
    reconcile.require_passed(done)


def test_reconcile_mismatch_and_its_cause(spark):
    done = report(spark, keyed(spark, A, A, None), 1, [(A, RUN_ID)])
    assert done.first().status == "mismatch" and done.first().duplicates_in_feed == 1
    with pytest.raises(FeedError, match="1 of 2 loadable rows"):
        reconcile.require_passed(done)


def test_run_summary(spark):
    done = report(spark, keyed(spark, A), 0, [(A, RUN_ID)])
    row = reconcile.run_summary(done, RUN_ID, "in", "json", 2, False).first()
    assert (row.state, row.input_file_count, row.split) == ("success", 2, False)
    assert row.finished_at is not None


def test_manifests(spark, write):
    folder = write("control", {
        "ok.txt": "# c\n! c\n file_name = a.json\nfile_path: data/a.json  \nrecord_count=7\nrecord_count = 6000 \n",
        "missing.txt": "file_name=b.json\nrecord_count=1\n",
        "blank.txt": "file_name=c.json\nfile_path=  \nrecord_count=1\n",
        "word.txt": "file_name=d.json\nfile_path=d\nrecord_count=many\n",
        "minus.txt": "file_name=e.json\nfile_path=e\nrecord_count=-1\n",
    })
    rows = {r.file_name: r for r in manifest.read_manifests(spark, folder).collect()}
    assert rows["a.json"].expected_records == 6000 and rows["a.json"].violation is None
    assert rows["a.json"].file_path == "data/a.json"
    assert rows["b.json"].violation == "file_path is missing in control file"
    assert rows["c.json"].violation == "file_path is missing in control file"
    assert rows["d.json"].violation == "record_count must be a valid number"
    assert rows["e.json"].violation == "record_count cannot be negative"


def test_control_totals(spark):
    announced = spark.createDataFrame(
        [("a", 3, None), ("b", 2, None), ("c", 1, None), ("d", None, "bad")],
        "file_name string, expected_records long, violation string",
    )
    read = spark.createDataFrame([("a", 3), ("b", 1), ("d", 4)], "file_name string, input_records long")
    found = {r.file_name: r.status for r in reconcile.control_totals(announced, read).collect()}
    assert found == {"a": "matched", "b": "mismatch", "c": "missing", "d": "refused"}


def test_inventory(spark, write):
    folder = write("feed", {"b.json": "[]", "a.JSON": "[1]", "c.csv": "x"})
    files = feed_inventory(spark, folder, "json").orderBy("path").collect()
    assert [(f.file_name, f.bytes) for f in files] == [("a.JSON", 3), ("b.json", 2)]
    row = inventory_summary(feed_inventory(spark, folder, "json"), threshold_bytes=2).first()
    assert (row.file_count, row.total_bytes, row.oversized_files) == (2, 5, 1)
    assert file_format("x/Y.CSV") == "csv"
    for name in ("x.xml", "x", "x.json.gz"):
        with pytest.raises(FeedError):
            file_format(name)


@pytest.mark.parametrize("fan", [4, 16, 65_536])
def test_running_total(spark, fan):
    draw = random.Random(2)
    values = {p: draw.randint(0, 9) for p in draw.sample(range(1000), 300)}
    rows = spark.createDataFrame(list(values.items()), "p long, v long")
    found = {
        r.p: r.before for r in running.running_total(rows, "p", F.col("v"), "before", fan).collect()
    }
    total, brute = 0, {}
    for p in sorted(values):
        brute[p] = total
        total += values[p]
    assert found == brute


def test_key_table_hashes_by_order_numbers(spark, write):
    """No sort for first-wins over a feed; the winners are those of the positions."""
    files = {
        f"{name}.csv": csv_text([record(employee_id=f"k{i % 7}", first_name=f"{name}{i}") for i in range(40)])
        for name in "cab"
    }
    feed = csv_feed.read_csv_feed(spark, write("feed", files), EMPLOYEE)
    rows = feed.withColumn("_row_id", F.monotonically_increasing_id())
    path = write("staged", {}) + "/rows"
    rows.write.parquet(path)
    numbered, row_id = load.numbered(spark.read.parquet(path), "_row_id")
    assert row_id == load.ORDER
    keys = load.key_table(numbered, "employee_id", row_id, F.lit(True))
    plan = keys._jdf.queryExecution().executedPlan().toString()
    # Only the ranks of files and blocks are sorted.
    assert "HashAggregate(keys=[employee_id" in plan and "SortAggregate" not in plan and "Sort [employee_id" not in plan
    order = [r[load.ORDER] for r in numbered.orderBy("_at").collect()]
    assert order == sorted(order) and len(set(order)) == 120
    first = numbered.join(keys.select(F.col("first_id").alias(load.ORDER)), load.ORDER).select("first_name").collect()
    assert sorted(r.first_name for r in first) == [f"a{i}" for i in range(7)]


@pytest.mark.parametrize("places", [[(0, 0), (0, 1)], [(1 << 16, 3)], [(5, 1 << 26)]])
def test_order_numbers_or_positions(spark, tmp_path, places):
    """Records of documents and lots; places that do not fit keep the row id."""
    at = "struct<file:string,block:bigint,seq:bigint,pos:int>"
    rows = [((f, b, s, p), i) for i, (f, b, (s, p)) in enumerate((f, b, x) for f in "ab" for b in (0, 90) for x in places)]
    spark.createDataFrame(rows, f"_at {at}, _row_id bigint").write.parquet(str(tmp_path / "r"))
    numbered, row_id = load.numbered(spark.read.parquet(str(tmp_path / "r")), "_row_id")
    assert (row_id == load.ORDER) == (places[0] == (0, 0))
    if row_id == load.ORDER:
        assert [r._row_id for r in numbered.orderBy(load.ORDER).collect()] == list(range(len(rows)))


def test_differing_keys(spark):
    feed = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    target = feed.filter("key not in ('k7', 'k19999')").union(spark.createDataFrame([("new",), (None,), ("k5",)], "key string"))
    found = {tuple(r) for r in reconcile.differing_keys(feed, target, "key").collect()}
    assert found == {("k7", "missing"), ("k19999", "missing"), ("new", "extra")}
    same = reconcile.differing_keys(feed, feed.repartition(5), "key")
    plan = same._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Relation" not in plan and same.count() == 0
    repeated = reconcile.differing_keys(feed.union(feed.limit(10)), feed, "key")
    assert repeated.count() == 0
