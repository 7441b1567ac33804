"""Splitting and whole runs."""

import glob
import json
import os

import pytest
from conftest import KEY, RUN_ID, csv_text, record
from pyspark.sql import functions as F

from feedgate import work_dir
from feedgate.operators import protect, readback, reconcile
from feedgate.plans import ingestion, splitting
from feedgate.plans.employee import EMPLOYEE
from feedgate.sources import csv_feed, errors as error_source, json_feed
from feedgate.sources.inventory import FeedError


def people(n, **changes):
    return [
        record(
            employee_id=f"00000000-0000-4000-8000-{i:012d}", first_name=f"Name{i}",
            phone_number=f"{9000000000 + i}", skills=["a", f"s{i}"], **changes,
        )
        for i in range(n)
    ]


def plain(spark, target):
    key = protect.key_column(spark, KEY)
    return readback.records(spark.read.parquet(target), EMPLOYEE, key, "emergency_contact")


# --- splitting ---------------------------------------------------------------------------


def test_split_csv(spark, write, tmp_path):
    lines = ["a,B,\"c \"\"d\"\"\""] + [f'{i:06d},"x, ""{i}""",{"y" * (i % 9)}' for i in range(2000)]
    lines[5] = '#00004, blank at the end ,0123456789'
    folder = write("feed", {"in.csv": "\n".join(lines) + "\n"})
    size = os.path.getsize(f"{folder}/in.csv")
    out = str(tmp_path / "out")
    parts = splitting.split_feed(spark, folder, out, "csv", 8_000, prefix="employees")
    names = sorted(r.file_name for r in parts.collect())
    assert len(names) == -(-size // 8_000)
    assert names[:2] == ["employees_part_001.csv", "employees_part_002.csv"]
    rejoined = []
    for name in names:
        text = open(f"{out}/{name}").read().split("\n")
        assert text[0] == lines[0]
        rejoined += text[1:-1]
    assert rejoined == lines[1:]
    assert max(os.path.getsize(f"{out}/{n}") for n in names) < 8_000 + 200


def test_split_json_array(spark, write, tmp_path):
    made = [{"k": i, "n": 64250.50, "t": 'a}"{', "o": {"z": 1, "a": [1, {"b": None}]}} for i in range(900)]
    folder = write("feed", {"in.json": json.dumps(made)})
    size = os.path.getsize(f"{folder}/in.json")
    out = str(tmp_path / "out")
    parts = splitting.split_feed(spark, folder, out, "json", 9_000, prefix="feed")
    names = [r.file_name for r in parts.orderBy("path").collect()]
    assert len(names) == -(-size // 9_000) and names[0] == "feed_part_001.json"
    back = [e for n in names for e in json.load(open(f"{out}/{n}"))]
    assert back == made
    assert '"n": 64250.5,' in open(f"{out}/{names[0]}").read()
    sizes = [os.path.getsize(f"{out}/{n}") for n in names]
    assert max(sizes) < 1.5 * 9_000


def test_split_json_lines(spark, write, tmp_path):
    lines = [json.dumps({"k": i, "n": "x" * (i % 30)}) for i in range(500)]
    folder = write("feed", {"in.json": "\n".join(lines)})
    out = str(tmp_path / "out")
    parts = splitting.split_feed(spark, folder, out, "json", 3_000, layout="lines", prefix="feed")
    names = sorted(r.file_name for r in parts.collect())
    assert [l for n in names for l in open(f"{out}/{n}").read().splitlines()] == lines


def test_small_feed_is_one_part(spark, write, tmp_path):
    folder = write("feed", {"in.csv": "a,b\n1,2\n"})
    parts = splitting.split_feed(spark, folder, str(tmp_path / "out"), "csv", 1 << 20)
    assert parts.count() == 1


@pytest.mark.parametrize("fmt, text", [("csv", "a,b\n"), ("json", "[]")])
def test_feed_without_records(spark, write, tmp_path, fmt, text):
    folder = write("feed", {f"in.{fmt}": text})
    with pytest.raises(FeedError, match="no records"):
        splitting.split_feed(spark, folder, str(tmp_path / "out"), fmt, 100)


def test_split_leaves_documents_as_they_are(spark, write, tmp_path):
    texts = {"bad.json": '[{"a":1},{"b":2}', "one.json": '{"a": 64250.50}', "many.json": json.dumps([{"a": i} for i in range(99)])}
    folder, out = write("feed", texts), str(tmp_path / "out")
    splitting.split_feed(spark, folder, out, "json", 200)
    def rows(path, glob=None):
        feed = json_feed.read_json_feed(spark, path, glob=glob, skip_empty=True)
        return sorted((r.e or "", r.j or "") for r in feed.select(F.col("_doc_error").alias("e"), F.to_json("record").alias("j")).collect())
    assert rows(out, "part-*") == rows(folder) and len(rows(folder)) == 101
    assert any('"a": 64250.50' in open(f).read() for f in glob.glob(f"{out}/part-*"))


def test_split_keeps_order(spark, write, tmp_path):
    made = [{"k": i, "t": "x" * (i % 40)} for i in range(700)]
    folder = write("feed", {"a.json": json.dumps(made[:300]), "b.json": json.dumps(made[300:])})
    out = str(tmp_path / "out")
    splitting.split_feed(spark, folder, out, "json", 2_000)
    found = [e for f in sorted(glob.glob(f"{out}/part-*")) if os.path.getsize(f) for e in json.load(open(f))]
    assert found == made


def test_split_csv_with_line_breaks_in_cells(spark, write, tmp_path):
    cells = [f"x{i}\n\n  y{i}, \"z\"" if i % 3 else f"plain {i}" for i in range(200)]
    text = "id,body\n" + "".join('%d,"%s"\n' % (i, c.replace('"', '""')) for i, c in enumerate(cells))
    folder, out = write("feed", {"a.csv": text}), str(tmp_path / "out")
    parts = splitting.split_feed(spark, folder, out, "csv", 1_000)
    assert parts.count() > 3
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(out)
    assert {int(r.id): r.body for r in back.collect()} == dict(enumerate(cells))


def test_part_counts(spark):
    files = spark.createDataFrame([("a", 0), ("b", 100), ("c", 101), ("d", 1800)], "f string, bytes long")
    found = {r.f: (r.oversized, r.parts) for r in splitting.needs_split(files, 100).collect()}
    assert found == {"a": (False, 1), "b": (False, 1), "c": (True, 2), "d": (True, 18)}


# --- whole runs --------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_run(spark, write, tmp_path, fmt):
    good, bad = people(40), [record(employee_id="x"), record(first_name="Jo"), record(salary=-5.0)]
    halves = [good[:25] + bad[:2], good[20:] + bad[2:]]
    texts = [csv_text(h) if fmt == "csv" else json.dumps(h) for h in halves]
    folder = write("feed", {f"part{i}.{fmt}": t for i, t in enumerate(texts)})
    target, failed = str(tmp_path / "target"), str(tmp_path / "errors")

    run = ingestion.ingest(spark, folder, fmt, EMPLOYEE, KEY, target, failed)
    stored = plain(spark, target)
    assert stored.count() == 40
    row = stored.filter("first_name = 'Name7'").first()
    assert row.phone_number == "9000000007" and float(row.salary) == 64250 and row.is_active is True
    assert row.emergency_contact.phone == "5550123457" and row.execution_id == run.run_id
    assert row.source_creation_time is not None

    counts = run.report.first()
    assert (counts.input_records, counts.error_records, counts.duplicates_in_feed) == (48, 3, 6)
    assert (counts.new_records, counts.total_records, counts.input_file_count) == (40, 40, 2)
    assert counts.status == "mismatch"  # repeated keys

    lines = error_source.read_error_lines(spark, failed)
    assert {(r.feed_file, r.executionId) for r in lines.collect()} == {
        (f"part0.{fmt}", run.run_id), (f"part1.{fmt}", run.run_id)
    }

    again = ingestion.ingest(spark, folder, fmt, EMPLOYEE, KEY, target, failed)
    lines = error_source.read_error_lines(spark, failed)
    assert {r.execution_id for r in lines.collect()} == {run.run_id, again.run_id}
    assert again.report.first().new_records == 0
    assert spark.read.parquet(target).count() == 40


def test_run_report_passes_and_can_be_required(spark, write, tmp_path):
    folder = write("feed", {"a.json": json.dumps(people(5))})
    run = ingestion.ingest(spark, folder, "json", EMPLOYEE, KEY, str(tmp_path / "t"), str(tmp_path / "e"))
    reconcile.require_passed(run.report)
    assert run.report.first().state == "success"


def test_nothing_written_holds_plain_text(spark, write, tmp_path):
    folder = write("feed", {"a.json": json.dumps(people(5) + [record(first_name="Jo", phone_number="9111111111")])})
    target, failed = str(tmp_path / "target"), str(tmp_path / "errors")
    run = ingestion.ingest(spark, folder, "json", EMPLOYEE, KEY, target, failed, run_id=RUN_ID)
    stored = spark.read.parquet(target).drop("ingestion_timestamp", "source_creation_time")
    staged = run.staged.drop("_at", "_source_file", "ingestion_timestamp", "source_creation_time")
    for df in (stored, staged):
        text = json.dumps([r.asDict(True) for r in df.collect()], default=str)
        assert "900000000" not in text and "9111111111" not in text and "5550123457" not in text
        assert "64250" not in text
    for path in glob.glob(failed + "/**", recursive=True):
        if os.path.isfile(path) and path.endswith(".txt"):
            assert "9111111111" not in open(path).read()


def test_run_into_a_bucketed_table(spark, write, tmp_path):
    spark.sql("DROP TABLE IF EXISTS staff")
    for n, expected in ((10, 10), (15, 15)):
        folder = write(f"feed{n}", {"a.csv": csv_text(people(n))})
        run = ingestion.ingest(
            spark, folder, "csv", EMPLOYEE, KEY, "staff", str(tmp_path / f"e{n}"), buckets=4
        )
        assert spark.table("staff").count() == expected
        reconcile.require_passed(run.report)
    spark.sql("DROP TABLE staff")


def test_split_then_run(spark, write, tmp_path):
    folder = write("feed", {"a.csv": csv_text(people(200))})
    out = str(tmp_path / "parts")
    splitting.split_feed(spark, folder, out, "csv", 10_000)
    run = ingestion.ingest(spark, out, "csv", EMPLOYEE, KEY, str(tmp_path / "t"), str(tmp_path / "e"))
    counts = run.report.first()
    assert counts.status == "passed" and counts.new_records == 200 and counts.input_file_count > 5


@pytest.mark.parametrize("fmt, threshold, split", [("csv", 1 << 20, False), ("csv", 9_000, True),
                                                   ("json", 9_000, True)])
def test_announced_run(spark, write, tmp_path, fmt, threshold, split):
    made = people(120) + [record(employee_id="x")]
    text = csv_text(made) if fmt == "csv" else json.dumps(made)
    feed = write("feed", {f"staff.{fmt}": text, "other.csv": "not\nread\n"})
    control = write("control", {
        "staff.txt": f"file_name=staff.{fmt}\nfile_path={feed}/staff.{fmt}\nrecord_count=121\n"
    })
    run = ingestion.ingest_announced(
        spark, f"{control}/staff.txt", EMPLOYEE, KEY, str(tmp_path / "t"), str(tmp_path / "e"), threshold
    )
    row = run.report.first()
    assert (row.split, row.new_records, row.error_records) == (split, 120, 1)
    assert (row.announced_records, row.announced_status, row.status) == (121, "matched", "passed")
    assert (row.input_file_count > 1) == split


def test_announced_run_refuses(spark, write, tmp_path):
    control = write("control", {
        "count.txt": "file_name=a.csv\nfile_path=/nowhere/a.csv\nrecord_count=x\n",
        "path.txt": "file_name=a.csv\nfile_path=/nowhere/a.csv\nrecord_count=1\n",
        "xml.txt": "file_name=a.xml\nfile_path=/nowhere/a.xml\nrecord_count=1\n",
    })
    for name, message in (("count", "valid number"), ("path", "no feed at"), ("xml", "csv or json")):
        with pytest.raises(FeedError, match=message):
            ingestion.ingest_announced(
                spark, f"{control}/{name}.txt", EMPLOYEE, KEY, str(tmp_path / "t"), str(tmp_path / "e"), 100
            )


def test_round_trip_of_both_formats(spark, write, tmp_path):
    made = people(30)
    targets = []
    for fmt, text in (("csv", csv_text(made)), ("json", json.dumps(made))):
        folder = write(f"feed-{fmt}", {f"a.{fmt}": text})
        targets.append(str(tmp_path / f"t-{fmt}"))
        ingestion.ingest(spark, folder, fmt, EMPLOYEE, KEY, targets[-1], str(tmp_path / f"e-{fmt}"))
    one, two = (
        plain(spark, t).select(
            *[f.name for f in EMPLOYEE.fields if f.kind not in ("json", "decimal")],
            F.col("salary").cast("double").alias("salary"),
            F.to_json("address").alias("address"), F.to_json("emergency_contact").alias("contact"),
        )
        for t in targets
    )
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_work_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(base)
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_no_python_in_the_row_path(spark, write):
    """Reading, parsing and validating run on built-in expressions only."""
    csv = write("c", {"a.csv": csv_text(people(2))})
    doc = write("j", {"a.json": json.dumps(people(2))})
    for path, fmt in ((csv, "csv"), (doc, "json")):
        rows = ingestion.annotate(spark, path, fmt, EMPLOYEE)
        shown = rows._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in shown and "MapInArrow" not in shown and "Exchange" not in shown


def test_pruned_columns_still_report_their_errors(spark, write):
    folder = write("c", {"a.csv": csv_text([record(hire_date="x")])})
    rows = ingestion.annotate(spark, folder, "csv", EMPLOYEE).select("first_name", "_reason")
    assert rows.first()._reason == "Invalid date: x"


def test_feeds_read_alike(spark, write):
    made = people(20)
    docs = json_feed.read_json_feed(spark, write("j", {"a.json": json.dumps(made)})).count()
    rows = csv_feed.read_csv_feed(spark, write("c", {"a.csv": csv_text(made)}), EMPLOYEE).count()
    assert docs == rows == 20
