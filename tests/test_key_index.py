"""The key index: only files that may hold a key are read, and nothing is lost without it."""

import glob
import os

import pytest
from conftest import KEY, csv_text, record
from pyspark.sql import functions as F

from feedgate.contract import Field, TableContract
from feedgate.operators import load
from feedgate.plans.employee import EMPLOYEE
from feedgate.plans.ingestion import ingest
from feedgate.sources import key_index, target

THING = TableContract("thing", "id", (Field("id"), Field("v")))


@pytest.fixture
def stored(spark, tmp_path):
    """Ten files of a hundred keys each; file k holds the keys of its hundred."""
    path = str(tmp_path / "target")
    target.ensure_target(spark, path, THING)

    def append(first, last):
        rows = spark.range(first, last).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("id"), F.lit("x").alias("v"))
        for f in THING.target_schema.fields[2:]:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        rows.coalesce(1).write.mode("append").parquet(path)

    for k in range(10):
        append(100 * k, 100 * k + 100)
    return path, append


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def held(spark, path, rows):
    found = load.existing_keys(key_index.rows_that_may_match(spark, path, THING, rows), rows, "id")
    return sorted(r.id for r in found.collect())


def test_only_files_that_may_hold_a_key(spark, stored):
    path, _ = stored
    assert key_index.files_to_read(spark, path, keys(spark, "000005"), "id") is None  # no index yet
    assert key_index.refresh(spark, path, THING) == 11  # also the empty first one
    assert key_index.refresh(spark, path, THING) == 0
    some = keys(spark, "000005", "000717", "000718", "new", "000099x", None)
    assert len(key_index.files_to_read(spark, path, some, "id")) == 2
    assert held(spark, path, some) == ["000005", "000717", "000718"]
    assert key_index.files_to_read(spark, path, keys(spark, "zzz"), "id") == []
    assert key_index.files_to_read(spark, path, keys(spark, None), "id") == []
    assert held(spark, path, keys(spark, "zzz")) == []
    # Within the range of a file, but not among its keys: the filter's turn.
    assert key_index.files_to_read(spark, path, keys(spark, "000512a"), "id") == []


def test_stale_missing_and_changed(spark, stored, monkeypatch):
    path, append = stored
    key_index.refresh(spark, path, THING)
    append(5000, 5010)
    some = keys(spark, "005003", "000300")
    assert len(key_index.files_to_read(spark, path, some, "id")) == 2
    assert held(spark, path, some) == ["000300", "005003"]
    # A file of another size than the index knows is read whatever its entry says.
    victim = sorted(glob.glob(f"{path}/part-*.parquet"), key=os.path.getsize)[-1]
    spark.createDataFrame([("000901", "y")], "id string, v string").coalesce(1).write.parquet(f"{path}-one")
    (one,) = glob.glob(f"{path}-one/part-*.parquet")
    os.replace(one, victim)
    crc = os.path.join(os.path.dirname(victim), f".{os.path.basename(victim)}.crc")
    os.replace(os.path.join(os.path.dirname(one), f".{os.path.basename(one)}.crc"), crc)
    assert any(f.endswith(os.path.basename(victim)) for f in key_index.files_to_read(spark, path, keys(spark, "q"), "id"))
    monkeypatch.setattr(key_index, "MAX_KEYS", 1)
    assert key_index.files_to_read(spark, path, some, "id") is None


def test_filters_have_no_false_absence(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(30_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit("x").alias("v"))
    for f in THING.target_schema.fields[2:]:
        rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    rows.repartition(3).write.parquet(path)
    key_index.refresh(spark, path, THING)
    per_file = {os.path.basename(f): spark.read.parquet(f).select("id").limit(5).collect() for f in glob.glob(f"{path}/part-*")}
    for name, some in per_file.items():
        for r in some:
            assert any(f.endswith(name) for f in key_index.files_to_read(spark, path, keys(spark, r.id), "id"))
    absent = spark.range(2000).select(F.concat(F.lit("0-"), F.md5(F.col("id").cast("string"))).alias("id"))
    assert key_index.files_to_read(spark, path, absent.filter("id > '0'"), "id") == []


def test_runs_with_an_index_load_the_same(spark, write, tmp_path):
    first = [record(employee_id=f"7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3{i:03d}") for i in range(6)]
    second = [record(employee_id=f"7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3{i:03d}") for i in range(4, 9)]
    feeds = [write("one", {"a.csv": csv_text(first)}), write("two", {"a.csv": csv_text(second)})]
    counts = []
    for with_index in (False, True):
        place = str(tmp_path / f"target-{with_index}")
        for feed in feeds + feeds[:1]:
            run = ingest(spark, feed, "csv", EMPLOYEE, KEY, place, str(tmp_path / f"errors-{with_index}"), key_index=with_index)
            report = run.report.first()
            counts.append((with_index, report.new_records, report.total_records, report.status))
    assert [c[1:] for c in counts[:3]] == [c[1:] for c in counts[3:]] == [(6, 6, "passed"), (3, 9, "passed"), (0, 9, "passed")]
    assert os.path.isdir(tmp_path / "target-True" / key_index.INDEX)
