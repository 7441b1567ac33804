"""Encryption: layout, tolerance, JSON keys, and that the key and plain text stay hidden."""

import base64
import json
import os
import subprocess
import sys

import pytest
from conftest import KEY
from pyspark.sql import functions as F

from feedgate.contract import Field, TableContract
from feedgate.operators import protect, readback

SECRET = TableContract(
    "s", "id", (Field("id"), Field("pin", protect=True), Field("doc", "json", protect_key="phone"))
)


@pytest.fixture
def key(spark):
    return protect.key_column(spark, KEY)


def rows(spark, *values):
    return spark.createDataFrame([(str(i), *v) for i, v in enumerate(values)], "id string, pin string, doc string")


def test_layout_is_what_the_jdk_reads(spark, key):
    text = "5550123456 é" * 20
    (row,) = rows(spark, (text, None)).select(protect.encrypted(F.col("pin"), key).alias("e")).collect()
    raw = base64.b64decode(row.e, validate=True)
    assert len(raw) == 12 + len(text.encode()) + 16
    jvm = spark.sparkContext._jvm
    cipher = jvm.javax.crypto.Cipher.getInstance("AES/GCM/NoPadding")
    cipher.init(
        2,
        jvm.javax.crypto.spec.SecretKeySpec(bytearray(KEY.encode()), "AES"),
        jvm.javax.crypto.spec.GCMParameterSpec(128, bytearray(raw[:12])),
    )
    assert bytes(cipher.doFinal(bytearray(raw[12:]))).decode() == text


def test_values_come_back_and_nulls_stay(spark, key):
    plain = [("1234", '{"a":1,"phone":"55"}'), (None, None), ("", '{"phone":null}'), ("x", "[1]")]
    sealed = protect.protected(rows(spark, *plain), SECRET, key)
    kept = {r.id: r for r in sealed.collect()}
    assert kept["0"].pin != "1234" and kept["1"].pin is None and kept["1"].doc is None
    assert kept["2"].doc == '{"phone":null}' and kept["3"].doc == "[1]"
    back = {r.id: r for r in protect.unprotected(sealed, SECRET, key).collect()}
    assert back["0"].pin == "1234" and json.loads(back["0"].doc) == {"a": 1, "phone": "55"}
    assert back["1"].pin is None and back["2"].pin == "" and back["3"].pin == "x"


def test_number_as_phone_is_encrypted_as_text(spark, key):
    sealed = protect.protected(rows(spark, ("p", '{"phone":55,"n":[{"phone":1}]}')), SECRET, key)
    (row,) = protect.unprotected(sealed, SECRET, key).collect()
    assert json.loads(row.doc) == {"n": [{"phone": 1}], "phone": "55"}


def test_blank_cipher_text_is_null(spark, key):
    (row,) = protect.unprotected(rows(spark, (" ", "  ")), SECRET, key).collect()
    assert row.pin is None and row.doc is None


@pytest.mark.parametrize("value", ["not base64!", "c2hvcnQ=", base64.b64encode(b"x" * 40).decode()])
def test_unreadable_values(spark, key, value):
    df = rows(spark, (value, None))
    with pytest.raises(Exception):
        df.select(protect.decrypted(F.col("pin"), key)).collect()
    (row,) = df.select(protect.decrypted(F.col("pin"), key, strict=False).alias("x")).collect()
    assert row.x is None


@pytest.mark.parametrize("bad", ["", "short", KEY + "x", "é" * 31])
def test_key_size(spark, bad):
    with pytest.raises(ValueError, match="32 bytes"):
        protect.key_column(spark, bad)


def test_key_is_not_in_the_plan(spark, key):
    sealed = protect.protected(rows(spark, ("1", '{"phone":"2"}')), SECRET, key)
    shown = sealed._jdf.queryExecution().toString()
    assert KEY not in shown
    assert KEY.encode().hex().upper() not in shown.upper()
    assert str(list(KEY.encode()))[1:20] not in shown


def test_contact(spark):
    (row,) = rows(spark, ("1", '{"name":"N","phone":5,"x":1}'), ("2", None)).orderBy("id").limit(1).select(
        readback.contact(F.col("doc")).alias("c")
    ).collect()
    assert row.c.asDict() == {"name": "N", "relationship": None, "phone": "5", "email": None}


def test_newest_first_puts_missing_times_first(spark):
    df = spark.sql(
        "select * from values ('a', timestamp '2024-01-01'), ('b', null), ('c', timestamp '2024-02-01')"
        " as t(id, ingestion_timestamp)"
    )
    assert [r.id for r in readback.newest_first(df, "id").collect()] == ["b", "c", "a"]


def test_rows_are_sorted_before_they_are_decrypted(spark, key):
    sealed = protect.protected(rows(spark, ("1", None), ("2", None)), SECRET, key).selectExpr(
        "*", "current_timestamp() as ingestion_timestamp", "'r' as execution_id",
        "current_timestamp() as source_creation_time",
    )
    served = readback.newest_records(sealed, SECRET, key)
    shown = served._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("aesDecrypt") < shown.index("Sort [")
    assert [r.pin for r in served.collect()] == ["1", "2"]


def test_the_key_is_in_no_event_log(tmp_path):
    """A run with the event log on: neither the key nor its usual spellings are written there."""
    logs, script = tmp_path / "logs", tmp_path / "run.py"
    logs.mkdir()
    script.write_text(f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from feedgate import configure
from feedgate.operators import protect
spark = configure(SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{logs}")
    .config("spark.eventLog.compress", "false").getOrCreate())
key = protect.key_column(spark, {KEY!r})
rows = spark.range(50).select(protect.encrypted(F.concat(F.lit("secret "), "id"), key).alias("c"))
rows.write.parquet("file://{tmp_path}/sealed")
stored = spark.read.parquet("file://{tmp_path}/sealed")
assert stored.filter(protect.decrypted(F.col("c"), key) == "secret 7").count() == 1
spark.stop()
""")
    subprocess.run([sys.executable, str(script)], check=True, timeout=300)
    written = b"".join(p.read_bytes() for p in logs.rglob("*") if p.is_file())
    assert b"SparkListenerSQLExecutionStart" in written
    for spelling in (KEY.encode(), KEY.encode().hex().encode(), KEY.encode().hex().upper().encode(), base64.b64encode(KEY.encode())):
        assert spelling not in written
