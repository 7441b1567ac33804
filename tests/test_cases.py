"""The cases of the record tests, each as JSON and as its CSV twin."""

import datetime
import json

import pytest
from conftest import KEY, RUN_ID, csv_text, record
from pyspark.sql import functions as F

from feedgate.operators import enrich, errors, load, parse, protect, validate
from feedgate.plans.employee import EMPLOYEE
from feedgate.sources import csv_feed, json_feed, target


@pytest.fixture(params=["json", "csv"])
def annotated(request, spark, write):
    fmt = request.param

    def run(*records):
        if fmt == "json":
            folder = write("feed", {"test-source.json": json.dumps(list(records))})
            rows = parse.parse_json(json_feed.read_json_feed(spark, folder), EMPLOYEE)
        else:
            folder = write("feed", {"test-source.csv": csv_text(records)})
            rows = parse.parse_csv(csv_feed.read_csv_feed(spark, folder, EMPLOYEE), EMPLOYEE)
        return validate.with_reason(rows, EMPLOYEE)

    run.fmt = fmt
    return run


def test_valid_record(annotated):
    rows = annotated(record())
    (row,) = validate.valid_rows(rows).collect()
    assert row.employee_id == record()["employee_id"]
    assert row.skills == ["SQL", "Scala", "Modelling"]
    assert json.loads(row.address) == record()["address"]
    assert validate.error_rows(rows).count() == 0


def test_bad_key(annotated):
    (row,) = annotated(record(employee_id="id not known")).collect()
    middle = " for field 'employee_id'" if annotated.fmt == "json" else ""
    assert row._parse_error == row._reason == f"Invalid UUID{middle}: id not known"


def test_key_is_folded_to_lower_case(annotated):
    (row,) = annotated(record(employee_id="7D0F1A52-93C4-4E0B-8A6D-2B1C5E9F3000")).collect()
    assert row.employee_id == "7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3000"


def test_date_value(annotated):
    (row,) = annotated(record()).collect()
    assert row.hire_date == datetime.date(2024, 1, 15)


@pytest.mark.parametrize("text", ["2024-02-30", "2024-1-5", " 2024-01-15", "2024-01-15T00:00", "x"])
def test_bad_dates(annotated, text):
    (row,) = annotated(record(hire_date=text)).collect()
    assert row._parse_error.startswith("Invalid date") and row._parse_error.endswith(": " + text)


def test_decimal_by_value(annotated):
    (row,) = annotated(record()).select(F.col("salary").cast("decimal(18,2)")).collect()
    assert row.salary == 64250


def test_null_policy(annotated):
    (row,) = annotated(record(department=None, manager_id=None, skills=None)).collect()
    assert row.department == " " and row.manager_id is None and row.skills == []
    assert row._reason is None


def test_short_name(annotated):
    (row,) = annotated(record(first_name="Jo")).collect()
    assert row._reason == "first_name length 2 not in [3, 15]"


def test_missing_key_parses_and_fails_validation(annotated):
    (row,) = annotated(record(employee_id=None)).collect()
    assert row._parse_error is None
    assert row._reason == "employee_id is null (required primary key)"


def test_all_violations_in_rule_order(annotated):
    (row,) = annotated(record(first_name="Jo", email="bad", currency="US", salary=-1.5)).collect()
    assert row._reason == (
        "first_name length 2 not in [3, 15]; email length 3 not in [13, 30]; "
        "email does not contain '@' and '.'; currency must be exactly 3 characters, got: 2; "
        "salary must be non-negative"
    )


def test_lengths_count_characters(annotated):
    (row,) = annotated(record(first_name="😀" * 15)).collect()
    assert row._reason is None


def test_currency_that_does_not_fit_its_column(annotated):
    (row,) = annotated(record(currency=" USD")).collect()
    assert row._reason == "currency does not fit its 3 character column"
    (kept,) = annotated(record(currency="USD ")).collect()
    assert kept._reason is None


def test_bad_element_does_not_affect_its_neighbours(annotated):
    rows = annotated(record(), record(employee_id="id not known"), record(first_name="Jane"))
    assert validate.valid_rows(rows).count() == 2
    assert validate.error_rows(rows).count() == 1


def test_metadata_and_no_mutation(annotated):
    valid = validate.valid_rows(annotated(record()))
    (row,) = enrich.stamped(valid, RUN_ID).collect()
    assert row.execution_id == RUN_ID
    assert row.ingestion_timestamp is not None and row.source_creation_time is not None
    assert (row.first_name, row.phone_number) == ("Mira", "5550123456")
    with pytest.raises(ValueError):
        enrich.stamped(valid, "run-1")


def test_only_the_contact_phone_is_encrypted(spark, annotated):
    key = protect.key_column(spark, KEY)
    valid = validate.valid_rows(annotated(record()))
    sealed = protect.protected(valid, EMPLOYEE, key)
    (row,) = sealed.select(
        "emergency_contact",
        protect.decrypted(F.get_json_object("emergency_contact", "$.phone"), key).alias("phone"),
    ).collect()
    contact = json.loads(row.emergency_contact)
    assert contact["name"] == "Ana Okafor" and contact["relationship"] == "Sister"
    assert contact["phone"] != "5550123457" and row.phone == "5550123457"


def test_error_record(spark, annotated):
    failed = validate.error_rows(annotated(record(first_name="Jo")))
    records = errors.error_records(failed, RUN_ID)
    assert records.columns == ["execution_id", "source_file", "error_reason", "timestamp"]
    (line,) = errors.error_lines(records).collect()
    parsed = json.loads(line.value)
    assert list(parsed) == ["executionId", "sourceFile", "errorReason", "timestamp"]
    assert parsed["executionId"] == RUN_ID and "test-source" in parsed["sourceFile"]
    assert "\n" not in line.value


def test_error_without_reason(spark):
    failed = spark.createDataFrame([("f", None)], "_source_file string, _reason string")
    (row,) = errors.error_records(failed, RUN_ID).collect()
    assert row.error_reason == "unknown error"


def test_stored_projection(spark, annotated):
    valid = validate.valid_rows(annotated(record(skills=None, currency="USD ")))
    stored = load.target_projection(enrich.stamped(valid, RUN_ID), EMPLOYEE)
    (row,) = stored.collect()
    assert stored.columns == EMPLOYEE.target_schema.names
    typed = target.to_database_types(stored.select(*reversed(stored.columns)), EMPLOYEE)
    assert [(f.name, f.dataType) for f in typed.schema] == [
        (f.name, f.dataType) for f in EMPLOYEE.target_schema
    ]
    assert row.skills is None and row.currency == "USD"
