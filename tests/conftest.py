import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN_ID = "b81d4f02-6a7c-4e39-8f15-0c2a9d3e7b64"
KEY = "feedgate test key, 32 bytes long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("feedgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from feedgate import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def write(tmp_path):
    """Write feed files: ``write("feed", {"a.csv": text})`` gives the folder."""

    def put(folder, files):
        place = tmp_path / folder
        place.mkdir(exist_ok=True)
        for name, text in files.items():
            (place / name).write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
        return str(place)

    return put


def record(**changes):
    """The canonical valid record; ``None`` removes a field."""
    base = {
        "employee_id": "7d0f1a52-93c4-4e0b-8a6d-2b1c5e9f3000",
        "first_name": "Mira",
        "last_name": "Okafor",
        "email": "mira.okafor@example.com",
        "phone_number": "5550123456",
        "hire_date": "2024-01-15",
        "department": "Research",
        "job_title": "Data Engineer",
        "salary": 64250.00,
        "currency": "USD",
        "employment_status": "ACTIVE",
        "is_active": True,
        "skills": ["SQL", "Scala", "Modelling"],
        "address": {"city": "Porto", "state": "Norte", "country": "Portugal"},
        "emergency_contact": {"name": "Ana Okafor", "relationship": "Sister", "phone": "5550123457"},
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not None}


COLUMNS = [
    "employee_id", "first_name", "last_name", "email", "phone_number", "hire_date",
    "department", "job_title", "salary", "currency", "employment_status", "manager_id",
    "is_active", "skills", "address", "emergency_contact",
]


def csv_text(records, columns=COLUMNS):
    """Records as CSV text: JSON cells quoted, booleans and numbers as text."""
    import csv
    import io
    import json

    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(columns)
    for r in records:
        row = []
        for c in columns:
            v = r.get(c, "")
            if isinstance(v, bool):
                v = str(v).lower()
            elif isinstance(v, list):
                v = "[" + ",".join(v) + "]"
            elif isinstance(v, dict):
                v = json.dumps(v)
            elif isinstance(v, float):
                v = f"{v:.2f}"
            row.append(v)
        writer.writerow(row)
    return out.getvalue()
