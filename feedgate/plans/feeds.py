"""Feeds derived from the given tables, so that every job has real input to work on.

``EMPLOYEE_FEED`` turns each customer into a feed row and spreads faults over the rows by
modulus.  The text is plain SQL: Spark computes the feed from it, and the oracle starts from
the same rows.  Rows stand in four feed files; one of them holds two fifths.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedgate.contract import Field
from feedgate.plans.employee import EMPLOYEE
from feedgate.session import work_dir
from feedgate.sinks import feed_writer

RUN_ID = "3c9e5a17-4b2d-4f60-9a8e-6d1f0b7c2e45"
EARLIER_ID = "0d7f2c58-91ab-4e63-b5d4-7a0e8c1f9326"
TEST_KEY = "feedgate test key, 32 bytes long"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

EMPLOYEE_FEED = """
select c.c_custkey as src_row,
 concat('feed_', cast(case when c.c_custkey % 5 < 2 then 0 else c.c_custkey % 5 - 1 end as varchar(20))) as feed_file,
 case when c.c_custkey % 17 = 5 then 'id not known' when c.c_custkey % 23 = 7 then null
      else concat('00000000-0000-4000-8000-', lpad(cast(case when c.c_custkey % 41 = 40 then c.c_custkey - 1 else c.c_custkey end as varchar(20)), 12, '0')) end as employee_id,
 case when c.c_custkey % 13 = 3 then null else substr(c.c_mktsegment, 1, cast(2 + c.c_custkey % 9 as int)) end as first_name,
 substr(c.c_name, 1, cast(9 + c.c_custkey % 8 as int)) as last_name,
 case when c.c_custkey % 29 = 11 then 'no-at-sign-here' when c.c_custkey % 31 = 2 then 'a@b.c'
      else concat('user', cast(c.c_custkey as varchar(20)), '@example.com') end as email,
 case when c.c_custkey % 37 = 4 then '12345' else lpad(cast(c.c_custkey as varchar(20)), 10, '9') end as phone_number,
 case when c.c_custkey % 19 = 6 then '2024-02-30' when c.c_custkey % 97 = 8 then '2024-1-5'
      else concat('20', lpad(cast(c.c_custkey % 25 as varchar(2)), 2, '0'), '-0', cast(1 + c.c_custkey % 9 as varchar(2)), '-1', cast(c.c_custkey % 10 as varchar(2))) end as hire_date,
 case when c.c_custkey % 79 = 6 then concat(c.c_mktsegment, ' and ', c.c_mktsegment, ' and more') when c.c_custkey % 7 = 3 then null else c.c_mktsegment end as department,
 case when c.c_custkey % 83 = 7 then concat(n.n_name, ' of the region called ', r.r_name, ' or so') else r.r_name end as job_title,
 case when c.c_custkey % 43 = 9 then 'abc' when c.c_custkey % 101 = 12 then '1,5' when c.c_custkey % 11 = 4 then null
      else cast(cast(c.c_acctbal as decimal(18,2)) as varchar(30)) end as salary,
 case when c.c_custkey % 47 = 1 then 'US' when c.c_custkey % 71 = 3 then ' USD' when c.c_custkey % 73 = 5 then 'USD ' else 'USD' end as currency,
 case when c.c_custkey % 89 = 4 then 'A' when c.c_custkey % 2 = 0 then 'ACTIVE' else 'TERMINATED' end as employment_status,
 case when c.c_custkey % 59 = 3 then 'nobody' when c.c_custkey % 4 = 0 then null
      else concat('00000000-0000-4000-9000-', lpad(cast(c.c_nationkey as varchar(20)), 12, '0')) end as manager_id,
 case c.c_custkey % 3 when 0 then 'true' when 1 then 'FALSE' else case when c.c_custkey % 53 = 2 then 'yes' else null end end as is_active,
 case c.c_custkey % 6 when 0 then null when 1 then '[Scala,"Data Models", SQL ]' when 2 then '["a","b,c",""]'
      when 3 then ' [x ,, y]' when 4 then '[]' else concat(n.n_name, ',', c.c_mktsegment) end as skills,
 case when c.c_custkey % 61 = 8 then '{broken' when c.c_custkey % 5 = 4 then null
      else concat('{"city":"', n.n_name, '","state":"', r.r_name, '"}') end as address,
 case when c.c_custkey % 67 = 9 then 'not json' when c.c_custkey % 7 = 0 then null
      when c.c_custkey % 7 = 1 then '{"name":"X","relationship":"Spouse"}'
      when c.c_custkey % 7 = 2 then '{"name":"Y","phone":null,"relationship":"Friend"}'
      else concat('{"name":"Kin ', cast(c.c_custkey as varchar(20)), '","relationship":"Spouse","phone":"', lpad(cast(c.c_custkey as varchar(20)), 10, '8'), '","email":"k@x.org"}') end as emergency_contact
from customer c
join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
"""

CSV_COLUMNS = (
    "employee_id first_name last_name email phone_number hire_date department job_title salary "
    "currency employment_status manager_id is_active skills address emergency_contact"
).split()


def register(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Make the given parquet tables known by name."""
    for table in tables or TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)


def employee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee feed as text columns plus ``src_row`` and ``feed_file``."""
    register(spark, sf_dir, ["customer", "nation", "region"])
    return spark.sql(EMPLOYEE_FEED)


def in_flight(rows: DataFrame) -> DataFrame:
    """Feed rows in the shape a CSV feed reader gives, without going through files."""
    return rows.select(
        F.col("feed_file").alias("_source_file"),
        F.struct(
            F.col("feed_file").alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            F.col("src_row").alias("seq"),
            F.lit(0).alias("pos"),
        ).alias("_at"),
        F.lit(None).cast("timestamp").alias("_source_time"),
        *CSV_COLUMNS,
        F.col("src_row").cast("string").alias("src_row"),
        "feed_file",
    )


def _as_json(name: str) -> Column:
    """A text column as a JSON string with its quotes and escapes."""
    return F.regexp_extract(F.to_json(F.struct(F.col(name).alias("v"))), r'^\{"v":(.*)\}$', 1)


def _unless(plain: Column, name: str) -> Column:
    """The column's text as it is where ``plain`` holds, else as a JSON string."""
    return F.when(plain, F.col(name)).otherwise(_as_json(name))


def json_record(rows: DataFrame) -> DataFrame:
    """Feed rows as raw JSON texts with JSON types: numbers, booleans, arrays, objects.

    Text that fits no type goes out as a JSON string; NULL columns are left out.
    """
    flag = F.lower("is_active")
    kind = F.col("src_row") % 6
    texts = {c: _as_json(c) for c in (*CSV_COLUMNS, "feed_file")} | {
        "salary": _unless(F.col("salary").rlike(r"^-?\d+\.\d+$"), "salary"),
        "is_active": F.when(flag.isin("true", "false"), flag).otherwise(_as_json("is_active")),
        "skills": F.when(kind == 1, F.lit('["Scala","Data Models","SQL"]'))
        .when(kind == 2, F.lit('["a",5,null,true,{"x":1}]'))
        .when(kind == 3, F.lit('"x, y"'))
        .when(kind == 4, F.lit("[]"))
        .otherwise(F.to_json(F.split("skills", ","))),
        "address": _unless(F.startswith("address", F.lit('{"')), "address"),
        "emergency_contact": _unless(
            F.startswith("emergency_contact", F.lit('{"')), "emergency_contact"
        ),
        "src_row": F.col("src_row").cast("string"),
    }
    members = [
        F.when(F.col(name).isNotNull(), F.concat(F.lit(f'"{name}":'), text))
        for name, text in texts.items()
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return rows.select("src_row", "feed_file", text.alias("element"))


#: Rendered feeds of this session: (application, input folder, layout) -> folder.
_rendered: dict[tuple[str, str, str], str] = {}

#: Text output has no suffix of its own choosing.
RENDERED_GLOB = {"csv": "*.csv", "json": "*.txt", "lines": "*.txt"}


def rendered(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """The employee feed as files: ``csv``, ``json`` (arrays) or ``lines`` (JSON lines).

    Written once per session below the work folder.  The CSV header changes the order and the
    case of the columns, as feeds do; ``src_row`` and ``feed_file`` go along as extra columns.
    """
    place = (spark.sparkContext.applicationId, sf_dir, layout)
    if place in _rendered:
        return _rendered[place]
    # Feed order is file name, then position: sorted rows make that the order of ``src_row``.
    rows = employee_rows(spark, sf_dir)
    rows = rows.repartitionByRange(max(8, rows.count() // 200_000), "src_row").sortWithinPartitions("src_row")
    path = work_dir(spark, f"feed-{layout}")
    if layout == "csv":
        columns = [
            F.col(c).cast("string").alias(c.upper() if i % 2 else c)
            for i, c in enumerate(csv_header())
        ]
        feed_writer.write_csv_rows(rows.select(*columns), path)
    elif layout == "lines":
        feed_writer.write_json_lines(json_record(rows), path)
    else:
        feed_writer.write_json_arrays(json_record(rows).select("element"), path)
    _rendered[place] = path
    return path


def csv_header() -> list[str]:
    return ["src_row", "feed_file", *reversed(CSV_COLUMNS)]


#: The employee contract plus the two columns that tell feed rows apart.
TRACED = replace(
    EMPLOYEE,
    fields=(*EMPLOYEE.fields, Field("src_row"), Field("feed_file")),
)
