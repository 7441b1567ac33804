"""Contracts over the given tables as they are, next to the derived employee feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedgate.contract import Field, Rule, TableContract
from feedgate.functions import rules
from feedgate.plans.feeds import register
from feedgate.session import work_dir
from feedgate.sinks import feed_writer


def _known(name: str, *values: str) -> Rule:
    def violation() -> Column:
        return F.when(
            ~F.col(name).isin(*values), F.concat(F.lit(f"{name} is unknown: "), F.col(name))
        )

    return Rule(f"{name} known", violation)


SHIPMENT = TableContract(
    name="shipment",
    key="shipment_id",
    fields=(
        Field("shipment_id", "uuid"),
        Field("ship_date", "date"),
        Field("net", "decimal"),
        Field("returned", "boolean"),
        Field("status"),
    ),
    rules=(
        rules.key_present("shipment_id"),
        rules.length_between("status", 1, 1),
        _known("status", "O", "F"),
        rules.not_negative("net"),
    ),
)

#: Line items as the text of a feed.  Faults: quantity 13 has no usable key, 27 no usable date,
#: 41 no usable amount; discounted lines above ten per cent have a negative one.
SHIPMENT_FEED = """
select l_orderkey, l_linenumber,
 case when l_quantity = 13 then concat('order ', cast(l_orderkey as varchar(20)))
      else concat('00000000-0000-4000-8', lpad(cast(l_linenumber as varchar(3)), 3, '0'), '-', lpad(cast(l_orderkey as varchar(20)), 12, '0')) end as shipment_id,
 case when l_quantity = 27 then substr(cast(l_shipdate as varchar(30)), 1, 7) else substr(cast(l_shipdate as varchar(30)), 1, 10) end as ship_date,
 case when l_quantity = 41 then concat('USD ', l_returnflag)
      else cast(cast(case when l_discount > 0.09 then -l_quantity else l_quantity end as decimal(12,2)) as varchar(30)) end as net,
 case l_returnflag when 'R' then 'TRUE' when 'A' then 'false' else null end as returned,
 case when l_tax > 0.07 then concat(l_linestatus, '?') else l_linestatus end as status,
 l_suppkey, l_partkey, l_extendedprice, l_returnflag
from lineitem
"""


def shipment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipment feed in the shape of a CSV feed reader; order by part and supplier."""
    register(spark, sf_dir, ["lineitem"])
    return spark.sql(SHIPMENT_FEED).select(
        F.col("l_returnflag").alias("_source_file"),
        F.struct(
            F.col("l_suppkey"), F.col("l_partkey"), F.col("l_extendedprice")
        ).alias("_at"),
        F.lit(None).cast("timestamp").alias("_source_time"),
        *SHIPMENT.columns,
    )


_rendered: dict[tuple[str, str, str], str] = {}


def rendered_shipments(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """The shipment feed as files: ``csv``, ``lines`` (JSON lines) or ``json`` (JSON arrays).

    ``ordered`` are CSV files too, whose order is that of supplier, part and price; ``one`` is a single
    array of all.
    """
    place = (spark.sparkContext.applicationId, sf_dir, layout)
    if place in _rendered:
        return _rendered[place]
    rows = shipment_rows(spark, sf_dir)
    files = max(8, rows.count() // 500_000)
    if layout == "one":
        rows = rows.select(*SHIPMENT.columns)
    elif layout == "ordered":
        # Numbers are sampled, moved and sorted; what they become as text is worked out where it is written.
        order = ["l_suppkey", "l_partkey", "l_extendedprice"]
        used = spark.table("lineitem").select([c for c in spark.table("lineitem").columns if c in SHIPMENT_FEED])
        used.repartitionByRange(files, *order).sortWithinPartitions(*order).createOrReplaceTempView("lineitem_ordered")
        rows = spark.sql(SHIPMENT_FEED.replace("from lineitem", "from lineitem_ordered")).select(*SHIPMENT.columns)
    else:
        rows = rows.select(*SHIPMENT.columns).repartition(files, "shipment_id")
    path = work_dir(spark, f"shipments-{layout}")
    if layout in ("csv", "ordered"):
        feed_writer.write_csv_rows(rows, path)
    else:
        amount = F.when(F.startswith("net", F.lit("USD")), F.concat(F.lit('"'), "net", F.lit('"')))
        members = {
            "shipment_id": F.concat(F.lit('"'), "shipment_id", F.lit('"')),
            "ship_date": F.concat(F.lit('"'), "ship_date", F.lit('"')),
            "net": amount.otherwise(F.col("net")),
            "returned": F.lower("returned"),
            "status": F.concat(F.lit('"'), "status", F.lit('"')),
        }
        text = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), v) for n, v in members.items()])
        elements = rows.select(F.concat(F.lit("{"), text, F.lit("}")).alias("element"))
        if layout == "one":
            # One file has one writer: it gets the text joined already, and only copies it.
            lots = work_dir(spark, "shipment-elements")
            feed_writer.joined_elements(elements).write.parquet(lots)
            elements = spark.read.parquet(lots).coalesce(1)
        write = feed_writer.write_json_lines if layout == "lines" else feed_writer.write_json_arrays
        write(elements, path)
    _rendered[place] = path
    return path


DOCUMENT_RULES = TableContract(
    name="document",
    key="doc_id",
    fields=(Field("doc_id"), Field("text"), Field("lang"), Field("source")),
    rules=(
        rules.key_present("doc_id"),
        rules.length_between("text", 50, 5000),
        _known("lang", "en", "fr", "de"),
        rules.length_between("source", 1, 8),
        rules.email_shape("source"),
    ),
)


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["documents"])
    return spark.table("documents").select(
        F.col("source").alias("_source_file"),
        F.col("doc_id").alias("_at"),
        F.lit(None).cast("timestamp").alias("_source_time"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        "lang",
        "source",
    )

