"""Raw feed rows -> typed columns and a parse error.

Three projections: raw fields, values, errors.  Each reads only the columns of the one before,
so a field is taken apart once although its value and its error both need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.contract import TableContract
from feedgate.functions import csv_cells, json_fields
from feedgate.functions.barrier import computed_once

ORIGIN = ["_source_file", "_at", "_source_time"]


def _with_error(
    valued: DataFrame,
    contract: TableContract,
    messages: list[Column | None],
    all_errors: bool,
) -> DataFrame:
    present = [m for m in messages if m is not None]
    if not present:
        error = F.lit(None).cast("string")
    elif all_errors:
        error = F.nullif(F.concat_ws("; ", *present), F.lit(""))
    else:
        error = F.coalesce(*present)
    return valued.select(
        *ORIGIN, *contract.columns, computed_once(error).alias("_parse_error")
    )


def _raw(name: str) -> str:
    return f"_raw_{name}"


def parse_csv(feed: DataFrame, contract: TableContract, all_errors: bool = False) -> DataFrame:
    """Type the raw text columns of a CSV feed.

    A row is reported with its first bad field in contract order, or with all of them.
    """
    valued = feed.select(
        *ORIGIN,
        *[F.col(c).alias(_raw(c)) for c in contract.columns],
        *[
            csv_cells.value(f.kind, F.col(f.name), contract.lenient_uuid).alias(f.name)
            for f in contract.fields
        ],
    )
    messages = [
        csv_cells.error(f.kind, F.col(_raw(f.name)), F.col(f.name), f.name)
        for f in contract.fields
    ]
    return _with_error(valued, contract, messages, all_errors)


def parse_json(feed: DataFrame, contract: TableContract, all_errors: bool = False) -> DataFrame:
    """Type the records of a JSON feed; a malformed document is its rows' only error."""
    taken = feed.select(
        *ORIGIN,
        "_doc_error",
        *[
            json_fields.raw(f.kind, F.col("record"), f.name).alias(_raw(f.name))
            for f in contract.fields
        ],
    )
    valued = taken.withColumns(
        {
            f.name: json_fields.value(f.kind, F.col(_raw(f.name)), contract.lenient_uuid)
            for f in contract.fields
        }
    )
    messages = [F.col("_doc_error")] + [
        json_fields.error(f.kind, F.col(_raw(f.name)), F.col(f.name), f.name)
        for f in contract.fields
    ]
    return _with_error(valued, contract, messages, all_errors)
