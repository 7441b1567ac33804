"""Cells of a CSV line and their values by kind."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.functions import decimals, uuids

# One cell with the comma before it: plain text and quoted stretches in any mix.  A quote may
# open in mid-cell, a doubled quote inside stands for one, an open quote runs to the line's end.
# All repetitions are possessive, so a long cell costs neither backtracking nor stack.
CELL = r',([^",]*+(?:"[^"]*+(?:""[^"]*+)*+(?:"|$)[^",]*+)*+)'
QUOTED = r'"([^"]*+(?:""[^"]*+)*+)(?:"|$)'

# A line whose quotes all enclose whole cells.  Spark's CSV parser reads such lines the same way
# and several times faster.
REGULAR_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"(?=,|$)|[^",]*+(?=,|$))'
REGULAR_LINE = rf"^{REGULAR_CELL}(?:,{REGULAR_CELL})*+$"

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def cells(line: Column) -> Column:
    """The raw cells of a line, quotes still on."""
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CELL), F.lit(1))


def unquoted(cell: Column) -> Column:
    """A raw cell without its quotes."""
    return F.replace(F.regexp_replace(cell, QUOTED, "$1"), F.lit('""'), F.lit('"'))


def _cut(lines: DataFrame, width: int) -> DataFrame:
    """Lines with ``_row`` (the first ``width`` cells) where Spark's parser reads them alike, else ``_cells``."""
    # The parser takes 20,480 cells at most, which a shorter line cannot hold, and ends at line breaks
    # and at U+FFFF; before a quote it drops U+0000.
    plain = (F.octet_length("line") < 20_000) & ~F.col("line").rlike("[\n\r\x00\uffff]")
    schema = ", ".join(f"c{i} string" for i in range(width))
    kinds = {"_bare": ~F.contains("line", F.lit('"'))}
    # Without a quote every comma ends a cell.
    kinds["_regular"] = ~kinds["_bare"] & plain & F.col("line").rlike(REGULAR_LINE)
    return lines.withColumns(kinds).withColumns(
        {
            "_row": F.when(F.col("_regular"), F.from_csv("line", schema, {"escape": '"'})),
            "_cells": F.when(F.col("_bare"), F.split("line", ",")).when(~F.col("_regular"), cells(F.col("line"))),
        }
    )


def bound(lines: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """Replace the ``line`` column by the numbered cells, named; empty and absent are NULL."""
    return _cut(lines, max(numbers.values(), default=0) + 1).withColumns(
        {
            name: F.when(F.col("_regular"), F.col("_row")[f"c{i}"])
            .when(F.col("_bare"), F.nullif(F.get("_cells", F.lit(i)), F.lit("")))
            .otherwise(F.nullif(unquoted(F.get("_cells", F.lit(i))), F.lit("")))
            for name, i in numbers.items()
        }
    ).drop("line", "_bare", "_regular", "_row", "_cells")


def values_of(lines: DataFrame, width: int) -> DataFrame:
    """Replace the ``line`` column by ``_values``, the first ``width`` cells without their quotes."""
    whole = F.array(*[F.col("_row")[f"c{i}"] for i in range(width)])
    values = F.when(F.col("_regular"), whole).when(F.col("_bare"), F.col("_cells"))
    values = values.otherwise(F.transform("_cells", unquoted))
    return _cut(lines, width).withColumn("_values", values).drop("line", "_bare", "_regular", "_row", "_cells")


def header_cells(line: str) -> list[str]:
    """The column names of one header line, on the driver."""
    names = []
    for cell in re.findall(CELL, "," + line):
        names.append(re.sub(QUOTED, r"\1", cell).replace('""', '"').strip().lower())
    return names


def _given(raw: Column) -> Column:
    return F.coalesce(raw, F.lit("")) != ""


def text(raw: Column) -> Column:
    """Absent or empty text becomes one blank."""
    return F.when(_given(raw), raw).otherwise(F.lit(" "))


def iso_date(raw: Column) -> Column:
    """``yyyy-MM-dd`` exactly; a plain cast would also take ``2024-1-5`` or a time part."""
    return F.when(raw.rlike(ISO_DATE), raw.try_cast("date"))


def boolean(raw: Column) -> Column:
    return F.when(F.lower(raw) == "true", True).when(F.lower(raw) == "false", False)


def text_list(raw: Column) -> Column:
    """``[a, "b"]`` or ``a,b``: split on commas, one quote off each side, empties dropped."""
    body = F.regexp_replace(F.regexp_replace(_java_trim(raw), r"^\[", ""), r"\]$", "")
    items = F.transform(
        F.split(body, ","),
        lambda item: F.regexp_replace(F.regexp_replace(_java_trim(item), '^"', ""), '"$', ""),
    )
    return F.when(_given(raw), F.filter(items, lambda item: item != "")).otherwise(
        F.array().cast("array<string>")
    )


def json_text(raw: Column) -> Column:
    return F.nullif(raw, F.lit(""))


def _java_trim(value: Column) -> Column:
    return F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def value(kind: str, raw: Column, lenient_uuid: bool = False) -> Column:
    """The typed value of a cell."""
    return {
        "text": text,
        "uuid": lambda c: uuids.canonical(c, lenient_uuid),
        "date": iso_date,
        "decimal": decimals.plain,
        "boolean": boolean,
        "list": text_list,
        "json": json_text,
    }[kind](raw)


#: What a cell that gives no value is called in error rows.
UNUSABLE = {"uuid": "UUID", "date": "date", "decimal": "decimal", "boolean": "boolean"}


def error(kind: str, raw: Column, typed: Column, name: str) -> Column | None:
    """The message if a cell is unusable, None for kinds that take any cell."""
    if kind in UNUSABLE:
        message = F.concat(F.lit(f"Invalid {UNUSABLE[kind]}: "), raw)
        return F.when(_given(raw) & typed.isNull(), message)
    if kind == "json":
        # The value stays out of the message: a JSON column may hold sensitive keys.
        broken = typed.isNotNull() & F.try_parse_json(typed).isNull()
        return F.when(broken, F.lit(f"Invalid JSON in {name}"))
    return None
