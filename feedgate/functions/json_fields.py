"""Fields of a JSON record (a variant) and their values by kind.

A variant converts freely between types, so the strict kinds read the field's JSON text, where a
number, a string and a boolean look different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.functions import csv_cells, decimals, uuids


def elements(documents: DataFrame, *columns: str) -> DataFrame:
    """One row (pos, record) per array element in ``records``.

    The outer form, as Spark puts a test for empty arrays below the plain one, and with it a
    second parse of every document.
    """
    rows = documents.select(*columns, F.posexplode_outer("records").alias("pos", "record"))
    return rows.filter(F.col("pos").isNotNull())


def node(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "variant")


def as_text(record: Column, name: str) -> Column:
    """Scalars as text, objects and arrays as empty text, missing and null as NULL."""
    return _scalar_text(F.try_variant_get(record, f"$.{name}", "string"), node(record, name))


def _scalar_text(text: Column, value: Column) -> Column:
    # Only text that looks like a container pays for the type tag.
    suspect = F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("["))
    container = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(suspect, F.when(container, "").otherwise(text)).otherwise(text)


def json_text(record: Column, name: str) -> Column:
    """The field as JSON text, missing and null as NULL."""
    return F.nullif(F.to_json(node(record, name)), F.lit("null"))


def text_list(record: Column, name: str) -> Column:
    """Array elements as text; anything but an array gives an empty list."""
    items = F.transform(
        F.try_variant_get(record, f"$.{name}", "array<variant>"),
        lambda item: F.coalesce(
            _scalar_text(F.try_variant_get(item, "$", "string"), item), F.lit("null")
        ),
    )
    return F.coalesce(items, F.array().cast("array<string>"))


def raw(kind: str, record: Column, name: str) -> Column:
    """The field in the form its kind is read from."""
    if kind in ("decimal", "boolean", "json"):
        return json_text(record, name)
    return text_list(record, name) if kind == "list" else as_text(record, name)


def value(kind: str, sent: Column, lenient_uuid: bool = False) -> Column:
    """The typed value of a field, from its raw form."""
    if kind == "text":
        return F.coalesce(sent, F.lit(" "))
    if kind == "uuid":
        return uuids.canonical(sent, lenient_uuid)
    if kind == "date":
        return csv_cells.iso_date(sent)
    if kind == "decimal":
        return decimals.plain(sent)
    if kind == "boolean":
        return F.when(sent == "true", True).when(sent == "false", False)
    return sent


def error(kind: str, sent: Column, typed: Column, name: str) -> Column | None:
    """The message if a field is unusable, None for kinds that take any field."""
    if kind not in csv_cells.UNUSABLE:
        return None
    shown = sent
    if kind in ("decimal", "boolean"):
        document = F.try_parse_json(sent)
        shown = _scalar_text(F.try_variant_get(document, "$", "string"), document)
    message = F.concat(F.lit(f"Invalid {csv_cells.UNUSABLE[kind]} for field '{name}': "), shown)
    return F.when(sent.isNotNull() & typed.isNull(), message)
