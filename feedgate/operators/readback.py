"""The stored table as nested records, decrypted, newest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.contract import TableContract
from feedgate.operators.protect import unprotected


def newest_first(rows: DataFrame, key: str, by: str = "ingestion_timestamp") -> DataFrame:
    """Newest rows first, rows without a time before all others.

    All rows of a run share one time.  The key as second sort column lets Spark's range
    partitioning cut such a run into many parts instead of sorting it in one task.
    """
    return rows.orderBy(F.col(by).desc_nulls_first(), F.col(key))


def contact(document: Column) -> Column:
    """Name, relationship, phone and email of a contact document; NULLs where there is none."""
    variant = F.try_parse_json(document)
    return F.struct(
        *[
            F.try_variant_get(variant, f"$.{name}", "string").alias(name)
            for name in ("name", "relationship", "phone", "email")
        ]
    )


def records(
    target: DataFrame,
    contract: TableContract,
    key: Column,
    contact_column: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Stored rows as they are served: decrypted, lists never NULL, unset flags false.

    Decimals are served as the exact text they are stored as; ``decimals.as_decimal`` gives them
    a numeric type that a job has chosen.
    """
    plain = unprotected(target, contract, key, strict)
    columns = [_served(f, contact_column).alias(f.name) for f in contract.fields]
    return plain.select(
        *columns, "ingestion_timestamp", "execution_id", "source_creation_time"
    )


def newest_records(
    target: DataFrame,
    contract: TableContract,
    key: Column,
    contact_column: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """All stored rows as they are served, newest first.

    Sorted as stored and decrypted afterwards: plain text is never shuffled, and no value is
    decrypted for the sort's sampling.
    """
    return records(newest_first(target, contract.key), contract, key, contact_column, strict)


def _served(field, contact_column: str | None) -> Column:
    value = F.col(field.name)
    if field.name == contact_column:
        return contact(value)
    if field.kind == "list":
        return F.coalesce(value, F.array().cast("array<string>"))
    if field.kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if field.kind == "json":
        return F.try_parse_json(value)
    return value
