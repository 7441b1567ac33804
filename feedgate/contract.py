"""The table contract: what a feed's columns mean and what a loadable row is.

A contract is the only thing a user writes for a new table.  Everything else in the
library is a DataFrame -> DataFrame function that takes one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, types as T

#: kind -> type of the parsed column.  A decimal stays exact plain text (any precision);
#: ``decimals.as_decimal`` gives it a numeric type where a job needs one.
KINDS: dict[str, T.DataType] = {
    "text": T.StringType(),
    "uuid": T.StringType(),
    "date": T.DateType(),
    "decimal": T.StringType(),
    "boolean": T.BooleanType(),
    "list": T.ArrayType(T.StringType()),
    "json": T.StringType(),
}

#: Columns the run adds to every target row.
STAMPS = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("execution_id", T.StringType()),
        T.StructField("source_creation_time", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Field:
    """One input column.

    ``protect`` encrypts the whole value; ``protect_key`` encrypts one key inside a JSON
    value; ``width`` is a fixed stored width (surplus trailing blanks are cut).
    """

    name: str
    kind: str = "text"
    protect: bool = False
    protect_key: str | None = None
    width: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r} for column {self.name!r}")
        if self.protect_key and self.kind != "json":
            raise ValueError(f"protect_key needs a json column, {self.name!r} is {self.kind}")


@dataclass(frozen=True)
class Rule:
    """A named check; ``violation()`` is the message of a broken rule, else NULL."""

    name: str
    violation: Callable[[], Column]


@dataclass(frozen=True)
class TableContract:
    """Columns, key, row rules, and the table checks applied before the load."""

    name: str
    key: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    checks: tuple[Rule, ...] = ()
    lenient_uuid: bool = False

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len({n.lower() for n in names}) != len(names):
            raise ValueError(f"contract {self.name!r} repeats a column name")
        if any(set(".`'\"[]") & set(n) for n in names):
            raise ValueError(f"contract {self.name!r} has a column name with a dot, quote or bracket")
        if self.key not in names:
            raise ValueError(f"key {self.key!r} is not a column of {self.name!r}")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def protected(self) -> list[Field]:
        return [f for f in self.fields if f.protect or f.protect_key]

    @property
    def typed_schema(self) -> T.StructType:
        """Schema after parsing, before stamping and protection."""
        return T.StructType([T.StructField(f.name, KINDS[f.kind]) for f in self.fields])

    @property
    def target_schema(self) -> T.StructType:
        """Schema of the stored table."""
        fields = [
            T.StructField(f.name, T.StringType() if f.protect else KINDS[f.kind])
            for f in self.fields
        ]
        return T.StructType(fields + list(STAMPS.fields))
