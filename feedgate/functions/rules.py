"""Rule builders for contracts.  Each gives a message column, NULL where the rule holds.

The wording of the messages is a fixed value: error rows carry it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from feedgate.contract import Rule
from feedgate.functions import decimals


def key_present(name: str) -> Rule:
    message = f"{name} is null (required primary key)"
    return Rule(f"{name} present", lambda: F.when(F.col(name).isNull(), F.lit(message)))


def length_between(name: str, low: int, high: int) -> Rule:
    """Length in characters (code points); NULL passes."""

    def violation() -> Column:
        size = F.length(F.col(name))
        message = F.concat(
            F.lit(f"{name} length "), size.cast("string"), F.lit(f" not in [{low}, {high}]")
        )
        return F.when(~size.between(low, high), message)

    return Rule(f"{name} length", violation)


def email_shape(name: str) -> Rule:
    def violation() -> Column:
        value = F.col(name)
        shaped = F.contains(value, F.lit("@")) & F.contains(value, F.lit("."))
        message = F.lit(f"{name} does not contain '@' and '.'")
        return F.when(~value.rlike(r"^\s*$") & ~shaped, message)

    return Rule(f"{name} shape", violation)


def trimmed_length(name: str, exact: int) -> Rule:
    """Length without leading and trailing control characters and blanks."""

    def violation() -> Column:
        size = F.length(F.regexp_replace(F.col(name), r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
        message = F.concat(
            F.lit(f"{name} must be exactly {exact} characters, got: "), size.cast("string")
        )
        return F.when(size != exact, message)

    return Rule(f"{name} width", violation)


def not_negative(name: str) -> Rule:
    message = f"{name} must be non-negative"
    return Rule(
        f"{name} sign", lambda: F.when(decimals.is_negative(F.col(name)), F.lit(message))
    )


def stored_width(name: str, exact: int) -> Rule:
    """What a fixed-width column can hold: surplus is allowed only as trailing blanks."""

    def violation() -> Column:
        size = F.length(F.rtrim(F.col(name)))
        return F.when(size != exact, F.lit(f"{name} does not fit its {exact} character column"))

    return Rule(f"{name} stored width", violation)
