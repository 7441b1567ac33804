"""Decimals of any precision as exact plain text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Plain text already: no plus, no leading zeros, digits on both sides of the point, no minus zero.
PLAIN = r"^(?!-[0.]+$)-?(?:0|[1-9]\d*)(?:\.\d+)?$"
FIXED = r"^[+-]?(?=\.?\d)\d*\.?\d*$"
SCIENTIFIC = r"^([+-]?)(?=\.?\d)(\d*)\.?(\d*)[eE]([+-]?0*\d{1,3})$"
# Larger exponents stay exponents: their plain form would be megabytes of zeros.
FAR = r"^([+-]?)(?=\.?\d)(\d*)\.?(\d*)[eE]([+-]?\d{4,})$"


def plain(raw: Column) -> Column:
    """``+007.50`` -> ``7.50``, ``1.5e3`` -> ``1500``; NULL if the text is no number.

    The scale given is kept, so the text is what was sent, and nothing is rounded.  Exponents
    beyond 999 either way give ``1.5E+1001``, with one digit before the point; they have to
    be 32-bit whole numbers.
    """
    return (
        F.when(raw.rlike(PLAIN), raw)
        .when(raw.rlike(FIXED), _tidy(raw))
        .when(raw.rlike(SCIENTIFIC), _tidy(_shifted(raw)))
        .when(raw.rlike(FAR), _far(raw))
    )


def _tidy(number: Column) -> Column:
    text = F.regexp_replace(number, r"^\+", "")
    text = F.regexp_replace(text, r"^(-?)0+(?=\d)", "$1")
    text = F.regexp_replace(text, r"^(-?)(?=\.)", "$10")
    text = F.regexp_replace(text, r"\.$", "")
    return F.regexp_replace(text, r"^-(?=[0.]*$)", "")


def _far(number: Column) -> Column:
    """A number with a long exponent, its first digit before the point; zero is plain."""
    whole, fraction = F.regexp_extract(number, FAR, 2), F.regexp_extract(number, FAR, 3)
    digits = F.regexp_replace(F.concat(whole, fraction), "^0+", "")
    # Places from the point to behind the first digit that is not zero.
    shift = F.length(digits) - F.length(fraction) - 1
    exponent = F.regexp_extract(number, FAR, 4).try_cast("int") + shift.cast("bigint")
    rest = F.substring(digits, F.lit(2), F.length(digits))
    text = F.concat(
        F.when(F.regexp_extract(number, FAR, 1) == "-", "-").otherwise(""),
        F.left(digits, F.lit(1)),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""),
        F.when(exponent < 0, "E").otherwise("E+"),
        exponent.cast("string"),
    )
    return F.when(digits == "", F.lit("0")).otherwise(text)


def _shifted(number: Column) -> Column:
    """Scientific notation with the point moved to where the exponent puts it."""
    parts = F.struct(
        F.regexp_extract(number, SCIENTIFIC, 1).alias("sign"),
        F.concat(
            F.regexp_extract(number, SCIENTIFIC, 2), F.regexp_extract(number, SCIENTIFIC, 3)
        ).alias("digits"),
        (
            F.length(F.regexp_extract(number, SCIENTIFIC, 3))
            - F.regexp_extract(number, SCIENTIFIC, 4).try_cast("int")
        ).alias("scale"),
    )

    def placed(p: Column) -> Column:
        padded = F.lpad(
            p["digits"], F.greatest(F.length(p["digits"]), p["scale"]), F.lit("0")
        )
        return F.when(
            p["scale"] <= 0, F.concat(p["sign"], p["digits"], F.repeat(F.lit("0"), -p["scale"]))
        ).otherwise(
            F.concat(
                p["sign"],
                F.substring(padded, F.lit(1), F.length(padded) - p["scale"]),
                F.lit("."),
                F.right(padded, p["scale"]),
            )
        )

    # A one-element transform names the parts, which are used several times.
    return F.transform(F.array(parts), placed)[0]


def is_negative(value: Column) -> Column:
    """Sign test on plain text; plain zero never carries a sign."""
    return F.startswith(value, F.lit("-"))


def as_decimal(value: Column, to: str) -> Column:
    """A number of the given type, rounded to its scale; NULL where it has too many digits."""
    return value.try_cast(to)
