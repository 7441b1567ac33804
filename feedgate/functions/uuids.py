"""One canonical form for identifiers, used by load and reconciliation alike."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STRICT = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
SHORT = r"^([0-9a-fA-F]+)-([0-9a-fA-F]+)-([0-9a-fA-F]+)-([0-9a-fA-F]+)-([0-9a-fA-F]+)$"
WIDTHS = (8, 4, 4, 4, 12)


def canonical(raw: Column, lenient: bool = False) -> Column:
    """Lower-case 8-4-4-4-12 form, NULL if the text is no identifier.

    ``lenient`` also takes five hexadecimal groups of other widths, as ``1-1-1-1-1``:
    short groups are padded with zeros, long ones keep their low digits.
    """
    strict = F.when(raw.rlike(STRICT), F.lower(raw))
    if not lenient:
        return strict
    groups = [
        F.right(F.lpad(F.regexp_extract(raw, SHORT, i + 1), F.lit(36), F.lit("0")), F.lit(width))
        for i, width in enumerate(WIDTHS)
    ]
    fits = raw.rlike(SHORT) & (F.length(raw) <= 36)
    return F.coalesce(strict, F.when(fits, F.lower(F.concat_ws("-", *groups))))
