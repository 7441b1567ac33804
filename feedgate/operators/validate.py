"""Rules over typed rows, and the split into loadable rows and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.contract import Rule, TableContract
from feedgate.functions.barrier import computed_once


def with_reason(parsed: DataFrame, contract: TableContract) -> DataFrame:
    """Add ``_reason``: why a row cannot be loaded, NULL for a loadable row.

    That is its parse error, else all broken rules in rule order, else all broken table
    checks.  Valid and error rows are the two filters on it.
    """
    joined = parsed.withColumns(
        {"_rules": _joined(contract.rules), "_checks": _joined(contract.checks)}
    )
    reason = F.coalesce(
        "_parse_error", F.nullif("_rules", F.lit("")), F.nullif("_checks", F.lit(""))
    )
    return joined.withColumn("_reason", computed_once(reason)).drop("_rules", "_checks")


def _joined(rules: tuple[Rule, ...]) -> Column:
    return F.concat_ws("; ", *[r.violation() for r in rules]) if rules else F.lit("")


def with_violations(parsed: DataFrame, contract: TableContract) -> DataFrame:
    """Add ``_violations``: the broken rules and checks of a row as an array."""
    every = [r.violation() for r in (*contract.rules, *contract.checks)]
    return parsed.withColumn("_violations", F.array_compact(F.array(*every)))


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("_reason").isNull()).drop("_reason", "_parse_error")


def error_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("_reason").isNotNull()).select(
        "_source_file", "_at", "_reason"
    )


def violations_by_rule(parsed: DataFrame, contract: TableContract) -> DataFrame:
    """Rows per broken rule among the parsed rows.

    One counter per rule in a single pass; rows are neither exploded nor shuffled by rule.
    """
    rules = [*contract.rules, *contract.checks]
    counters = [F.count(r.violation()).alias(f"_{i}") for i, r in enumerate(rules)]
    one_row = parsed.filter(F.col("_parse_error").isNull()).agg(*counters)
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"_{i}").alias("violations"))
             for i, r in enumerate(rules)]
    return one_row.select(F.inline(F.array(*pairs)))
