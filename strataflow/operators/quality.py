"""Row rules: named SQL predicates that a row passes only when they are TRUE."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED = "failed_rules"


def _passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep the rows that pass every rule; a rule that is NULL for a row drops it.

    The rules stay plain predicates, so the scan can use those it understands.
    """
    for rule in rules.values():
        df = df.where(F.expr(rule))
    return df


def classify(df: DataFrame, rules: Mapping[str, str], column: str = FAILED) -> DataFrame:
    """Add the array of the names of the rules a row fails."""
    names = [F.when(~_passes(rule), F.lit(name)) for name, rule in rules.items()]
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn(column, failed)


def split(df: DataFrame, rules: Mapping[str, str], column: str = FAILED) -> tuple[DataFrame, DataFrame]:
    """The rows that pass every rule, and the others with the names of the rules they fail."""
    marked = classify(df, rules, column)
    return expect_all_or_drop(df, rules), marked.where(F.size(column) > 0)


class RuleBroken(ValueError):
    """Rows break a rule that allows no exception."""


def broken_rules(df: DataFrame, rules: Mapping[str, str]) -> dict[str, int]:
    """How many rows break each rule that any row breaks; one row comes to the driver."""
    if not rules:
        return {}
    counts = df.agg(*failures(rules)).first().asDict()
    return {name: n for name, n in counts.items() if n}


def failures(rules: Mapping[str, str]) -> list[Column]:
    """An aggregate per rule: the rows that break it."""
    return [F.count_if(~_passes(rule)).alias(name) for name, rule in rules.items()]


def report(broken: Mapping[str, int], where: str = "") -> None:
    if broken:
        named = ", ".join(f"rule {name} is broken by {n} rows" for name, n in broken.items())
        raise RuleBroken(f"{where}: {named}" if where else named)


def expect_all_or_fail(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The same rows, once all of them are known to pass; else RuleBroken is raised.

    The rules are looked at here and now, in a pass over their columns, so that no filter or limit
    put behind can hide a row. A job that writes the rows anyway saves that pass with
    ``write_snapshot(rules=...)``. A stream is looked at row by row as it runs, whatever follows.
    """
    if not df.isStreaming:
        report(broken_rules(df, rules))
        return df
    for name, rule in rules.items():
        broken = F.raise_error(F.lit(f"rule {name} is broken: {rule}")).cast("boolean")
        df = df.where(F.when(_passes(rule), F.lit(True)).otherwise(broken))
    return df
