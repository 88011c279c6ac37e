"""Column clean-up, usable on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns; names the frame does not have are ignored."""
    return df.drop(*columns)


def upper_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.upper(name) for name in columns})


def regex_clean(df: DataFrame, column: str, pattern: str = "-", replacement: str = " ") -> DataFrame:
    """Replace every match of ``pattern`` in a string column."""
    return df.withColumn(column, F.regexp_replace(column, pattern, replacement))


def bucketize(value: str | Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first limit the value lies below; NULL gets ``otherwise``, as CASE does."""
    value = F.col(value) if isinstance(value, str) else value
    (limit, label), *rest = limits
    case = F.when(value < limit, label)
    for limit, label in rest:
        case = case.when(value < limit, label)
    return case.otherwise(otherwise)
