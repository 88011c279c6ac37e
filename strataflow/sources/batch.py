"""Batch reads: layer folders, catalog tables and change windows of a source."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "1900-01-01"


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | None = None, evolved: bool = False
) -> DataFrame:
    """A layer folder. With a ``schema``, columns a file lacks read as NULL and no footer is
    opened for planning; ``evolved`` merges the footers' schemas instead."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif evolved:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def portable(column: str, data_type: T.DataType) -> Column:
    """A change value in a form that passes through Python unchanged, whatever the time zones."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.TimestampNTZType):
        return F.col(column).cast("string")
    return F.col(column)


def shown(value: Any, data_type: T.DataType) -> str | None:
    """A portable change value as text; instants are in UTC."""
    if isinstance(data_type, T.TimestampType) and isinstance(value, int):
        value = datetime(1970, 1, 1) + timedelta(microseconds=value)
    return None if value is None else str(value)


def bound(value: Any, data_type: T.DataType) -> Column:
    """A literal of the change column's own type, so the comparison reaches the source."""
    if isinstance(data_type, T.TimestampType) and isinstance(value, int):
        return F.timestamp_micros(F.lit(value))
    if isinstance(data_type, T.TimestampNTZType):
        # A datetime as a literal would be an instant, and shift with the session's zone.
        value = str(value)
    return F.lit(value).cast(data_type)


def read_since(
    reader: Callable[[], DataFrame],
    cdc_col: str,
    low: Any = None,
    high: Any = None,
    overlap: str | None = None,
    or_null: bool = False,
) -> DataFrame:
    """Rows with ``low < cdc_col <= high``; an absent bound is open. ``or_null`` adds those without a value.

    ``overlap`` (an interval such as ``"1 day"``) reads that much again from ``low``
    backwards, for sources whose rows can turn up late; later steps drop the repeats.
    """
    df = reader()
    data_type = df.schema[cdc_col].dataType
    column, inside = F.col(cdc_col), None
    if low is not None:
        lowest = bound(low, data_type)
        if overlap:
            inside = column >= (lowest - F.expr(f"INTERVAL {overlap}")).cast(data_type)
        else:
            inside = column > lowest
    if high is not None:
        below = column <= bound(high, data_type)
        inside = below if inside is None else inside & below
    if inside is None:
        return df
    return df.where(inside | column.isNull() if or_null else inside)
