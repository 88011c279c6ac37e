"""Sums per key, previews, watermarks and the calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(
    df: DataFrame, keys: Sequence[str], value: str, alias: str, scale: int | None = None
) -> DataFrame:
    """Sum of ``value`` per key, combined in each task before the shuffle.

    Sums of doubles depend on the order of the rows; ``scale`` sums as a decimal with that many
    digits instead (each value is rounded to them), which gives the same result on every run.
    """
    column = F.col(value)
    if scale is None:
        total = F.sum(column)
    else:
        total = F.sum(column.cast(f"decimal(38,{scale})")).cast("double")
    return df.groupBy(*keys).agg(total.alias(alias))


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order: each task keeps only its own first ``n``."""
    return df.orderBy(*order_by).limit(n)


def high_watermark(df: DataFrame, cdc_col: str) -> DataFrame:
    """One row: the highest change value and the number of rows. Reads a single column."""
    return df.agg(F.max(cdc_col).alias("high"), F.count(F.lit(1)).alias("n_rows"))


def distinct_dates(df: DataFrame, column: str) -> DataFrame:
    """A calendar dimension of the days that occur in ``column``.

    The days are made distinct first, so the calendar fields are computed once per day.
    """
    days = df.select(F.to_date(column).alias("date")).where("date IS NOT NULL").distinct()
    return days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.date_format("date", "EEEE").alias("weekday"),
    )
