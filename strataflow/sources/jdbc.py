"""A database table as a source."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def database_options(
    url: str,
    table: str,
    split_by: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 1,
    **options: str,
) -> dict[str, str]:
    """The reader's options; a read in ranges needs its column, both bounds and their number."""
    found = {"url": url, "dbtable": table, **options}
    if split_by is None:
        if partitions != 1 or lower is not None or upper is not None:
            raise ValueError(f"{table}: ranges need split_by")
        return found
    if lower is None or upper is None:
        raise ValueError(f"{table}: split_by needs lower and upper")
    if partitions < 2:
        raise ValueError(f"{table}: split_by needs two partitions or more")
    return found | {
        "partitionColumn": split_by,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    split_by: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A table read over JDBC; filters on plain columns are answered by the database.

    ``split_by`` (a number, date or timestamp column) reads in ``partitions`` parallel ranges. The
    bounds only place the ranges: rows outside them belong to the first or last range. Without it
    the whole table comes through one connection and one task, which suits small tables only.
    """
    chosen = database_options(url, table, split_by, lower, upper, partitions, **options)
    return spark.read.format("jdbc").options(**chosen).load()
