"""Streaming reads of folders and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    glob: str | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder, each read once; the stream's checkpoint remembers the seen ones.

    ``files_per_batch`` or ``bytes_per_batch`` cuts a large backlog into several micro-batches.
    Other file-source options pass through: ``cleanSource`` with ``sourceArchiveDir`` keeps the
    folder short enough to list.
    """
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_table(
    spark: SparkSession, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows appended to a table: a folder when a schema is given, else a catalog name."""
    if schema is None:
        return spark.readStream.table(table)
    return spark.readStream.schema(schema).parquet(table)
