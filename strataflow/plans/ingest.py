"""Source to bronze: copy what changed since the last run, for every configured table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import IngestSpec, Layers
from strataflow.functions.keys import row_digest
from strataflow.session import has_data, remove_folder
from strataflow.sources.batch import SENTINEL, bound, portable, read_since, shown

# Given a table's entry, its whole source as a lazy frame: a JDBC table, a folder, a catalog name.
Reader = Callable[[IngestSpec], DataFrame]


@dataclass(frozen=True)
class Outcome:
    """What a run did for one table."""

    run_id: str
    table: str
    status: str
    n_rows: int = 0
    low: str | None = None
    high: str | None = None
    error: str | None = None
    n_null: int = 0
    n_late: int = 0


def failure(run_id: str, table: str, error: Exception) -> Outcome:
    return Outcome(run_id, table, "failed", error=f"{type(error).__name__}: {error}")


class WatermarkStore:
    """The last change value copied, per table, as one appended row per successful run.

    Reading takes the maximum, so a row can be added but the mark can never move back.
    """

    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark = spark
        self.layers = layers

    def get(self, spec: IngestSpec, data_type: T.DataType) -> Any:
        """The stored mark; before the first run, the configured start or a date before all data."""
        path = self.layers.state("watermark", spec.table)
        if has_data(self.spark, path):
            schema = T.StructType([T.StructField("watermark", data_type)])
            marks = self.spark.read.schema(schema).parquet(path)
            highest = marks.agg(F.max("watermark").alias("watermark"))
            return highest.select(portable("watermark", data_type)).first()[0]
        if spec.from_date:
            return spec.from_date
        dated = isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return SENTINEL if dated else None

    def put(self, spec: IngestSpec, value: Any, data_type: T.DataType) -> None:
        row = self.spark.range(0, 1, 1, 1).select(bound(value, data_type).alias("watermark"))
        row.write.mode("append").parquet(self.layers.state("watermark", spec.table))


def land(df: DataFrame, path: str) -> None:
    """Append rows to a bronze folder as they are."""
    df.write.mode("append").parquet(path)


def lacking(spark: SparkSession, rows: DataFrame, landed: Callable[[], DataFrame], path: str) -> DataFrame:
    """The rows that the bronze folder doesn't hold yet; ``landed`` reads the part that could.

    Rows are compared by a digest of all their values. Equal rows that arrive together all land.
    """
    if not has_data(spark, path):
        return rows
    names = ["__digest_1", "__digest_2"]
    there = landed().select(*[d.alias(n) for d, n in zip(row_digest(rows, rows.columns), names)])
    marked = rows.withColumns(dict(zip(names, row_digest(rows, rows.columns))))
    return marked.join(there, names, "left_anti").drop(*names)


def ingest_table(
    spark: SparkSession,
    spec: IngestSpec,
    reader: Reader,
    layers: Layers,
    run_id: str | None = None,
    window: tuple[Any, Any] | None = None,
    only_lacking: bool = False,
    tally: Any = None,
) -> Outcome:
    """Copy one table's new rows to bronze; a ``tally`` counts them as they are written.

    The newest change value is read first, from that column alone, and fixes the window's end:
    rows that arrive meanwhile wait for the next run. Rows that turned up late are looked for
    within the entry's ``overlap`` behind the mark, whether there is news or not, and of them those
    land that bronze lacks. Without either nothing is written. The mark moves only after the rows
    are in place; a run that fails in between repeats its window, and the repeats are dropped
    further on, by key and sequence. Rows without a change value are in no window; the outcome tells
    their number.
    """
    run_id = run_id or uuid.uuid4().hex
    store = WatermarkStore(spark, layers)
    bronze = layers.path("bronze", spec.table)
    source = reader(spec)
    schema, data_type = source.schema, source.schema[spec.cdc_col].dataType
    low, limit = window if window else (store.get(spec, data_type), None)
    since = shown(low, data_type)
    news = read_since(lambda: reader(spec), spec.cdc_col, low, limit, or_null=True)
    without = F.count_if(F.col(spec.cdc_col).isNull())
    news = news.agg(
        F.max(spec.cdc_col).alias("high"), F.count(spec.cdc_col).alias("n_rows"), without.alias("n_null")
    )
    high, n_rows, n_null = news.select(portable("high", data_type), "n_rows", "n_null").first()
    rows = read_since(lambda: reader(spec), spec.cdc_col, low, high) if n_rows else None
    there = lambda: spark.read.schema(schema).parquet(bronze)
    if rows is not None and only_lacking:
        landed = lambda: read_since(there, spec.cdc_col, low, high)
        rows = lacking(spark, rows, landed, bronze)
    late, seen = None, Observation()
    if spec.overlap and window is None and low is not None:
        behind = lambda read: read_since(read, spec.cdc_col, low, low, spec.overlap)
        late = lacking(spark, behind(lambda: reader(spec)), lambda: behind(there), bronze)
        if not late.take(1):
            late = None
    if rows is None and late is None:
        return Outcome(run_id, spec.table, "empty", 0, since, since, n_null=n_null)
    parts = [] if rows is None else [rows]
    if late is not None:
        parts.append(late.observe(seen, F.count(F.lit(1)).alias("n")))
    landed = reduce(DataFrame.unionAll, parts)
    if tally is None:
        # Counts that were kept so far are no longer those of the folder.
        remove_folder(spark, layers.state("tally", spec.table))
        land(landed, bronze)
    else:
        landed, counted = tally.watched(landed)
        land(landed, bronze)
        tally.put("bronze", run_id, counted)
    if window is None and n_rows:
        store.put(spec, high, data_type)
    status = "backfilled" if window else "loaded"
    top = shown(high, data_type) if n_rows else since
    n_late = seen.get["n"] if late is not None else 0
    return Outcome(
        run_id, spec.table, status, n_rows, since, top, n_null=n_null, n_late=n_late
    )


def backfill(
    spark: SparkSession,
    spec: IngestSpec,
    reader: Reader,
    layers: Layers,
    from_value: Any,
    to_value: Any,
    only_lacking: bool = False,
) -> Outcome:
    """Copy the rows with ``from_value < change value <= to_value`` again; the mark stays.

    Silver drops the copies of tables that are de-duplicated; for others ``only_lacking`` lands
    those rows only that bronze doesn't hold.
    """
    return ingest_table(
        spark, spec, reader, layers, window=(from_value, to_value), only_lacking=only_lacking
    )


def run_all(
    spark: SparkSession,
    specs: Sequence[IngestSpec],
    reader: Reader,
    layers: Layers,
    parallel: int = 4,
    tallies: Mapping[str, Any] | None = None,
) -> list[Outcome]:
    """Copy every configured table; one table's failure does not stop the others.

    The tables' Spark jobs are submitted from ``parallel`` threads, so a small table does
    not wait for a large one to finish.
    """
    run_id = uuid.uuid4().hex

    def one(spec: IngestSpec) -> Outcome:
        try:
            tally = (tallies or {}).get(spec.table)
            return ingest_table(spark, spec, reader, layers, run_id, tally=tally)
        except Exception as error:
            return failure(run_id, spec.table, error)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(one, specs))
