"""What the corpus operators share: intermediate tables, column picking and bounded batches."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Mapping
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strataflow
from strataflow.session import scratch_dir, session_conf

#: Rows of one Arrow batch: with texts of some KB it stays at a few MB, and a batch of long
#: texts is cut further by ``slices``.
BATCH_ROWS = 512
SLICE_BYTES = 4 << 20


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of a session, wherever they run; once a session.

    To be called before a function is handed to a DataFrame, as that settles what its workers get.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(strataflow.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def saved(
    df: DataFrame, purpose: str, conf: Mapping[str, str] | None = None, by: str | None = None
) -> DataFrame:
    """``df`` as a written table in the shared folder; it cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), **(conf or {})}
    with session_conf(spark, settings):
        writer = df.write
        (writer.partitionBy(by) if by else writer).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; a NULL text is empty."""
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def one_of_each(
    docs: DataFrame, doc_id: Column, text_key: Column, settled: DataFrame
) -> DataFrame:
    """The rows of ``docs`` that ``settled`` leaves, all columns as they are.

    ``settled`` has doc_id, text_key, kept, at most once for each id and key: no row of a key that isn't
    kept stays, and exactly one of a key that is. Rows of other keys stay as they are. The one row is
    chosen by a hash of all its columns, combined before the shuffle.
    """
    settled = saved(
        settled.select(
            F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("kept").alias("__kept")
        ),
        "settled",
    )
    same = doc_id.eqNullSafe(F.col("__id")) & (text_key == F.col("__key"))
    others = docs.join(settled.drop("__kept"), same, "left_anti")
    repeated = settled.where("__kept")
    if not repeated.take(1):
        return others
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    # Grouped by a struct, rows are not taken to be dealt out by the join: it may split a hot key.
    one = (
        docs.join(repeated, same, "left_semi")
        .groupBy(F.struct(doc_id, text_key).alias("__of"))
        .agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__row"))
        .select("__row.*")
    )
    return others.unionAll(one)


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches in which ``column`` holds about ``size`` bytes.

    A longer value is a batch of its own.
    """

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.concat_batches(parts) if len(parts) > 1 else parts[0]

    waiting, held = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = 0
        for row, more in enumerate(lengths):
            if held and held + more > size:
                if row > begin:
                    waiting.append(batch.slice(begin, row - begin))
                if waiting:
                    yield joined(waiting)
                waiting, held, begin = [], 0, row
            held += more
        if batch.num_rows > begin:
            waiting.append(batch.slice(begin))
    if waiting:
        yield joined(waiting)


def lean(run: Run) -> Run:
    """``run``, after which its worker gives the memory of freed arrays back to the system.

    Workers outlive their tasks, and those of several stages lie beside the executor's own memory.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return whole


def executor_slots(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def frequent(df: DataFrame, column: str, tracked: int, most: int, least: int) -> DataFrame:
    """The values of a long column that a Misra-Gries sketch holds to occur ``least`` times or more.

    Tasks send sketches of bounded size. At most ``most`` rows; none for an empty table. A value with
    more than about 1/tracked of all rows is never missed.
    """
    return (
        df.select(column, (F.spark_partition_id() % 64).alias("part"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("sketch"))
        .groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
        .select(F.expr(f"inline(approx_top_k_estimate(sketch, {min(most, tracked)}))"))
        .where(F.col("count") >= least)
        .select(F.col("item").alias(column))
    )
