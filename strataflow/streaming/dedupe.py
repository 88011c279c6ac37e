"""De-duplication of a stream across all its micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions.keys import day_of, from_micros, row_digest, to_micros
from strataflow.session import children, has_data, make_folder, move, path_exists, remove_folder
from strataflow.streaming.changelog import BATCH, checkpoint_token

SALTS = 16
DIGEST = ["__digest_1", "__digest_2"]
DAY = "__day"
# Days that a filter names one by one; beyond, it names the first and the last.
MOST_DAYS = 1_000
# Types whose equal values Arrow groups too; it may tell apart what Spark takes for equal, such as -0.0 and 0.0.
GROUPED = (
    T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def stream_dedupe(
    df: DataFrame,
    keys: Sequence[str],
    within: tuple[str, str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The first row seen of each key, remembered in the query's state.

    The state grows with the number of distinct keys. ``within=(column, delay)`` bounds it:
    a key is forgotten once the event time has moved on by ``delay``, and rows older than that
    are dropped, whether their key was seen or not. ``append_within`` keeps those.

    Streaming de-duplication sends every row of a key to one task. So the rows of each key are
    first thinned where they are read, without state or shuffle: of the rows that a task hands over together
    (``spark.sql.execution.arrow.maxRecordsPerBatch``) one per key goes on. With ``within``, or a key of
    nested type, they are thinned in ``salts`` places instead, which remember them too, and at most that many of
    them ever reach the task that decides. ``salts=0`` saves that step where no key has many copies; a
    checkpoint keeps the choice made at its first start.
    """
    stamp = "__event_time"
    if within is not None:
        column, delay = within
        # Watermarks take only TIMESTAMP; wall-clock times are read in the session's zone.
        df = df.withColumn(stamp, F.col(column).cast(T.TimestampType()))
        df = df.withWatermark(stamp, delay)

    def once(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
        if within is not None:
            return frame.dropDuplicatesWithinWatermark(list(columns))
        return frame.dropDuplicates(list(columns))

    if salts > 1:
        if within is None and all(isinstance(df.schema[k].dataType, GROUPED) for k in keys):
            df = df.where(_first_together(df, keys))
        else:
            salted = df.withColumn("__salt", F.floor(F.rand(17) * salts))
            df = once(salted, [*keys, "__salt"]).drop("__salt")
    return once(df, keys).drop(stamp)


def _first_together(df: DataFrame, keys: Sequence[str]) -> Column:
    """Whether a row is the first of its key among those that its task hands to Python together."""

    def first(*columns):
        import numpy as np
        import pyarrow as pa

        names, rows = [str(i) for i in range(len(columns))], len(columns[0])
        table = pa.table([*columns, pa.array(np.arange(rows))], names=[*names, "row"])
        firsts = table.group_by(names, use_threads=False).aggregate([("row", "min")])["row_min"]
        found = np.zeros(rows, bool)
        found[firsts.to_numpy()] = True
        return pa.array(found)

    # Not deterministic, so that no other filter is moved or merged past it: those go before or stay behind.
    return F.arrow_udf(first, T.BooleanType()).asNondeterministic()(*[df[f"`{k}`"] for k in keys])


def stream_dedupe_changes(
    df: DataFrame, keys: Sequence[str], sequence_by: str, salts: int = SALTS
) -> DataFrame:
    """Drop repeated copies of a change row, and nothing else.

    Rows that agree in key and sequence but not in payload all pass: which one counts is settled
    where all of them are known. The payload is remembered as two hashes of its exact values, which
    keeps the state small and stays the same when a column is added that old rows lack.
    """
    payload = [c for c in df.columns if c not in {*keys, sequence_by}]
    marked = df.withColumns(dict(zip(DIGEST, row_digest(df, payload))))
    return stream_dedupe(marked, [*keys, sequence_by, *DIGEST], salts=salts).drop(*DIGEST)


def append_within(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    delay: str,
    checkpoint: str,
    path: str,
    late_path: str,
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the first row of each key to ``path``, and late rows, all of them, to ``late_path``.

    A row is late if it is older, by more than ``delay`` (such as ``"30 days"``), than the newest row
    of the micro-batches before; a row without a time is never late. Others are compared with
    the rows of the same time span that the target has, so there is no state but the target: its
    days before the span are not read. A repeated micro-batch replaces its own files. Both
    folders are partitioned by day and micro-batch (columns ``__day`` and ``__batch``).
    """
    kind = df.schema[column].dataType
    parts = ["__day", "__batch"]
    schema = T.StructType([
        *df.schema.fields, T.StructField("__day", T.DateType()), T.StructField("__batch", T.LongType())
    ])
    marks = f"{path.rstrip('/')}_marks"

    def write(rows: DataFrame, batch_id: int, target: str) -> None:
        rows = rows.withColumns({"__day": day_of(F.col(column), kind), "__batch": F.lit(batch_id)})
        writer = rows.hint("rebalance", "__day").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        floor = None
        if has_data(session, marks):
            # One row per micro-batch, of which one comes back.
            seen = session.read.parquet(marks).where(F.col("__batch") < batch_id)
            floor = seen.agg(F.max("mark")).first()[0]
        fresh, late = batch, None
        if floor is not None:
            # The mark is kept as a number, which no time zone shifts.
            least = from_micros(F.lit(floor), kind) - F.expr(f"INTERVAL {delay}")
            in_time = F.coalesce(F.col(column) >= least, F.lit(True))
            fresh, late = batch.where(in_time), batch.where(~in_time)
            write(late, batch_id, late_path)
        fresh = fresh.dropDuplicates(list(keys))
        if has_data(session, path):
            there = session.read.schema(schema).parquet(path).where(F.col("__batch") < batch_id)
            if floor is not None:
                near = F.col("__day") >= day_of(least, kind)
                there = there.where(F.coalesce(near & (F.col(column) >= least), F.lit(True)))
            same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
            fresh = fresh.alias("a").join(there.select(*keys).alias("b"), same, "left_anti")
        write(fresh, batch_id, path)
        mark = batch.agg(F.max(to_micros(F.col(column), kind)).alias("mark"))
        mark = mark.where("mark IS NOT NULL").withColumn("__batch", F.lit(batch_id).cast("long"))
        mark.write.mode("append").parquet(marks)

    writer = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    query = writer.start()
    if once:
        query.awaitTermination()
    return query


def known_schema() -> T.StructType:
    """What a folder written by ``append_known`` remembers of its rows."""
    return T.StructType([
        *[T.StructField(d, T.LongType()) for d in DIGEST],
        T.StructField(BATCH, T.StringType()), T.StructField(DAY, T.DateType()),
    ])


def append_known(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    checkpoint: str,
    path: str,
    within: str = "0 days",
    change: bool = True,
    period: str = "day",
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the rows that ``path`` doesn't know yet; there is no state but the folder itself.

    Rows are kept by batch and day (or week, month, quarter, year: ``period``, for rows spread over many days) with
    two hashes of what makes them equal: the whole row (``change``), so that copies of a change go, or its
    key, so that the first row of a key stays. A batch is compared with the hashes, and nothing else, of the days it
    can meet. Copies of a change have one time, so these are the batch's own days, whatever their age: late
    rows find their copies too, and none is lost. For keys they reach from ``within`` (such as ``"30 days"``)
    before its first day to as much behind its last: a key that turns up later than that is kept again. A row
    without a time meets others without one.

    A batch is written apart and moved into place as a whole, so that a repeated one changes nothing.
    """
    spark, kind = df.sparkSession, df.schema[sequence_by].dataType
    make_folder(spark, path)
    token = checkpoint_token(spark, checkpoint)
    day = day_of(F.col(sequence_by), kind)
    day = day if period == "day" else F.trunc(day, period)

    def near(batch: DataFrame) -> Column:
        if change:
            days = [r[0] for r in batch.select(DAY).distinct().limit(MOST_DAYS + 1).collect()]
            timed = [d for d in days if d is not None]
            if len(days) <= MOST_DAYS:
                return F.col(DAY).isin(timed) | F.col(DAY).isNull()
        ends = batch.agg(F.min(DAY).alias("a"), F.max(DAY).alias("b"))
        span = F.expr(f"INTERVAL {'0 days' if change else within}")
        first = (F.col("a") - span).cast("date")
        first = first if period == "day" else F.trunc(first, period)
        # The end of a period is no later than the beginning of the next, some 366 days on.
        last = F.col("b") + span + F.expr("INTERVAL 0 days" if period == "day" else "INTERVAL 366 days")
        first, last = ends.select(first, last.cast("date")).first()
        return F.col(DAY).between(F.lit(first), F.lit(last)) | F.col(DAY).isNull()

    def write(batch: DataFrame, batch_id: int) -> None:
        session, name = batch.sparkSession, f"{batch_id:012d}-{token}"
        place = f"{path}/{BATCH}={name}"
        if path_exists(session, place):
            return
        same = row_digest(batch, batch.columns if change else keys)
        rows = batch.withColumns({**dict(zip(DIGEST, same)), DAY: day}).dropDuplicates(DIGEST)
        if any(child.startswith(BATCH) for child in children(session, path)):
            there = session.read.schema(known_schema()).parquet(path)
            there = there.where(near(batch.withColumn(DAY, day))).select(*DIGEST)
            rows = rows.join(there, DIGEST, "left_anti")
        incoming = f"{path.rstrip('/')}_incoming/{name}-{uuid.uuid4().hex[:8]}"
        rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(incoming)
        move(session, incoming, place)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    query = writer.start()
    if once:
        query.awaitTermination()
        remove_folder(spark, f"{path.rstrip('/')}_incoming")
    return query
