"""Change rows from a stream into a type 1 or type 2 table kept in buckets.

``stage`` (see ``changelog``) appends the valid change rows to a log partitioned by key bucket;
``apply_changes`` follows the log and rewrites the parts of the table that its new rows can change. The
table is a function of the set of logged rows: a repeated micro-batch changes nothing, late rows find
their place, and a damaged table can be rebuilt.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.config import CdcSpec, Layers
from strataflow.functions.keys import bucket_of, orderable, period_of
from strataflow.operators.history import END, START, scd1, scd2
from strataflow.operators.quality import broken_rules, expect_all_or_drop, report
from strataflow.session import (
    has_data, put_marker, read_marker, read_markers, remove_folder, scratch_dir, session_copy,
)
from strataflow.sources.batch import bound
from strataflow.streaming.changelog import (
    BATCH, BUCKET, compact, due, log_path, log_schema, mark_applied, read_log, release, rules_of, stage,
)

# The period a version ends in; versions still open have a date of their own.
UNTIL = "__until"
OPEN = date(9999, 12, 31)
# Buckets that a filter or a marker names one by one; beyond, they stand for the whole table.
MOST_NAMED = 10_000
WHOLE = "all"
ENDED = "."


def state_of(rows: DataFrame, spec: CdcSpec) -> DataFrame:
    """The table that a set of change rows amounts to, with its partition columns."""
    rows = expect_all_or_drop(rows, spec.rules)
    if spec.scd_type == 1:
        state = scd1(rows, spec.keys, spec.sequence_by, spec.skew)
    else:
        state = scd2(rows, spec.keys, spec.sequence_by, untracked=spec.untracked, policy=spec.skew)
    state = state.withColumn(BUCKET, bucket_of(spec.keys, spec.buckets, spec.bucket_expr))
    if spec.by_period:
        ended = period_of(F.col(END), state.schema[END].dataType, spec.period)
        state = state.withColumn(UNTIL, F.coalesce(ended, F.lit(OPEN)))
    return state


def _check(rows: DataFrame, spec: CdcSpec) -> None:
    """Raise if rows break a rule that stops the flow."""
    if spec.on_broken == "fail":
        report(broken_rules(rows, spec.rules), spec.table)


def _replace(state: DataFrame, spec: CdcSpec, target: str, balance: bool = False) -> None:
    """Overwrite the partitions ``state`` has rows for, or the whole table (``balance``).

    More change rows never empty a partition, so nothing outdated stays behind. Hash buckets need no
    shuffle of their own (see ``_aligned``); others, and whole tables by period, are balanced.
    """
    parts = [BUCKET, UNTIL] if spec.by_period else [BUCKET]
    if spec.bucket_expr or (balance and spec.by_period):
        state = state.hint("rebalance", *parts)
    (
        state.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if balance else "dynamic")
        .partitionBy(*parts)
        .parquet(target)
    )


def _aligned(session: SparkSession, spec: CdcSpec) -> dict[str, str]:
    """A shuffle width that is a multiple of the buckets.

    The window's shuffle by key then leaves each task with rows of one bucket (or of a few
    small ones), so the tasks' output needs no second shuffle to be written in few files.
    """
    width = int(session.conf.get("spark.sql.shuffle.partitions"))
    width = -(-width // spec.buckets) * spec.buckets
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.shuffle.partitions": str(width),
    }


def _known(spark: SparkSession, spec: CdcSpec, layers: Layers) -> list[str]:
    """What the table was kept by, oldest first: a small file per change of the spec.

    A file that a broken run left half written equals no spec.
    """
    return read_markers(spark, layers.state("spec", spec.flow))


def _remember(spark: SparkSession, spec: CdcSpec, layers: Layers) -> None:
    known = _known(spark, spec, layers)
    if not known or known[-1] != spec.fingerprint:
        path = f"{layers.state('spec', spec.flow)}/{len(known):08d}"
        put_marker(spark, path, spec.fingerprint)


def _from_log(
    session: SparkSession, spec: CdcSpec, schema: T.StructType, layers: Layers,
    buckets: list[int] | None, between: tuple[Any, Any] | None = None,
) -> DataFrame:
    """The change rows of some buckets, or of all."""
    # Part of the log may be laid out by other buckets.
    same = all(repr(spec.scheme) in known for known in _known(session, spec, layers))
    return read_log(session, spec, schema, layers, buckets, between, known_schemes=same)


def _touched(batch: DataFrame, spec: CdcSpec) -> list[int] | None:
    """The buckets of a micro-batch, or None if they are too many to name."""
    buckets = batch.select(bucket_of(spec.keys, spec.buckets, spec.bucket_expr).alias(BUCKET))
    rows = buckets.distinct().limit(MOST_NAMED + 1).collect()
    return [row[0] for row in rows] if len(rows) <= MOST_NAMED else None


def _with_table(
    batch: DataFrame, spec: CdcSpec, schema: T.StructType, layers: Layers, touched: list[int] | None
) -> tuple[DataFrame, Column]:
    """A micro-batch's change rows with those rows of the table that they can affect, and where these are.

    A new row ends the version valid at its time, and becomes one that ends where that did. So versions
    that ended before the period of a bucket's oldest new row stay as they are. With too many buckets
    to name, the oldest row of all counts.
    """
    oldest = F.min(spec.sequence_by)
    if spec.by_period:
        oldest = period_of(oldest, schema[spec.sequence_by].dataType, spec.period)
    if touched is None:
        affected = F.lit(True)
        if spec.by_period:
            affected = F.col(UNTIL) >= F.lit(batch.agg(oldest).first()[0])
    else:
        bucket = bucket_of(spec.keys, spec.buckets, spec.bucket_expr)
        # One row per touched bucket, of which there are at most MOST_NAMED.
        floors: dict[Any, list[int]] = defaultdict(list)
        for number, floor in batch.groupBy(bucket.alias(BUCKET)).agg(oldest).collect():
            floors[floor if spec.by_period else None].append(number)
        affected = F.lit(False)
        for floor, buckets in floors.items():
            inside = F.col(BUCKET).isin(buckets)
            affected |= inside & (F.col(UNTIL) >= F.lit(floor)) if spec.by_period else inside
    table = _read_target(batch.sparkSession, spec, layers, schema).where(affected)
    if spec.untracked:
        return _with_runs(table, batch, spec, schema, layers, touched), affected
    return table.select(*schema.names).unionByName(batch.select(*schema.names)), affected


def _with_runs(
    table: DataFrame, batch: DataFrame, spec: CdcSpec, schema: T.StructType, layers: Layers,
    touched: list[int] | None,
) -> DataFrame:
    """The same for versions that stand for a run of changes which differ in untracked columns only.

    Two points stand for such a run: its first change, of which the table knows the time and the tracked
    columns, and its last, which is the table's row. A new row outside of all runs, or one that agrees with the
    run it falls into, needs no more. One that splits a run, or meets its first change, needs the changes of
    that run, which are read from the log: in the touched buckets, between the ends of such runs.
    """
    session, seq, names = batch.sparkSession, spec.sequence_by, schema.names
    tracked = [c for c in names if c not in {*spec.keys, seq, *spec.untracked}]
    bounds = [f"__k{n}" for n in range(len(spec.keys))]
    runs = table.where(F.col(START) < F.col(seq)).select(
        *[F.col(k).alias(b) for k, b in zip(spec.keys, bounds)],
        F.col(START).alias("__low"), F.col(seq).alias("__high"),
        F.struct(F.lit(1), *[orderable(table, c) for c in tracked]).alias("__was"),
    )
    new = batch.select(*spec.keys, seq, F.struct(F.lit(1), *[orderable(batch, c) for c in tracked]).alias("__is"))
    same_key = [F.col(k).eqNullSafe(F.col(b)) for k, b in zip(spec.keys, bounds)]

    def meets(key: list[Column]) -> Column:
        return _all(key) & F.col(seq).between(F.col("__low"), F.col("__high"))

    splits = (F.col(seq) == F.col("__low")) | ~F.col("__was").eqNullSafe(F.col("__is"))
    hit = runs.join(new, meets(same_key) & splits, "left_semi").drop("__was")
    folder = f"{_splits(spec, layers)}/{uuid.uuid4().hex}"
    hit.write.parquet(folder)
    hit = session.read.schema(hit.schema).parquet(folder)
    ends = hit.agg(F.min("__low"), F.max("__high")).first()
    inner = session.createDataFrame([], schema)
    if ends[0] is not None:
        log = _from_log(session, spec, schema, layers, touched, (ends[0], ends[1]))
        inner = log.join(hit, meets(same_key), "left_semi").select(*names)
        table = table.join(hit, _all(same_key) & (F.col(START) == F.col("__low")), "left_anti")
    first = table.where(F.col(START) < F.col(seq)).withColumn(seq, F.col(START))
    points = table.select(*names).unionByName(first.select(*names)).unionByName(inner)
    return points.unionByName(batch.select(*names))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out &= condition
    return out


def _splits(spec: CdcSpec, layers: Layers) -> str:
    """Where a merge keeps the runs that its new rows split, until it is done."""
    return layers.state("split", spec.flow)


def _attempts(spec: CdcSpec, layers: Layers) -> str:
    return layers.state("attempt", spec.flow)


def _begin(session: SparkSession, spec: CdcSpec, layers: Layers, touched: list[int] | None) -> None:
    """Name the buckets that are about to be overwritten, in a small file of this attempt's own."""
    text = WHOLE if touched is None else " ".join(map(str, touched))
    put_marker(session, f"{_attempts(spec, layers)}/{uuid.uuid4().hex}", f"{text} {ENDED}")


def _left(session: SparkSession, spec: CdcSpec, layers: Layers) -> str | list[int] | None:
    """What attempts that didn't end have named: buckets, WHOLE, or None if there are none.

    A file that isn't complete stands for the whole table.
    """
    texts = read_markers(session, _attempts(spec, layers))
    old = read_marker(session, f"{layers.state('apply', spec.flow)}/in_progress")
    named: set[int] = set()
    for text in [*texts, *([] if old is None else [""])]:
        words = text.split()
        if not words or words[-1] != ENDED or words[0] == WHOLE:
            return WHOLE
        named.update(map(int, words[:-1]))
    return sorted(named) if texts else None


def _done(session: SparkSession, spec: CdcSpec, layers: Layers) -> None:
    remove_folder(session, _attempts(spec, layers))
    remove_folder(session, _splits(spec, layers))
    remove_folder(session, f"{layers.state('apply', spec.flow)}/in_progress")


def _overwrite(
    session: SparkSession, rows: DataFrame, spec: CdcSpec, schema: T.StructType, layers: Layers,
    touched: list[int] | None, affected: Column, anew: bool,
) -> None:
    """Bring the affected partitions, or the whole table (``anew``), to the state that ``rows`` amount to."""
    target, state = layers.path("gold", spec.table), state_of(rows, spec)
    if anew or not (spec.untracked and spec.by_period):
        _begin(session, spec, layers, touched)
        _replace(state, spec, target, balance=anew)
        _done(session, spec, layers)
        return
    # Versions can grow together, so a partition may lose its last row: such are removed by name. The state
    # is written apart first, as its partitions must be known and it reads what is overwritten.
    folder, parts = scratch_dir(session, "state"), [BUCKET, UNTIL]
    state.write.parquet(folder)
    state = session.read.schema(state.schema).parquet(folder)
    there = _read_target(session, spec, layers, schema).where(affected).select(*parts).distinct()
    # One row per partition at most.
    emptied = there.join(state.select(*parts).distinct(), parts, "left_anti").collect()
    _begin(session, spec, layers, touched)
    _replace(state, spec, target)
    for row in emptied:
        remove_folder(session, f"{target}/{BUCKET}={row[BUCKET]}/{UNTIL}={row[UNTIL]}")
    _done(session, spec, layers)
    remove_folder(session, folder)


def apply_changes(
    spark: SparkSession,
    spec: CdcSpec,
    schema: T.StructType,
    layers: Layers,
    interval: str = "1 minute",
    tally: Any = None,
) -> StreamingQuery:
    """Keep the gold table up to date with its log. ``schema`` is that of the staged rows; a ``tally`` counts the
    partitions that are written.

    Only partitions that a micro-batch can change are read and overwritten. The overwrite is not
    atomic, so a small file that names the buckets stands while it lasts; a run that finds some left
    behind writes those buckets anew from the log. What the table is kept by is remembered beside it: under
    another spec, rows in quarantine that its rules let through join the log, and the table is
    first written anew as a whole.
    """
    spec = spec.resolved(schema)
    target = layers.path("gold", spec.table)
    known = _known(spark, spec, layers)
    if known and known[-1] != spec.fingerprint:
        release(spark, spec, schema, layers)
    if has_data(spark, target) and (not known or known[-1] != spec.fingerprint):
        rebuild(spark, spec, schema, layers)
        if tally:
            tally.put_gold(_read_target(spark, spec, layers, schema), F.lit(True))
    _remember(spark, spec, layers)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The query's own copy of the session, so the settings stay in this flow.
        session = batch.sparkSession
        for name, value in _aligned(session, spec).items():
            session.conf.set(name, value)
        touched = _touched(batch, spec)
        if touched == []:
            return
        _check(batch, spec)
        # One row per batch of the log.
        names = [row[0] for row in batch.select(BATCH).distinct().collect()]
        left = _left(session, spec, layers)
        new = not has_data(session, target)
        if left is not None:
            touched = sorted({*touched, *left}) if left != WHOLE and touched is not None else None
        if new:
            touched = None
        from_log = left is not None or new or spec.merge == "log"
        if from_log:
            rows = _from_log(session, spec, schema, layers, touched)
            affected = F.lit(True) if touched is None else F.col(BUCKET).isin(touched)
        else:
            rows, affected = _with_table(batch, spec, schema, layers, touched)
        anew = from_log and touched is None
        _overwrite(session, rows, spec, schema, layers, touched, affected, anew)
        if tally:
            tally.put_gold(_read_target(session, spec, layers, schema), F.lit(True) if anew else affected)
        mark_applied(session, spec, layers, names)
        if due(session, spec, layers):
            compact(session, spec, schema, layers)

    # Files that were compacted away before a batch was marked done have been applied.
    writer = (
        spark.readStream.schema(log_schema(schema))
        .option("ignoreMissingFiles", True)
        .parquet(log_path(spec, layers))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", layers.checkpoint(f"{spec.flow}_apply"))
    )
    writer = writer.trigger(availableNow=True) if spec.once else writer.trigger(processingTime=interval)
    query = writer.start()
    if spec.once:
        query.awaitTermination()
    return query


def rebuild(spark: SparkSession, spec: CdcSpec, schema: T.StructType, layers: Layers) -> None:
    """Write the whole gold table anew from the log; nothing of the old one stays."""
    spec = spec.resolved(schema)
    session = session_copy(spark)
    for name, value in _aligned(session, spec).items():
        session.conf.set(name, value)
    rows = _from_log(session, spec, schema, layers, None)
    _check(rows, spec)
    _begin(session, spec, layers, None)
    _replace(state_of(rows, spec), spec, layers.path("gold", spec.table), balance=True)
    _remember(session, spec, layers)
    _done(session, spec, layers)


def gold_schema(schema: T.StructType, spec: CdcSpec) -> T.StructType:
    """The columns of the gold table for staged rows of this schema, without the partitions."""
    if spec.scd_type == 1:
        return schema
    moment = schema[spec.sequence_by].dataType
    return T.StructType([*schema.fields, T.StructField(START, moment), T.StructField(END, moment)])


def target_schema(schema: T.StructType, spec: CdcSpec) -> T.StructType:
    """The same with the partition columns; ``spec`` is resolved."""
    parts = [T.StructField(BUCKET, T.LongType())]
    if spec.by_period:
        parts.append(T.StructField(UNTIL, T.DateType()))
    return T.StructType([*gold_schema(schema, spec).fields, *parts])


def _read_target(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType
) -> DataFrame:
    full = target_schema(schema, spec)
    return spark.read.schema(full).parquet(layers.path("gold", spec.table))


def read_gold(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType | None = None
) -> DataFrame:
    """The gold table without its partition columns; columns added over time read as NULL before.

    Given the schema of the staged rows, no footer is opened for planning.
    """
    if schema is not None:
        spec = spec.resolved(schema)
    else:
        path = layers.path("gold", spec.table)
        return spark.read.option("mergeSchema", True).parquet(path).drop(BUCKET, UNTIL)
    return _read_target(spark, spec, layers, schema).drop(BUCKET, UNTIL)


def read_current(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType
) -> DataFrame:
    """The current version of each key; a table kept by period is read in that part only."""
    spec = spec.resolved(schema)
    table = _read_target(spark, spec, layers, schema)
    if spec.by_period:
        table = table.where(F.col(UNTIL) == F.lit(OPEN))
    elif spec.scd_type == 2:
        table = table.where(F.col(END).isNull())
    return table.drop(BUCKET, UNTIL)


def _since(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType, moment: Column
) -> DataFrame:
    """The versions that end after a moment, or haven't; of a table kept by period in those periods only."""
    table = _read_target(spark, spec, layers, schema)
    if spec.by_period:
        floor = period_of(moment, schema[spec.sequence_by].dataType, spec.period)
        table = table.where(F.col(UNTIL) >= floor)
    return table.where(F.col(END).isNull() | (F.col(END) > moment)).drop(BUCKET, UNTIL)


def read_as_of(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType, moment: Any
) -> DataFrame:
    """The versions of a history that were valid at a moment; the start belongs to a version, the end doesn't.

    Only periods that end after the moment are read.
    """
    spec = spec.resolved(schema)
    at = bound(moment, schema[spec.sequence_by].dataType)
    return _since(spark, spec, layers, schema, at).where(F.col(START) <= at)


def changes_between(
    spark: SparkSession, spec: CdcSpec, layers: Layers, schema: T.StructType, after: Any, upto: Any
) -> DataFrame:
    """What happened to a history with ``after < time <= upto``, as versions with a column ``__change``.

    ``opened``: the first version of a key, or one that takes the place of none; ``updated``: a version
    whose start is another's end; ``closed``: a version that ended, its end being the time. So an update is two
    rows, the version that came and the one that went. With untracked columns a version counts by its
    first change. Only periods that end after ``after`` are read.
    """
    spec = spec.resolved(schema)
    kind = schema[spec.sequence_by].dataType
    low, high = bound(after, kind), bound(upto, kind)
    # A version that ends at the first moment after ``after`` is needed to tell an update from an opening.
    table = _since(spark, spec, layers, schema, low).where(F.col(START) <= high)
    closed = table.where((F.col(END) > low) & (F.col(END) <= high))
    came = table.where(F.col(START) > low)
    ends = closed.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(spec.keys)], F.col(END).alias("__ended"))
    same = _all([F.col(k).eqNullSafe(F.col(f"__k{n}")) for n, k in enumerate(spec.keys)])
    follows = came.join(ends, same & (F.col(START) == F.col("__ended")), "left")
    kind_of = F.when(F.col("__ended").isNull(), F.lit("opened")).otherwise(F.lit("updated"))
    news = follows.select(*table.columns, kind_of.alias("__change"))
    return news.unionAll(closed.select(*table.columns, F.lit("closed").alias("__change")))
