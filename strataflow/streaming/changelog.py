"""The log of change rows behind a gold table: written once per batch, read by bucket, kept short.

A micro-batch is written in one pass, parted by verdict, and then moved into place as a whole: the rows
that pass the rules into the log, the others into quarantine. A batch that is there already is not written
again. ``compact`` gathers the batches that the table has taken into segments, by bucket and period. One
small file, the newest manifest, says which segments count and which batches they hold, so a
compaction takes effect with that file or not at all. Segments are merged while they are of like size, so a row
is written again about as often as the logarithm of the log's size, and a bucket has few files.
"""

from __future__ import annotations

import uuid
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.config import CdcSpec, Layers
from strataflow.functions.keys import bucket_of, period_of, row_digest
from strataflow.operators.quality import FAILED, classify
from strataflow.session import (
    children, make_folder, move, path_exists, put_marker, read_marker, read_markers, remove_folder,
)

BUCKET = "__bucket"
BATCH = "__batch"
# The period of a change, in segments; rows at no time have none.
AT = "__at"
VERDICT = "__ok"
# A segment joins the next compaction unless it has more than so many times its rows.
RATIO = 4
END_MARK = "."


def rules_of(spec: CdcSpec) -> dict[str, str]:
    """What keeps a row out of the log: the table's rules, unless they stop the flow, and that it must
    say when it happened."""
    rules = dict(spec.rules) if spec.on_broken == "drop" else {}
    return {**rules, "has_sequence": f"`{spec.sequence_by}` IS NOT NULL"}


def log_path(spec: CdcSpec, layers: Layers) -> str:
    return layers.path("stg", spec.table)


def log_schema(source_schema: T.StructType) -> T.StructType:
    added = [T.StructField(BATCH, T.StringType()), T.StructField(BUCKET, T.LongType())]
    return T.StructType([*source_schema.fields, *added])


def checkpoint_token(spark: SparkSession, checkpoint: str) -> str:
    """A name for the checkpoint's life, so that batches of a new one never pass for those of an old one."""
    path = f"{checkpoint}/_token"
    known = read_marker(spark, path)
    if not known:
        known = uuid.uuid4().hex[:8]
        put_marker(spark, path, known)
    return known


def _write_batch(
    rows: DataFrame, spec: CdcSpec, layers: Layers, name: str, rules: dict[str, str], quarantine: bool,
    tally: Any = None,
) -> None:
    """Rows of one batch into the log and, of those that fail a rule, into quarantine; in one pass."""
    spark = rows.sparkSession
    places = {"true": f"{log_path(spec, layers)}/{BATCH}={name}"}
    if quarantine:
        places["false"] = f"{layers.path('quarantine', spec.table)}/{BATCH}={name}"
    if all(path_exists(spark, place) for place in places.values()):
        return
    passes = F.size(FAILED) == 0
    marked = classify(rows, rules).withColumn(VERDICT, passes)
    marked = marked if quarantine or tally else marked.where(VERDICT)
    own = bucket_of(spec.keys, spec.buckets, spec.bucket_expr)
    marked = marked.withColumn(BUCKET, F.when(F.col(VERDICT), own).otherwise(F.lit(-1).cast("long")))
    incoming = f"{layers.path('stg', '_incoming')}/{spec.table}-{name}-{uuid.uuid4().hex[:8]}"
    # Sized by bytes: small buckets share a task, a large bucket gets many.
    marked = marked.hint("rebalance", VERDICT, BUCKET)
    if tally:
        # Behind the shuffle, where a task that is run again is not counted again.
        marked, counted = tally.watched(marked)
        marked = marked if quarantine else marked.where(VERDICT)
    marked.write.partitionBy(VERDICT, BUCKET).parquet(incoming)
    # Quarantine first: a batch that is in the log is done.
    for verdict in ("false", "true"):
        if verdict in places and not path_exists(spark, places[verdict]):
            part = f"{incoming}/{VERDICT}={verdict}"
            if path_exists(spark, part):
                move(spark, part, places[verdict])
            else:
                make_folder(spark, places[verdict])
    remove_folder(spark, incoming)
    if tally:
        tally.put("silver", name, counted)


def stage(
    source: DataFrame,
    spec: CdcSpec,
    layers: Layers,
    quarantine: bool = False,
    interval: str = "1 minute",
    tally: Any = None,
) -> list[StreamingQuery]:
    """Append a stream of change rows to the table's log; optionally keep the rejected rows, and count all.

    The source is read once: valid and rejected rows are told apart as they are written.
    """
    spark, rules = source.sparkSession, rules_of(spec)
    log, checkpoint = log_path(spec, layers), layers.checkpoint(f"{spec.flow}_stg")
    if path_exists(spark, f"{log}/_spark_metadata"):
        raise ValueError(f"{log} is a log of an earlier layout; stage its source anew under another base")
    make_folder(spark, log)
    token = checkpoint_token(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, spec, layers, f"{batch_id:012d}-{token}", rules, quarantine, tally)

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if spec.once else writer.trigger(processingTime=interval)
    query = writer.start()
    if spec.once:
        query.awaitTermination()
    return [query]


class Manifest(NamedTuple):
    """Segments with their rows, oldest first, and the batches that the last compaction took."""

    number: int = 0
    segments: tuple[tuple[str, int], ...] = ()
    taken: tuple[str, ...] = ()

    def text(self) -> str:
        lines = [*(f"segment {name} {rows}" for name, rows in self.segments)]
        return "\n".join([*lines, *(f"taken {name}" for name in self.taken), END_MARK])


def _manifests(spec: CdcSpec, layers: Layers) -> str:
    return layers.state("compact", spec.table)


def manifest(spark: SparkSession, spec: CdcSpec, layers: Layers) -> Manifest:
    """The newest manifest that was written to its end."""
    newest = Manifest()
    for number, text in enumerate(read_markers(spark, _manifests(spec, layers)), 1):
        lines = text.splitlines()
        if not lines or lines[-1] != END_MARK:
            newest = newest._replace(number=number)
            continue
        parts = [line.split() for line in lines[:-1]]
        segments = tuple((p[1], int(p[2])) for p in parts if p[0] == "segment")
        newest = Manifest(number, segments, tuple(p[1] for p in parts if p[0] == "taken"))
    return newest


def _segment_path(spec: CdcSpec, layers: Layers, name: str) -> str:
    return f"{layers.path('stg_segments', spec.table)}/{name}"


def batches(spark: SparkSession, spec: CdcSpec, layers: Layers) -> list[str]:
    """The batches that the log has beside its segments, oldest first."""
    taken = set(manifest(spark, spec, layers).taken)
    names = [n.partition("=")[2] for n in children(spark, log_path(spec, layers)) if n.startswith(BATCH)]
    return sorted(n for n in names if n not in taken)


def _timed(schema: T.StructType, spec: CdcSpec) -> bool:
    kind = schema[spec.sequence_by].dataType
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def read_log(
    spark: SparkSession,
    spec: CdcSpec,
    schema: T.StructType,
    layers: Layers,
    buckets: list[int] | None = None,
    between: tuple[Any, Any] | None = None,
    known_schemes: bool = True,
) -> DataFrame:
    """The change rows of the log, of some buckets or all, with a sequence between two values or any.

    Segments are read in those buckets and periods only. ``known_schemes`` says that all of the log is
    laid out by the buckets of ``spec``; else they are worked out from the keys.
    """
    bucket = F.col(BUCKET) if known_schemes else bucket_of(spec.keys, spec.buckets, spec.bucket_expr)
    wanted = F.lit(True) if buckets is None else bucket.isin(buckets)
    if between:
        wanted &= F.col(spec.sequence_by).between(*map(F.lit, between))
    log, found = log_path(spec, layers), []
    now = manifest(spark, spec, layers)
    tail = [f"{log}/{BATCH}={name}" for name in batches(spark, spec, layers)]
    if tail:
        reader = spark.read.schema(log_schema(schema)).option("basePath", log)
        found.append(reader.parquet(*tail).where(wanted).select(*schema.names))
    parts = [T.StructField(BUCKET, T.LongType())]
    if _timed(schema, spec):
        parts.append(T.StructField(AT, T.DateType()))
    for name, _ in now.segments:
        held = spark.read.schema(T.StructType([*schema.fields, *parts]))
        held = held.parquet(_segment_path(spec, layers, name)).where(wanted)
        if between and _timed(schema, spec):
            low, high = (_period(F.lit(x), schema, spec) for x in between)
            held = held.where(F.col(AT).between(low, high))
        found.append(held.select(*schema.names))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _period(moment: Column, schema: T.StructType, spec: CdcSpec) -> Column:
    return period_of(moment, schema[spec.sequence_by].dataType, spec.period)


def _applied(spec: CdcSpec, layers: Layers) -> str:
    return layers.state("applied", spec.table)


def mark_applied(spark: SparkSession, spec: CdcSpec, layers: Layers, names: list[str]) -> None:
    """Note that the gold table has these batches; only such are compacted."""
    for name in names:
        put_marker(spark, f"{_applied(spec, layers)}/{name}")


def due(spark: SparkSession, spec: CdcSpec, layers: Layers) -> bool:
    """Whether so many batches have been applied that the log should be compacted."""
    return bool(spec.compact_after) and len(children(spark, _applied(spec, layers))) >= spec.compact_after


def compact(spark: SparkSession, spec: CdcSpec, schema: T.StructType, layers: Layers) -> bool:
    """Gather the applied batches, and segments of like size, into one segment; False if there are none.

    Exact copies of a change go; rows that a rule leaves out of the table stay, as rules can change.
    What is replaced is removed after the new manifest stands; a run cut short before that leaves
    an unnamed folder, one cut short after it leaves folders that no reader looks at.
    """
    applied = set(children(spark, _applied(spec, layers)))
    now, log = manifest(spark, spec, layers), log_path(spec, layers)
    names = [name for name in batches(spark, spec, layers) if name in applied]
    if not names:
        return False
    reader = spark.read.schema(log_schema(schema)).option("basePath", log)
    rows = reader.parquet(*[f"{log}/{BATCH}={name}" for name in names]).select(*schema.names)
    count, kept = rows.count(), list(now.segments)
    while kept and kept[-1][1] <= RATIO * count:
        name, more = kept.pop()
        old = spark.read.schema(schema).parquet(_segment_path(spec, layers, name))
        rows, count = rows.unionAll(old.select(*schema.names)), count + more
    payload = [c for c in schema.names if c not in {*spec.keys, spec.sequence_by}]
    digests = ["__d1", "__d2"]
    rows = rows.withColumns(dict(zip(digests, row_digest(rows, payload))))
    rows = rows.dropDuplicates([*spec.keys, spec.sequence_by, *digests]).drop(*digests)
    rows = rows.withColumn(BUCKET, bucket_of(spec.keys, spec.buckets, spec.bucket_expr))
    parts = [BUCKET]
    if _timed(schema, spec):
        rows, parts = rows.withColumn(AT, _period(F.col(spec.sequence_by), schema, spec)), [BUCKET, AT]
    name = f"{now.number + 1:08d}-{uuid.uuid4().hex[:8]}"
    target = _segment_path(spec, layers, name)
    laid = rows.hint("rebalance", *parts).sortWithinPartitions(*parts, spec.sequence_by)
    laid.write.partitionBy(*parts).parquet(target)
    written = spark.read.parquet(target).count()
    after = Manifest(now.number + 1, (*kept, (name, written)), tuple(names))
    put_marker(spark, f"{_manifests(spec, layers)}/{after.number:08d}", after.text())
    for old in {*now.taken, *names}:
        remove_folder(spark, f"{log}/{BATCH}={old}")
        remove_folder(spark, f"{_applied(spec, layers)}/{old}")
    counted = {n for n, _ in after.segments}
    for old in children(spark, layers.path("stg_segments", spec.table)):
        if old not in counted:
            remove_folder(spark, _segment_path(spec, layers, old))
    return True


def release(spark: SparkSession, spec: CdcSpec, schema: T.StructType, layers: Layers) -> int:
    """Move the rows of the quarantine that pass the rules of ``spec`` into the log; how many there were.

    They come into the table with the next run. A run cut short may leave a row in both places, where it does
    no harm: a repeated change counts once.
    """
    place = layers.path("quarantine", spec.table)
    held = [n for n in children(spark, place) if n.startswith(BATCH)]
    if not held:
        return 0
    kept = T.StructType([*schema.fields, T.StructField(FAILED, T.ArrayType(T.StringType()))])
    reader = spark.read.schema(kept).option("basePath", place)
    rows = reader.parquet(*[f"{place}/{n}" for n in held]).select(*schema.names)
    free = rows.count() - classify(rows, rules_of(spec)).where(F.size(FAILED) > 0).count()
    if not free:
        return 0
    _write_batch(rows, spec, layers, f"released-{uuid.uuid4().hex}", rules_of(spec), quarantine=True)
    for name in held:
        remove_folder(spark, f"{place}/{name}")
    return free
