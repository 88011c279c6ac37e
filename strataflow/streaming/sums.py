"""Sums over a gold table that are kept by its partitions: what a run didn't rewrite is not read again.

A gold table changes by whole partitions, and the files of a rewritten partition have new names. So a part of the
sums belongs to a partition *with its files*: rewriting the partition takes its old part back and asks for a
new one, whatever the rows were (new keys, late rows, versions that ended, rows that a rule now keeps out).
A run that breaks off leaves nothing that counts, and one that is repeated finds nothing to do.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import CdcSpec, Layers
from strataflow.session import children, make_folder, path_exists, put_marker, remove_folder
from strataflow.streaming.cdc import UNTIL, gold_schema, target_schema
from strataflow.streaming.changelog import BUCKET

PART, ROWS = "__part", "__rows"
#: Runs whose parts lie apart; beyond, they are written together.
MOST_RUNS = 16
#: Partitions that a job is told by name.
AT_ONCE = 1_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class SumSpec:
    """Sums of ``values`` (name: SQL expression, scale) per ``by`` over the rows of a gold table that pass ``where``.

    Values are rounded to ``scale`` digits and summed as decimals, so sums of parts are the sums of the rows.
    ``by`` are columns of the table. A change of the spec needs another name.
    """

    name: str
    cdc: CdcSpec
    by: Sequence[str]
    values: dict[str, tuple[str, int]]
    where: str | None = None

    @property
    def fingerprint(self) -> str:
        shape = (list(self.by), sorted(self.values.items()), self.where)
        return hashlib.md5(repr(shape).encode()).hexdigest()[:8]


def _folder(spec: SumSpec, layers: Layers) -> str:
    return layers.state("sums", f"{spec.name}-{spec.fingerprint}")


def _partitions(gold: DataFrame) -> dict[str, dict[str, str]]:
    """Of each partition that has files: its values, under a digest of them and the files' names.

    Nothing is read but the listing that the frame has.
    """
    files: dict[str, list[str]] = defaultdict(list)
    for file in gold.inputFiles():
        place, name = file.rsplit("/", 1)
        files[place].append(name)
    found = {}
    for place, names in files.items():
        steps = [step for step in place.split("/") if step.partition("=")[0] in (BUCKET, UNTIL)]
        digest = hashlib.md5("\n".join([*steps, *sorted(names)]).encode()).hexdigest()
        found[digest] = dict(step.split("=", 1) for step in steps)
    return found


def _in(values: dict[str, str], columns: Sequence[str], frame: DataFrame) -> list[Column]:
    """The values of a partition as literals; a folder for none is NULL."""
    return [
        F.lit(None if values[c] == NO_VALUE else values[c]).cast(frame.schema[c].dataType) for c in columns
    ]


def _runs(spark: SparkSession, folder: str) -> list[str]:
    """Runs that were written to their end, the newest first; the others go."""
    done = []
    for name in sorted(children(spark, folder), reverse=True):
        if path_exists(spark, f"{folder}/{name}/_done"):
            done.append(f"{folder}/{name}")
        else:
            remove_folder(spark, f"{folder}/{name}")
    return done


def _new_run(spark: SparkSession, folder: str, parts: DataFrame | None, before: list[str]) -> str:
    """Write the parts of a run; it counts once its marker is there."""
    number = 1 + max([int(run.rsplit("/", 1)[1].split("-")[0]) for run in before], default=0)
    run = f"{folder}/{number:08d}-{uuid.uuid4().hex[:8]}"
    make_folder(spark, run)
    if parts is not None:
        parts.write.partitionBy(PART).parquet(f"{run}/parts")
    return run


def _total(spec: SumSpec, rows: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    keys = [*spec.by, *parts]
    sums = [F.sum(name).cast(f"decimal(38,{scale})").alias(name) for name, (_, scale) in spec.values.items()]
    return rows.groupBy(*keys).agg(*sums, F.sum(ROWS).alias(ROWS))


def _parts_of(spec: SumSpec, gold: DataFrame, new: dict[str, dict[str, str]]) -> DataFrame:
    """The sums of each of some partitions, by the digest it goes under; only these partitions are read."""
    columns = [c for c in (UNTIL, BUCKET) if c in next(iter(new.values()))]
    groups: dict[str | None, list[str]] = defaultdict(list)
    for values in new.values():
        groups[values.get(UNTIL)].append(values[BUCKET])
    wanted = F.lit(False)
    for until, buckets in groups.items():
        named = F.col(BUCKET).isin([int(b) for b in buckets if b != NO_VALUE])
        if NO_VALUE in buckets:
            named = F.coalesce(named, F.lit(True))
        if until is not None:
            named &= F.col(UNTIL) == F.lit(until).cast("date")
        wanted |= named
    listed = [
        F.struct(F.lit(digest).alias(PART), *[v.alias(f"__{c}") for v, c in zip(_in(values, columns, gold), columns)])
        for digest, values in new.items()
    ]
    listed = gold.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*listed)))
    same = F.lit(True)
    for c in columns:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    rows = gold.where(wanted)
    if spec.where:
        rows = rows.where(spec.where)
    values_ = [F.expr(text).cast(f"decimal(38,{scale})").alias(name) for name, (text, scale) in spec.values.items()]
    rows = rows.select(*spec.by, *columns, *values_, F.lit(1).cast("long").alias(ROWS))
    # Partitions are summed first, so that the digests meet few rows.
    sums = _total(spec, rows, columns)
    return sums.join(F.broadcast(listed), same).select(*spec.by, *spec.values, ROWS, PART)


def kept_sums(spark: SparkSession, spec: SumSpec, layers: Layers, schema: T.StructType) -> DataFrame:
    """The sums as of now: ``by``, the values, and ``n_rows``.

    Reads the partitions of the gold table that have changed since the last call (all at the first), and the parts
    kept for the others. Groups without rows any more are gone. NULLs form a group of their own; a sum of
    NULLs only is NULL. One writer at a time, as for the table.
    """
    cdc, folder = spec.cdc.resolved(schema), _folder(spec, layers)
    path = layers.path("gold", cdc.table)
    full, columns = target_schema(schema, cdc), gold_schema(schema, cdc).names
    unknown = sorted(set(spec.by) - set(columns))
    if unknown:
        raise ValueError(f"{spec.name}: the table has no {', '.join(unknown)}")
    # The listing is this frame's own; what is written meanwhile is for the next call.
    gold = spark.read.schema(full).parquet(path)
    now = _partitions(gold)
    before = _runs(spark, folder)
    have: set[str] = set()
    for run in before:
        for child in children(spark, f"{run}/parts"):
            digest = child.partition("=")[2]
            if digest and (digest not in now or digest in have):
                remove_folder(spark, f"{run}/parts/{child}")
            elif digest:
                have.add(digest)
        have |= set(children(spark, f"{run}/empty")) & set(now)
    new = [(digest, values) for digest, values in now.items() if digest not in have]
    runs = list(before)
    for at in range(0, len(new), AT_ONCE):
        some = dict(new[at : at + AT_ONCE])
        run = _new_run(spark, folder, _parts_of(spec, gold, some), runs)
        found = {child.partition("=")[2] for child in children(spark, f"{run}/parts")}
        # A partition of which no row passes has no part, which is worth knowing.
        for digest in set(some) - found:
            put_marker(spark, f"{run}/empty/{digest}")
        put_marker(spark, f"{run}/_done")
        runs.insert(0, run)
    parts = [f"{run}/parts" for run in runs if any("=" in c for c in children(spark, f"{run}/parts"))]
    if len(runs) > MOST_RUNS:
        old, together = runs, _read(spark, spec, layers, schema, parts) if parts else None
        run = _new_run(spark, folder, together, runs)
        for digest in {d for r in old for d in children(spark, f"{r}/empty")} & set(now):
            put_marker(spark, f"{run}/empty/{digest}")
        put_marker(spark, f"{run}/_done")
        for r in old:
            remove_folder(spark, r)
        parts = [f"{run}/parts"] if together is not None else []
    rows = _read(spark, spec, layers, schema, parts)
    return _total(spec, rows).withColumnRenamed(ROWS, "n_rows")


def _read(
    spark: SparkSession, spec: SumSpec, layers: Layers, schema: T.StructType, parts: Sequence[str]
) -> DataFrame:
    """The parts of some runs, by a schema that no footer is opened for."""
    known = gold_schema(schema, spec.cdc.resolved(schema))
    fields = [known[c] for c in spec.by]
    fields += [T.StructField(name, T.DecimalType(38, scale)) for name, (_, scale) in spec.values.items()]
    kept = T.StructType([*fields, T.StructField(ROWS, T.LongType()), T.StructField(PART, T.StringType())])
    if not parts:
        return spark.createDataFrame([], kept)
    frames = [spark.read.schema(kept).parquet(part) for part in parts]
    all_ = frames[0]
    for frame in frames[1:]:
        all_ = all_.unionAll(frame)
    return all_
