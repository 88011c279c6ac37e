"""Finding keys with too many rows for one task, and cutting their rows into ordered runs.

A window over a key sorts all its rows in one task. For a key that holds a large share of a
table that task never ends, so such a key's rows are cut at chosen sequence values into chunks,
each of which is a task's worth, and only one summary row per chunk is compared across chunks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import SkewPolicy
from strataflow.functions.keys import key_hash, search_steps, upper_bound

CHUNK = "__chunk"
SAMPLES_PER_CHUNK = 20
MAX_CHUNKS = 4_096


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; filters do not lower it and joins multiply it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(kind: T.DataType) -> int:
    """About what a value, or a row as a struct, takes in memory."""
    if isinstance(kind, T.StructType):
        return 8 + sum(row_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return 100
    return 8 if isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType)) else 28


def fitted(policy: SkewPolicy, schema: T.StructType) -> SkewPolicy:
    """The policy for a task that holds rows of this schema in memory, sorted.

    Files hold rows several times as densely, so inputs are examined from a quarter of a task's bytes on.
    """
    return replace(
        policy,
        rows_per_task=min(policy.rows_per_task, max(1, policy.bytes_per_task // row_bytes(schema))),
        check_above_bytes=min(policy.check_above_bytes, policy.bytes_per_task // 4),
    )


def find_hot(df: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> list[int]:
    """Hashes of the keys with about ``rows_per_task`` rows or more; empty for small inputs.

    One pass over the key columns. Tasks send frequent-item sketches of bounded size, not keys,
    and the sketches are merged in two steps. What the sketch may miss is a key with fewer
    rows than a few ten-thousandths of the table.
    """
    if estimated_bytes(df) <= policy.check_above_bytes:
        return []
    top = (
        df.select(key_hash(keys).alias("h"), (F.spark_partition_id() % 256).alias("part"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate(h, {policy.tracked_items})").alias("sketch"))
        # A group of its own, so that an empty input gives no row rather than an error.
        .groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {policy.tracked_items})").alias("sketch"))
        .select(F.expr(f"inline(approx_top_k_estimate(sketch, {policy.max_hot_keys}))"))
    )
    # At most max_hot_keys rows.
    return [row["item"] for row in top.collect() if row["count"] >= policy.rows_per_task]


def is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    return key_hash(keys).isin(list(hot))


@dataclass(frozen=True)
class Cuts:
    """Sorted sequence values at which the rows of each hot key are cut."""

    values: dict[int, list]
    data_type: T.DataType

    def table(self, df: DataFrame) -> DataFrame:
        schema = T.StructType([
            T.StructField("__hash", T.LongType(), False),
            T.StructField("__cuts", T.ArrayType(self.data_type), False),
        ])
        return df.sparkSession.createDataFrame(list(self.values.items()), schema)


def choose_cuts(heavy: DataFrame, keys: Sequence[str], sequence_by: str, policy: SkewPolicy) -> Cuts:
    """Cut values from a thin sample of the hot keys' sequence values.

    The sample holds about ``SAMPLES_PER_CHUNK`` values per chunk, whatever the table's size. It only
    places the cuts: every row still goes through, and any placement gives the same result.
    """
    fraction = min(1.0, SAMPLES_PER_CHUNK / policy.rows_per_task)
    sample = heavy.select(key_hash(keys).alias("h"), F.col(sequence_by).alias("s")).sample(fraction, 17)
    found: dict[int, list] = defaultdict(list)
    for row in sample.collect():
        found[row["h"]].append(row["s"])
    cuts = {}
    for item, values in found.items():
        values.sort()
        stride = max(SAMPLES_PER_CHUNK, -(-len(values) // MAX_CHUNKS))
        cuts[item] = sorted(set(values[stride::stride]))
    return Cuts(cuts, heavy.schema[sequence_by].dataType)


def with_chunk(df: DataFrame, keys: Sequence[str], sequence_by: str, cuts: Cuts) -> DataFrame:
    """Add the chunk number: how many cuts are at or before the row's sequence value.

    The table of cuts is a literal made on the driver, a few values per task of the job.
    """
    longest = max((len(v) for v in cuts.values.values()), default=0)
    chunk = upper_bound(F.col("__cuts"), F.col(sequence_by), search_steps(longest))
    return (
        df.withColumn("__hash", key_hash(keys))
        .join(F.broadcast(cuts.table(df)), "__hash", "left")
        .withColumn(CHUNK, F.when(F.col("__cuts").isNull(), 0).otherwise(chunk))
        .drop("__hash", "__cuts")
    )


def across(keys: Sequence[str]) -> WindowSpec:
    """The chunks of a key in order; for frames with one row per chunk."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def attach(rows: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give each row its chunk's edge columns; NULL keys match each other.

    There are as many edges as tasks' worths of hot rows, few enough to send everywhere.
    """
    names = {c: f"__e{i}" for i, c in enumerate([*keys, CHUNK])}
    edges = edges.withColumnsRenamed(names)
    match = reduce(
        lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(e)) for c, e in names.items())
    )
    return rows.join(F.broadcast(edges), match, "left").drop(*names.values())
