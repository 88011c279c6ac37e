"""Expressions over key, sequence and payload columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def bucket_of(keys: Sequence[str], buckets: int, expression: str | None = None) -> Column:
    """The bucket of a key: a hash modulo ``buckets``, or an expression over the keys.

    The hash is the one shuffles use, so a shuffle by the same keys into a multiple of
    ``buckets`` partitions leaves each task with the rows of few buckets to write.
    """
    if expression:
        # A key without a bucket still needs one that can be asked for.
        return F.coalesce(F.expr(expression).cast("long"), F.lit(-1).cast("long"))
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("long")


def day_of(moment: Column, data_type: T.DataType) -> Column:
    """The day of a date or time, in any session zone; instants count in UTC."""
    if isinstance(data_type, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(moment) / 86_400_000_000).cast("int"))
    if isinstance(data_type, (T.DateType, T.TimestampNTZType)):
        return F.to_date(moment)
    raise ValueError(f"a period needs a date or time, not {data_type.simpleString()}")


def to_micros(moment: Column, data_type: T.DataType) -> Column:
    """A date or time as a number; wall-clock times as if they were in UTC."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(moment)
    if isinstance(data_type, T.DateType):
        return F.unix_date(moment).cast("long") * 86_400_000_000
    day = F.unix_date(F.to_date(moment)).cast("long") * 86_400_000_000
    clock = (F.hour(moment) * 3600 + F.minute(moment) * 60).cast("long")
    return day + clock * 1_000_000 + (F.date_part(F.lit("SECOND"), moment) * 1_000_000).cast("long")


def from_micros(micros: Column, data_type: T.DataType) -> Column:
    """The inverse of ``to_micros``."""
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(micros)
    day = F.date_from_unix_date(F.floor(micros / 86_400_000_000).cast("int"))
    if isinstance(data_type, T.DateType):
        return day
    rest = F.make_dt_interval(secs=((micros % 86_400_000_000) / 1_000_000).cast("decimal(18,6)"))
    return day.cast("timestamp_ntz") + rest


def period_of(moment: Column, data_type: T.DataType, period: str) -> Column:
    """The first day of the week, month, quarter or year of a date or time, in any session zone."""
    return F.trunc(day_of(moment, data_type), period)


def _sorted_maps(column: Column, kind: T.DataType) -> Column:
    """The value with every map in it, at any depth, as its sorted entries."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                _sorted_maps(e["key"], kind.keyType).alias("key"),
                _sorted_maps(e["value"], kind.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType) and _holds_map(kind.elementType):
        return F.transform(column, lambda x: _sorted_maps(x, kind.elementType))
    if isinstance(kind, T.StructType) and _holds_map(kind):
        fields = [_sorted_maps(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def orderable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be compared; maps, at any depth, as their sorted entries."""
    return _sorted_maps(F.col(f"`{name}`"), df.schema[name].dataType)


def _marked(column: Column, kind: T.DataType) -> Column:
    """The value with its NULLs and lengths spelled out, which hashes alone pass over."""
    if isinstance(kind, T.MapType):
        kind = T.ArrayType(T.StructType([
            T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)
        ]))
        column = F.map_entries(column)
        return F.struct(
            F.size(column),
            F.array_sort(F.transform(column, lambda e: _marked(e, kind.elementType))),
        )
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        return F.struct(
            F.size(column), F.transform(column, lambda x: F.struct(x.isNull(), _marked(x, inner)))
        )
    if isinstance(kind, T.StructType):
        parts = [x for f in kind.fields for x in (
            column[f.name].isNull(), _marked(column[f.name], f.dataType)
        )]
        return F.struct(*parts)
    if isinstance(kind, T.StringType):
        return F.struct(F.length(column), column)
    return column


def row_digest(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the columns' exact values, times to the microsecond.

    A column that is NULL counts as one that is not there, so the digest of a row stays the same
    when a column is added that it lacks.
    """
    named = [
        F.when(
            F.col(f"`{c}`").isNotNull(),
            F.struct(F.lit(c), _marked(F.col(f"`{c}`"), df.schema[c].dataType)),
        )
        for c in columns
    ]
    return F.xxhash64(F.lit(1), *named), F.xxhash64(F.lit(2), *named)


def payload_order(df: DataFrame, skip: Sequence[str]) -> list[Column]:
    """The columns that decide between rows of equal key and sequence, in schema order."""
    return [orderable(df, name) for name in df.columns if name not in skip]


def search_steps(longest: int) -> Column:
    """Step widths of a binary search over arrays of up to ``longest`` items."""
    widths, width = [], 1
    while width <= longest:
        widths.insert(0, width)
        width *= 2
    return F.array(*[F.lit(w) for w in widths or [1]])


def upper_bound(items: Column, value: Column, steps: Column) -> Column:
    """How many leading items of a sorted array are at most ``value``.

    A read beyond the end yields NULL and so does not advance.
    """
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(items, at + step - 1) <= value, at + step).otherwise(at),
    )
