"""Versions laid into cells of time, so that a fact finds its version by an equality on key and cell."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each finer choice of cells has so many times the cells of the one before.
FINER = 4
CHOICES = 11
#: Versions become at most so many times their number of rows.
MOST_COPIES = 4
CELL = "__cell"


def position(moment: Column, kind: T.DataType) -> Column:
    """A whole number that grows with the time (or does not fall)."""
    if isinstance(kind, T.DateType):
        return F.unix_date(moment).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(moment)
    if isinstance(kind, T.TimestampNTZType):
        # Without a time zone: none of its days has a gap.
        seconds = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
        return F.unix_date(F.to_date(moment)).cast("long") * 86_400 + seconds
    return F.floor(moment).cast("long")


@dataclass(frozen=True)
class Cells:
    """``last + 1`` cells of ``width`` from ``low`` on; what lies outside belongs to the first or last.

    ``rows`` is what the versions come to in these cells, ``most`` the starts of versions in the fullest cell
    of a key.
    """

    kind: T.DataType
    low: int
    width: int
    last: int
    rows: int
    most: int

    def of(self, moment: Column) -> Column:
        return _cell(position(moment.cast(self.kind), self.kind), self.low, self.width, self.last)


def _cell(at: Column, low: int, width: int, last: int) -> Column:
    nth = F.floor((at - F.lit(low)) / F.lit(width))
    # ``least`` and ``greatest`` pass over NULL: a row without a time must have no cell.
    return F.when(at.isNotNull(), F.least(F.greatest(nth, F.lit(0)), F.lit(last)).cast("int"))


def common_kind(one: T.DataType, other: T.DataType) -> T.DataType:
    """The type in which two columns of time are compared."""
    if one == other:
        return one
    numbers = isinstance(one, T.NumericType) and isinstance(other, T.NumericType)
    return T.DoubleType() if numbers else T.TimestampType()


def choose_cells(
    versions: DataFrame, keys: Sequence[str], start: Column, end: Column, kind: T.DataType, few: int
) -> Cells | None:
    """The widest cells in which no key has more than ``few`` starts of versions, or the finest ones in which the
    versions are no more than ``MOST_COPIES`` times their number; None without any version.

    Versions of a key don't overlap, so they come to their number and one row per cell of each key, at most.
    Reads keys and times only, and combines the counts before they are shuffled.
    """
    spans = versions.select(
        *keys, position(start.cast(kind), kind).alias("__from"), position(end.cast(kind), kind).alias("__to")
    )
    low, high, n = spans.agg(F.min("__from"), F.max("__from"), F.count("__from")).first()
    if not n:
        return None
    lasts = [FINER**k - 1 for k in range(CHOICES) if k == 0 or FINER**k <= high - low + 1]
    widths = [-(-(high - low + 1) // (last + 1)) for last in lasts]

    def cell(column: str, k: int) -> Column:
        found = _cell(F.col(column), low, widths[k], lasts[k])
        return F.coalesce(found, F.lit(lasts[k])) if column == "__to" else found

    copies = [F.sum(cell("__to", k) - cell("__from", k) + 1) for k in range(len(lasts))]
    rows = spans.agg(*copies).first()
    allowed = [k for k in range(len(lasts)) if rows[k] <= MOST_COPIES * n] or [0]
    places = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), cell("__from", k).alias("c")) for k in allowed]))
    counts = spans.select(*keys, places.alias("__place")).groupBy(*keys, "__place").count()
    fullest = dict(counts.groupBy("__place.k").agg(F.max("count")).collect())
    k = next((k for k in allowed if fullest[k] <= few), allowed[-1])
    return Cells(kind, low, widths[k], lasts[k], rows[k], fullest[k])


def in_cells(versions: DataFrame, cells: Cells, start: Column, end: Column) -> DataFrame:
    """Each version once for every cell that it has a part in; an open one up to the last cell."""
    first, last = cells.of(start), F.coalesce(cells.of(end), F.lit(cells.last))
    return versions.where(first <= last).withColumn(CELL, F.explode(F.sequence(first, last)))
