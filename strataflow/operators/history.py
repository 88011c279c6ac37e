"""Change rows to type 1 (latest state) and type 2 (full history) tables.

Fixed rules: the result depends only on the set of change rows, not on their order. Equal
rows count once; of rows with equal key and sequence the larger payload, column by
column, wins. A NULL key is a key like any other; a row without a sequence value is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.config import SkewPolicy
from strataflow.functions.keys import orderable, payload_order
from strataflow.operators import skew
from strataflow.operators.dedup import latest_per_key, thinned

START = "__START_AT"
END = "__END_AT"


def scd1(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """The newest row of each key."""
    return latest_per_key(changes.where(F.col(sequence_by).isNotNull()), keys, sequence_by, policy)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    untracked: Sequence[str] = (),
    start: str = START,
    end: str = END,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """One version per change, valid from its sequence value until the next version's.

    Changes that differ only in ``untracked`` columns (and in the sequence itself) do not
    open a version: they update the payload of the open one.

    Most keys take one shuffle and one sort. Keys too large for a task are found first, reduced to
    one row per change, and cut into chunks whose edges are matched up afterwards.
    """
    rows = changes.where(F.col(sequence_by).isNotNull())
    tracked = None
    if untracked:
        tracked = [c for c in changes.columns if c not in {*keys, sequence_by, *untracked}]
    hot = skew.find_hot(rows, keys, policy)
    if not hot:
        return _versions(rows, keys, sequence_by, tracked, start, end)
    is_hot = skew.is_hot(keys, hot)
    heavy = rows.where(is_hot)
    cuts = skew.choose_cuts(heavy, keys, sequence_by, policy)
    change = [*keys, sequence_by]
    heavy = thinned(heavy, change, payload_order(heavy, change) or [F.col(sequence_by)])
    heavy = skew.with_chunk(heavy, keys, sequence_by, cuts)
    return _versions(rows.where(~is_hot), keys, sequence_by, tracked, start, end).unionByName(
        _versions(heavy, keys, sequence_by, tracked, start, end, chunked=True)
    )


def _versions(
    rows: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tracked: Sequence[str] | None,
    start: str,
    end: str,
    chunked: bool = False,
) -> DataFrame:
    columns = [c for c in rows.columns if c != skew.CHUNK]
    within = [*keys, skew.CHUNK] if chunked else list(keys)
    ties = payload_order(rows, [*within, sequence_by])
    order = Window.partitionBy(*within).orderBy(sequence_by, *ties)
    seq = F.col(sequence_by)

    # Of equal sequence values only the last, the largest payload, has another value after it.
    # The windows below share this one's shuffle and sort.
    rows = rows.withColumn("__next", F.lead(sequence_by).over(order))
    rows = rows.where(F.col("__next").isNull() | (F.col("__next") != seq))
    if tracked is None:
        if chunked:
            rows = skew.attach(rows, _plain_edges(rows, keys, sequence_by), keys)
            rows = rows.withColumn("__next", F.coalesce("__next", "__edge_next"))
        return rows.select(*columns, seq.alias(start), F.col("__next").alias(end))

    compared = F.struct(*[orderable(rows, c).alias(c) for c in tracked]) if tracked else F.struct(
        F.lit(True).alias("same")
    )
    rows = rows.withColumn("__now", compared)
    rows = rows.withColumns({
        "__before": F.lag("__now").over(order),
        "__after": F.lead("__now").over(order),
    })
    if chunked:
        rows = skew.attach(rows, _tracked_edges(rows, keys, sequence_by), keys)
        rows = rows.withColumns({
            "__before": F.coalesce("__before", "__edge_before"),
            "__after": F.coalesce("__after", "__edge_after"),
            "__next": F.coalesce("__next", "__edge_next"),
        })
    opened = F.max(F.when(_differs("__before"), seq)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if chunked:
        opened = F.coalesce(opened, F.col("__edge_opened"))
    return (
        rows.withColumn(start, opened)
        .where(_differs("__after"))
        .select(*columns, start, F.col("__next").alias(end))
    )


def _differs(neighbour: str) -> Column:
    """No neighbour, or one with other tracked values."""
    return F.col(neighbour).isNull() | ~F.col(neighbour).eqNullSafe(F.col("__now"))


def _plain_edges(rows: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    first = rows.groupBy(*keys, skew.CHUNK).agg(F.min(sequence_by).alias("__first"))
    return first.select(
        *keys, skew.CHUNK, F.lead("__first").over(skew.across(keys)).alias("__edge_next")
    )


def _tracked_edges(rows: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Per chunk, what its neighbours know: the values either side and the last opened version."""
    inner = F.when(F.col("__before").isNotNull() & _differs("__before"), F.col(sequence_by))
    chunks = rows.groupBy(*keys, skew.CHUNK).agg(
        F.min(sequence_by).alias("__first"),
        F.min_by("__now", sequence_by).alias("__now"),
        F.max_by("__now", sequence_by).alias("__last_now"),
        F.max(inner).alias("__inner"),
    )
    across = skew.across(keys)
    chunks = chunks.withColumn("__edge_before", F.lag("__last_now").over(across))
    opened = F.coalesce("__inner", F.when(_differs("__edge_before"), F.col("__first")))
    return chunks.withColumn("__opened", opened).select(
        *keys,
        skew.CHUNK,
        "__edge_before",
        F.lead("__now").over(across).alias("__edge_after"),
        F.lead("__first").over(across).alias("__edge_next"),
        F.last("__opened", ignorenulls=True)
        .over(across.rowsBetween(Window.unboundedPreceding, -1))
        .alias("__edge_opened"),
    )


def current_versions(history: DataFrame, end: str = END) -> DataFrame:
    return history.where(F.col(end).isNull())


def closed_versions(history: DataFrame, end: str = END) -> DataFrame:
    return history.where(F.col(end).isNotNull())


def as_of(history: DataFrame, moment: str | Column, start: str = START, end: str = END) -> DataFrame:
    """The versions valid at a moment; the start belongs to a version, the end does not."""
    if isinstance(moment, str):
        moment = F.lit(moment).cast(history.schema[start].dataType)
    return history.where(
        (F.col(start) <= moment) & (F.col(end).isNull() | (F.col(end) > moment))
    )
