"""Batch de-duplication, with an outcome that depends only on the rows, never on their order.

Keys that hold a large share of a big table are found first. Their rows are thinned in the tasks
that read them, so each reaches its final task as one row per input task; all other keys
take a single shuffle and a single sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.config import SkewPolicy
from strataflow.functions.keys import payload_order
from strataflow.operators import skew


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever it is; NULL counts as a key. Spark thins before its shuffle."""
    return df.dropDuplicates(list(keys))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The newest row of each key; rows of equal sequence go by the larger payload."""
    sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    order = [F.col(f"`{c}`") for c in sequence] + payload_order(df, [*keys, *sequence])
    return _last(df, keys, order, policy)


def one_per_change(
    df: DataFrame, keys: Sequence[str], sequence_by: str, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """One row per key and sequence, the larger payload, so that a key's history survives."""
    change = [*keys, sequence_by]
    order = payload_order(df, change)
    return _last(df, change, order, policy) if order else df.distinct()


def thinned(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key in ``order``, kept to one per key and task before the shuffle.

    Spark plans a ``row_number() = 1`` test as a limit per group on both sides of the shuffle,
    at the price of a second sort.
    """
    newest = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def _last(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], policy: SkewPolicy
) -> DataFrame:
    hot = skew.find_hot(df, keys, policy)
    oldest = Window.partitionBy(*keys).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        more = F.lead(F.lit(True)).over(oldest)
        return rows.withColumn("__more", more).where("__more IS NULL").drop("__more")

    if not hot:
        return plain(df)
    is_hot = skew.is_hot(keys, hot)
    return plain(df.where(~is_hot)).unionByName(thinned(df.where(is_hot), keys, order))
