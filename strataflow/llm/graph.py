"""Connected components of an undirected graph given by links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import saved


def _least(links: DataFrame) -> DataFrame:
    """Each link's ``u`` and ``v``, and ``m``: the least of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns u, v); the root is the least of its component.

    Alternates between hanging all larger neighbours and all smaller neighbours of a node on the least
    one. Each round is written, so a lost executor repeats a round at most. A hub's links are
    combined before the shuffle, and the join back on it can be split.
    """
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = saved(now.where("u <> v").distinct(), "links")
    before = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least(large.where("u <> v").distinct())
        # A node hangs on its least neighbour, as do its other neighbours.
        now = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        now = saved(now.where("u <> v").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
