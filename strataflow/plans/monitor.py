"""Row counts and freshness per layer, and the log of runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import Layers
from strataflow.plans.ingest import Outcome
from strataflow.session import literal_rows

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("low", T.StringType()),
    T.StructField("high", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_null", T.LongType()),
    T.StructField("n_late", T.LongType()),
])


def layer_stats(
    layers: Mapping[str, DataFrame],
    sequence_by: str,
    key: str | Sequence[str],
    now: str | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One row per layer: its rows, its newest change and its distinct keys.

    ``now`` adds the age of the newest change in seconds. ``approximate`` estimates the
    keys from a sketch, which saves a shuffle of every distinct key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    item = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    distinct = F.approx_count_distinct(item) if approximate else F.count_distinct(item)

    def one(name: str, df: DataFrame) -> DataFrame:
        stats = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max(sequence_by).alias("newest"),
            distinct.alias("n_keys"),
        )
        return stats.select(F.lit(name).alias("layer"), "n_rows", "newest", "n_keys")

    stats = reduce(DataFrame.unionByName, (one(n, df) for n, df in layers.items()))
    if now is not None:
        age = F.unix_timestamp(F.lit(now)) - F.unix_timestamp(F.col("newest").cast("timestamp"))
        stats = stats.withColumn("age_seconds", age)
    return stats


def record_runs(spark: SparkSession, outcomes: Sequence[Outcome], layers: Layers) -> None:
    """Append the outcomes, good and bad, to the run log."""
    if not outcomes:
        return
    rows = [tuple(asdict(o)[name] for name in RUN_SCHEMA.names) for o in outcomes]
    log = literal_rows(spark, rows, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    log.write.mode("append").parquet(layers.state("runs", "log"))


def read_runs(spark: SparkSession, layers: Layers) -> DataFrame:
    """All outcomes; columns that older runs lack read as NULL."""
    return spark.read.option("mergeSchema", True).parquet(layers.state("runs", "log"))


def record_stats(
    spark: SparkSession, run_id: str, table: str, stats: DataFrame, layers: Layers
) -> None:
    """Append a table's rows of ``layer_stats`` to the log of layers, as text where types differ."""
    rows = stats.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("table"),
        "layer",
        "n_rows",
        F.col("newest").cast("string").alias("newest"),
        "n_keys",
    )
    rows.write.mode("append").parquet(layers.state("stats", "log"))


def read_stats(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.parquet(layers.state("stats", "log"))
