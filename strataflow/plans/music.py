"""The listening warehouse: four dimensions and a fact, as configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strataflow.config import CdcSpec, IngestSpec, JoinSpec, Layers, TableSpec
from strataflow.functions.columns import bucketize, regex_clean, upper_columns
from strataflow.operators.metajoin import build
from strataflow.plans.pipeline import silver_schema
from strataflow.streaming.cdc import read_current, read_gold

# The labels of a track's length and the seconds they end at.
DURATIONS = [(150, "low"), (300, "medium")]
LONGEST = "high"


def flag_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("durationflag", bucketize("duration_sec", DURATIONS, LONGEST))


# Each table's key, change column and type.
USER = TableSpec(
    IngestSpec("DimUser", "updated_at"),
    CdcSpec("DimUser", ["user_id"], "updated_at", 2, {"rule_1": "user_id IS NOT NULL"}, merge="table"),
    clean=[lambda df: upper_columns(df, ["user_name"])],
    dedupe="change",
)
ARTIST = TableSpec(
    IngestSpec("DimArtist", "updated_at"),
    CdcSpec("DimArtist", ["artist_id"], "updated_at", 2, {"rule_1": "artist_id IS NOT NULL"}, merge="table"),
    dedupe="change",
)
TRACK = TableSpec(
    IngestSpec("DimTrack", "updated_at"),
    CdcSpec("DimTrack", ["track_id"], "updated_at", 2, {"rule_1": "track_id IS NOT NULL"}, merge="table"),
    clean=[flag_duration, lambda df: regex_clean(df, "track_name")],
    dedupe="change",
)
DATE = TableSpec(
    IngestSpec("DimDate", "date"),
    CdcSpec(
        "DimDate", ["date_key"], "date", 2, {"rule_1": "date_key IS NOT NULL"}, buckets=1,
        merge="table", period="year",
    ),
    dedupe="change",
)
STREAM = TableSpec(
    IngestSpec("FactStream", "stream_timestamp"),
    # Stream ids grow with time, so a day's rows touch the newest buckets only.
    CdcSpec(
        "FactStream", ["stream_id"], "stream_timestamp", 1, {"rule_1": "stream_id IS NOT NULL"},
        bucket_expr="stream_id div 50000000", merge="table",
    ),
    dedupe="change",
)

TABLES = [USER, ARTIST, TRACK, DATE, STREAM]

# The tables, columns and conditions of the listening query.
LISTENS = [
    JoinSpec("FactStream", "factstream", "factstream.stream_id, factstream.listen_duration"),
    JoinSpec(
        "DimUser", "dimuser", "dimuser.user_id, dimuser.user_name",
        "factstream.user_id = dimuser.user_id",
    ),
    JoinSpec(
        "DimTrack", "dimtrack", "dimtrack.track_id, dimtrack.track_name",
        "factstream.track_id = dimtrack.track_id",
    ),
]


def serving(spark: SparkSession, specs: Sequence[TableSpec], layers: Layers) -> dict[str, DataFrame]:
    """Facts as they are, and each dimension's current versions: of a table kept by period only
    that part is read, and its schema is the one kept for the flow, so that no footer is opened."""
    tables = {}
    for spec in specs:
        schema = silver_schema(spark, spec, layers)
        read = read_current if spec.cdc.scd_type == 2 else read_gold
        tables[spec.table] = read(spark, spec.cdc, layers, schema)
    return tables


def gold_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    """The star schema to query: the fact, and each dimension's current versions."""
    return serving(spark, TABLES, layers)


def listens(spark: SparkSession, layers: Layers) -> DataFrame:
    return build(spark, LISTENS, gold_tables(spark, layers))


def register_gold(spark: SparkSession, layers: Layers) -> None:
    """Name every gold table, history and all, for SQL: ``gold_dimuser`` and so on."""
    for spec in TABLES:
        gold = read_gold(spark, spec.cdc, layers, silver_schema(spark, spec, layers))
        gold.createOrReplaceTempView(f"gold_{spec.table.lower()}")
