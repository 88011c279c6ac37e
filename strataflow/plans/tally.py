"""Counts of a table's layers, taken while they are written and merged when they are asked for.

Each write leaves one small row per batch (bronze, silver) or per partition that it has replaced (gold):
rows, newest change, and a sketch of the keys, which can be merged. Totals are worked out from these rows; no
layer is read for them. A pass that breaks off leaves a mark; the next one then takes the counts anew, at its
end, by reading the layers, as does one after a pass that has not counted.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from strataflow.config import Layers, TableSpec
from strataflow.functions.keys import from_micros, to_micros
from strataflow.session import (
    children, has_data, literal_rows, make_folder, path_exists, put_marker, remove_folder,
)
from strataflow.sources.batch import read_layer
from strataflow.streaming.cdc import UNTIL
from strataflow.streaming.changelog import BUCKET

STORE = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("batch", T.StringType()),
    T.StructField(BUCKET, T.LongType()),
    T.StructField(UNTIL, T.DateType()),
    T.StructField("number", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("newest", T.LongType()),
    T.StructField("newest_text", T.StringType()),
    T.StructField("keys", T.BinaryType()),
])
# Files beyond which the rows of a table are written anew as one.
MOST_FILES = 64
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


class Tally:
    """The counts of one table."""

    def __init__(self, spark: SparkSession, spec: TableSpec, layers: Layers):
        self.spark, self.spec, self.layers = spark, spec, layers
        self.keys, self.sequence_by = list(spec.cdc.keys), spec.cdc.sequence_by
        self.store = layers.state("tally", spec.table)
        self.mark = layers.state("tally_open", spec.table)

    # Taking counts

    def metrics(self, schema: T.StructType) -> list[Column]:
        """The aggregates of one batch; a change value counts as a number where it can."""
        kind, moment = schema[self.sequence_by].dataType, F.col(self.sequence_by)
        number, text = F.lit(None).cast("long"), F.lit(None).cast("string")
        if isinstance(kind, TIMES):
            number = to_micros(moment, kind)
        elif isinstance(kind, T.IntegralType):
            number = moment.cast("long")
        else:
            text = moment.cast("string")
        return [
            F.count(F.lit(1)).alias("n_rows"),
            F.max(number).alias("newest"),
            F.max(text).alias("newest_text"),
            F.hll_sketch_agg(F.xxhash64(*self.keys)).alias("keys"),
        ]

    def watched(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The same rows, whose counts are known once they are written."""
        seen = Observation()
        return df.observe(seen, *self.metrics(df.schema)), seen

    def put(self, layer: str, batch: str, seen: Observation) -> None:
        """Keep a batch's counts; those of a repeated batch replace the ones before."""
        got = seen.get
        keys = bytes(got["keys"]) if got["keys"] is not None else None
        row = (layer, batch, None, None, time.time_ns(), got["n_rows"], got["newest"], got["newest_text"], keys)
        literal_rows(self.spark, [row], STORE).write.mode("append").parquet(self.store)

    def put_gold(self, table: DataFrame, affected: Column) -> None:
        """Keep the counts of the partitions that a merge has written, and that others are gone.

        ``table`` is the gold table with its partition columns; only the affected partitions are read.
        """
        number = F.lit(time.time_ns())
        parts = [c for c in (BUCKET, UNTIL) if c in table.columns]
        found = table.where(affected).groupBy(*parts).agg(*self.metrics(table.schema))
        found = found.withColumns({"layer": F.lit("gold"), "batch": F.lit(""), "number": number})
        if UNTIL not in parts:
            found = found.withColumn(UNTIL, F.lit(None).cast("date"))
        found.select(*STORE.names).write.mode("append").parquet(self.store)
        stale = self._rows().where("layer = 'gold'").where(affected).groupBy(BUCKET, UNTIL)
        stale = stale.agg(F.max("number").alias("number")).where(F.col("number") < number)
        gone = stale.select(
            F.lit("gold").alias("layer"), F.lit("").alias("batch"), BUCKET, UNTIL, number.alias("number"),
            F.lit(0).cast("long").alias("n_rows"), *[F.lit(None).cast(STORE[n].dataType).alias(n) for n in STORE.names[6:]],
        )
        if gone.take(1):
            gone.write.mode("append").parquet(self.store)

    # The life of a pass

    def begin(self) -> bool:
        """Mark a pass as begun; whether the counts so far can be trusted, so that it should add to them."""
        trusted = has_data(self.spark, self.store) and not path_exists(self.spark, self.mark)
        put_marker(self.spark, self.mark)
        return trusted

    def end(self, trusted: bool) -> None:
        """The counts are complete; those that couldn't be trusted are taken anew."""
        if trusted:
            self.fold()
        else:
            self._anew()
        remove_folder(self.spark, self.mark)

    def _anew(self) -> None:
        """One scan of the layers, for keys and change values, once each has all of the one below."""
        remove_folder(self.spark, self.store)
        make_folder(self.spark, self.store)
        for layer in ("bronze", "silver", "gold"):
            path = self.layers.path(layer, self.spec.table)
            if not has_data(self.spark, path):
                continue
            df = read_layer(self.spark, path, evolved=True)
            if layer == "gold":
                self.put_gold(df, F.lit(True))
                continue
            counted = df.agg(*self.metrics(df.schema)).select(
                F.lit(layer).alias("layer"), F.lit("baseline").alias("batch"),
                F.lit(None).cast("long").alias(BUCKET), F.lit(None).cast("date").alias(UNTIL),
                F.lit(time.time_ns()).alias("number"), "n_rows", "newest", "newest_text", "keys",
            )
            counted.write.mode("append").parquet(self.store)

    # Reading counts

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(STORE).parquet(self.store)

    def batches(self) -> DataFrame:
        """The last counts of each batch and of each partition of gold."""
        last = F.max_by(F.struct("number", "n_rows", "newest", "newest_text", "keys"), "number")
        by = ["layer", "batch", BUCKET, UNTIL]
        return self._rows().groupBy(*by).agg(last.alias("last")).select(*by, "last.*")

    def totals(self, kind: T.DataType) -> DataFrame:
        """layer, n_rows, newest, n_keys (estimated), from the kept rows alone."""
        if isinstance(kind, TIMES):
            newest = from_micros(F.col("newest"), kind).cast(kind).cast("string")
        else:
            newest = F.coalesce(F.col("newest").cast("string"), F.col("newest_text"))
        merged = self.batches().groupBy("layer").agg(
            F.sum("n_rows").alias("n_rows"), F.max("newest").alias("newest"),
            F.max("newest_text").alias("newest_text"),
            F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
        )
        return merged.select("layer", "n_rows", newest.alias("newest"), F.coalesce("n_keys", F.lit(0)).alias("n_keys"))

    def fold(self) -> None:
        """Write many small files anew as one. The rows of both say the same, so a break in between is harmless."""
        names = [n for n in children(self.spark, self.store) if n.endswith(".parquet")]
        if len(names) <= MOST_FILES:
            return
        old = self.spark.read.schema(STORE).parquet(*[f"{self.store}/{n}" for n in names])
        by = ["layer", "batch", BUCKET, UNTIL]
        last = F.max_by(F.struct("number", "n_rows", "newest", "newest_text", "keys"), "number")
        folded = old.groupBy(*by).agg(last.alias("last")).select(*by, "last.*").select(*STORE.names)
        folded.coalesce(1).write.mode("append").parquet(self.store)
        for name in names:
            remove_folder(self.spark, f"{self.store}/{name}")


def forget(spark: SparkSession, tables: Sequence[str], layers: Layers) -> None:
    """Counts that a pass doesn't keep up are not to be trusted by the next that does."""
    for table in tables:
        remove_folder(spark, layers.state("tally", table))


class FlowLog(StreamingQueryListener):
    """Writes down each micro-batch of running flows, and how each flow ended, as small JSON files.

    The listener only puts files, and runs no job: it is called while flows wait for it.
    """

    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark, self.folder = spark, layers.state("flows", "log")
        self.names: dict[str, str] = {}

    def follow(self, flow: str, query_id: str) -> None:
        """Show a query under the flow's name."""
        self.names[str(query_id)] = flow

    def _put(self, query_id: object, file: str, row: dict) -> None:
        name = self.names.get(str(query_id))
        if name is not None:
            path = f"{self.folder}/{name}-{str(query_id)[:8]}-{file}.json"
            put_marker(self.spark, path, json.dumps({"flow": name, **row}))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = {
            "batch": progress.batchId, "n_rows": progress.numInputRows, "ended": None, "error": None,
            "at": progress.timestamp, "millis": progress.durationMs.get("triggerExecution"),
        }
        if progress.numInputRows:
            self._put(progress.id, f"{progress.batchId:012d}", row)

    def onQueryTerminated(self, event) -> None:
        row = {"batch": None, "n_rows": None, "ended": True, "error": event.exception, "at": None, "millis": None}
        self._put(event.id, f"end-{event.runId}", row)


FLOWS = "flow string, batch long, n_rows long, ended boolean, error string, at string, millis long"


def read_flows(spark: SparkSession, layers: Layers) -> DataFrame:
    """A row per micro-batch of the flows that a ``FlowLog`` follows, and one for each end."""
    folder = layers.state("flows", "log")
    make_folder(spark, folder)
    return spark.read.schema(FLOWS).json(folder)
