"""Stream sinks with checkpoints, and whole-table snapshots."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strataflow.operators.quality import failures, report
from strataflow.session import ROCKSDB, path_exists, session_conf

# State is kept outside the heap, and a micro-batch uploads what changed rather than all of it.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# A query takes its copy of the session's options when it starts; flows may start in parallel.
_start_lock = threading.Lock()


def append_stream(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    name: str | None = None,
    once: bool = True,
    interval: str = "1 minute",
    partition_by: list[str] | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Append a stream to a folder or catalog table, each input row exactly once.

    ``once`` takes what is there, waits for it and returns the finished query; otherwise the
    query runs on. De-duplication state is kept outside the heap. ``retention`` (such as ``"90d"``)
    bounds the folder's list of files: files that were written before are no longer read from it.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if retention:
        writer = writer.option("retention", retention)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    with _start_lock, session_conf(df.sparkSession, STATE_STORE):
        if table:
            if path:
                writer = writer.option("path", path)
            query = writer.toTable(table)
        else:
            query = writer.start(path)
    if once:
        query.awaitTermination()
    return query


def _folder(spark: SparkSession, path: str):
    """The folder's file system and path, as Spark's own storage layer knows them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots, the newest first."""
    fs, folder = _folder(spark, path)
    found = [s.getPath().toString() for s in fs.listStatus(folder)
             if s.getPath().getName().startswith("snapshot-")]
    return [x for x in sorted(found, reverse=True) if path_exists(spark, f"{x}/_SUCCESS")]


def write_snapshot(
    df: DataFrame, path: str, rules: Mapping[str, str] | None = None, keep: int | None = None
) -> str:
    """Write a whole dataset to a new folder under ``path`` and return that folder.

    Readers go on with the previous snapshot until this one is complete; a job that reads the
    previous snapshot to make the next one is safe. With ``rules`` the rows that break one are counted
    while they are written; if there are any, RuleBroken is raised and the previous snapshot
    stays the newest. ``keep`` removes all but so many of the newest.
    """
    spark = df.sparkSession
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    name = f"{stamp}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/snapshot-{name}"
    if rules:
        seen = Observation()
        staged = f"{path}/unchecked-{name}"
        df.observe(seen, *failures(rules)).write.parquet(staged)
        fs, folder = _folder(spark, staged)
        broken = {rule: n for rule, n in seen.get.items() if n}
        if broken:
            fs.delete(folder, True)
            report(broken, path)
        fs.rename(folder, _folder(spark, target)[1])
    else:
        df.write.parquet(target)
    if keep:
        for old in _snapshots(spark, path)[keep:]:
            fs, folder = _folder(spark, old)
            fs.delete(folder, True)
    return target


def newest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete snapshot; None if there is none."""
    return next(iter(_snapshots(spark, path)), None) if path_exists(spark, path) else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot."""
    for newest in _snapshots(spark, path):
        return spark.read.parquet(newest)
    raise FileNotFoundError(f"{path} holds no complete snapshot")
