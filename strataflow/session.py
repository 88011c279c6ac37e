"""Session settings, scratch folders and the few file-system questions a job has to ask."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set SQL options for the enclosed statements, then restore them."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str | None:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder name for a job's working tables.

    A machine-local folder is used only by a local master: anywhere else the executors
    would each write to a disk of their own.
    """
    shared = shared_dir(spark)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of bookkeeping as one row of literals, which needs no Python worker to read."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, row)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds anything besides bookkeeping files, as Spark tells them apart."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    entries = fs.listStatusIterator(target)
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if not name.startswith(("_", ".")) or (name.startswith("_") and "=" in name):
            return True
    return False


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; none if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its new parent is made if need be."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all in it; nothing if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def put_marker(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file, in place of one that is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_markers(spark: SparkSession, folder: str) -> list[str]:
    """The texts of a folder's small files, in order of their names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    paths = sorted(status.getPath().toString() for status in fs.listStatus(target))
    return [read_marker(spark, path) or "" for path in paths]


def session_copy(spark: SparkSession) -> SparkSession:
    """A session with the same settings, whose own can change without touching other threads."""
    copy = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            copy.conf.set(name, value)
    return copy


def remove_marker(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False)
