"""The schema a file stream is read with: stored beside the stream, widened by new columns and fields."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.session import has_data, literal_rows

STATE = T.StructType([
    T.StructField("resolved_at", T.StringType()),
    T.StructField("schema", T.StringType()),
])
# Footers this much older than the last look are read again, in case clocks differ.
CLOCK_MARGIN = timedelta(hours=1)


# Types whose values a wider type holds exactly, and as which the reader gives older files.
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType),
    T.ShortType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.LongType,),
    T.FloatType: (T.DoubleType,),
}


class SchemaConflict(ValueError):
    """A column came back with another type."""


def widen(
    known: T.StructType, observed: T.StructType, deep: bool = False, within: str = ""
) -> T.StructType:
    """``known`` plus the columns only ``observed`` has; another type for a name is refused.

    ``deep`` also takes new fields inside structs, arrays and maps, and wider types of numbers. A type
    that can't hold all values seen before (narrower, or another one) is refused all the same.
    """
    if not deep:
        for field in observed.fields:
            if field.name in known.names and known[field.name].dataType != field.dataType:
                raise _conflict(field.name, known[field.name].dataType, field.dataType)
    new = {f.name: f for f in observed.fields}
    fields = []
    for field in known.fields:
        other = new.pop(field.name, None)
        if other is not None:
            kind = _wider(field.dataType, other.dataType, within + field.name)
            field = T.StructField(field.name, kind, field.nullable or other.nullable, field.metadata)
        fields.append(field)
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new.values()])


def _wider(known: T.DataType, observed: T.DataType, name: str) -> T.DataType:
    match known, observed:
        case T.StructType(), T.StructType():
            return widen(known, observed, True, f"{name}.")
        case T.ArrayType(), T.ArrayType():
            element = _wider(known.elementType, observed.elementType, f"{name}.element")
            return T.ArrayType(element, known.containsNull or observed.containsNull)
        case T.MapType(), T.MapType():
            key = _wider(known.keyType, observed.keyType, f"{name}.key")
            value = _wider(known.valueType, observed.valueType, f"{name}.value")
            return T.MapType(key, value, known.valueContainsNull or observed.valueContainsNull)
        case T.DecimalType(), T.DecimalType():
            more = observed.precision - known.precision
            if observed.scale >= known.scale and more >= observed.scale - known.scale:
                return observed
    if known == observed or type(observed) in WIDER.get(type(known), ()):
        return observed
    raise _conflict(name, known, observed)


def _conflict(name: str, known: T.DataType, observed: T.DataType) -> SchemaConflict:
    return SchemaConflict(f"column {name}: {known.simpleString()} became {observed.simpleString()}")


def _observe(
    spark: SparkSession, path: str, since: datetime | None, deep: bool
) -> T.StructType | None:
    """The merged schema of the files under ``path`` changed after ``since``."""

    def recent(reader: DataFrameReader) -> DataFrameReader:
        if since is None:
            return reader
        after = since.strftime("%Y-%m-%dT%H:%M:%S")
        return reader.option("modifiedAfter", after).option("timeZone", "UTC")

    try:
        return recent(spark.read.option("mergeSchema", True)).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA" and since is not None:
            return None
        raise
    except Exception as error:
        if not _no_merge(error):
            raise
        if not deep:
            raise SchemaConflict(str(error).splitlines()[0]) from error
    # Files of two types: they are merged in the order in which they came. The list has the files that
    # planning a read lists too; no content is read.
    listed = recent(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")).load(path)
    files = [row["path"] for row in listed.orderBy("modificationTime", "path").select("path").collect()]
    return _in_order(spark, path, files)


def _no_merge(error: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMA" in str(error) or "Failed merging schema" in str(error)


def _in_order(spark: SparkSession, path: str, files: list[str]) -> T.StructType:
    """The schema of files in their order, halved as long as Spark can't merge them at once."""
    try:
        return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*files).schema
    except Exception as error:
        if len(files) == 1 or not _no_merge(error):
            raise
    half = len(files) // 2
    return widen(_in_order(spark, path, files[:half]), _in_order(spark, path, files[half:]), True)


def resolve_schema(
    spark: SparkSession, path: str, store: str, evolve: bool = True, deep: bool = False
) -> T.StructType:
    """The schema to read ``path`` with; kept as rows of the ``store`` folder.

    With ``deep`` nested fields and wider numbers are taken too. Names in a catalog can't follow that, so
    the layered flow leaves it off.

    Only the footers of files newer than the last look are opened. Files must not land with new
    columns between this call and the end of the run that uses it; the pipeline lands first.
    """
    now = datetime.now(timezone.utc)
    known, since = None, None
    if has_data(spark, store):
        # Each run's row holds all that the runs before knew, so the newest is enough.
        newest = spark.read.schema(STATE).json(store).orderBy(F.desc("resolved_at")).first()
        known = T.StructType.fromJson(json.loads(newest["schema"]))
        since = datetime.fromisoformat(newest["resolved_at"]) - CLOCK_MARGIN
    if known is not None and not evolve:
        return known
    observed = _observe(spark, path, since, deep)
    schema = known if observed is None else observed if known is None else widen(known, observed, deep)
    row = (now.isoformat(), schema.json())
    literal_rows(spark, [row], STATE).write.mode("append").json(store)
    return schema
