"""The whole flow: source to bronze to silver to gold, table by table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.config import Layers, TableSpec
from strataflow.functions.columns import drop_columns
from strataflow.plans.ingest import Outcome, Reader, failure, run_all
from strataflow.plans.monitor import record_runs, record_stats
from strataflow.plans.tally import FlowLog, Tally, forget
from strataflow.session import children, has_data
from strataflow.sources.schema import resolve_schema
from strataflow.sources.stream import stream_files, stream_table
from strataflow.streaming.cdc import UNTIL, apply_changes, target_schema
from strataflow.streaming.changelog import BATCH, BUCKET, stage
from strataflow.streaming.dedupe import (
    DAY, append_known, known_schema, stream_dedupe, stream_dedupe_changes,
)
from strataflow.streaming.sinks import append_stream

#: Partitions named in one statement to the catalog, and how one without a value is shown.
PARTITIONS_AT_ONCE = 500
NO_VALUE = ("__HIVE_DEFAULT_PARTITION__", "null")


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A table's silver work without the de-duplication; for batch and stream alike."""
    for step in spec.clean:
        df = step(df)
    return drop_columns(df, spec.drop)


def deduped(df: DataFrame, spec: TableSpec) -> DataFrame:
    if spec.dedupe is None:
        return df
    if spec.dedupe == "key":
        return stream_dedupe(df, spec.cdc.keys, salts=spec.salts)
    return stream_dedupe_changes(df, spec.cdc.keys, spec.cdc.sequence_by, spec.salts)


def bronze_schema(spark: SparkSession, spec: TableSpec, layers: Layers) -> T.StructType:
    return resolve_schema(
        spark, layers.path("bronze", spec.table), layers.state("schema", spec.table)
    )


def silver_schema(spark: SparkSession, spec: TableSpec, layers: Layers) -> T.StructType:
    """The schema of the silver rows, from the one kept for bronze; no data file is opened."""
    kept = resolve_schema(
        spark, layers.path("bronze", spec.table), layers.state("schema", spec.table), evolve=False
    )
    return clean(spark.createDataFrame([], kept), spec).schema


def bronze_to_silver(
    spark: SparkSession, spec: TableSpec, layers: Layers, interval: str = "1 minute"
) -> tuple[T.StructType, StreamingQuery] | None:
    """Clean the bronze files that are new and append them; gives the silver schema and the query."""
    bronze = layers.path("bronze", spec.table)
    if not has_data(spark, bronze):
        return None
    schema = bronze_schema(spark, spec, layers)
    archived = {"cleanSource": "archive", "sourceArchiveDir": spec.archive} if spec.archive else {}
    source = stream_files(spark, bronze, schema, bytes_per_batch=spec.bytes_per_batch, **archived)
    if spec.within is not None and spec.dedupe:
        silver = clean(source, spec)
        query = append_known(
            silver,
            spec.cdc.keys,
            spec.cdc.sequence_by,
            layers.checkpoint(f"{spec.table}_silver"),
            layers.path("silver", spec.table),
            within=spec.within,
            change=spec.dedupe == "change",
            once=spec.cdc.once,
            interval=interval,
        )
        return silver.schema, query
    silver = deduped(clean(source, spec), spec)
    query = append_stream(
        silver,
        layers.checkpoint(f"{spec.table}_silver"),
        path=layers.path("silver", spec.table),
        once=spec.cdc.once,
        interval=interval,
    )
    return silver.schema, query


def silver_to_gold(
    spark: SparkSession, spec: TableSpec, layers: Layers, schema: T.StructType, quarantine: bool = False,
    tally: Tally | None = None,
) -> list[StreamingQuery]:
    """Stage the silver rows that are new and bring the gold table up to date; gives the queries."""
    source = stream_table(spark, layers.path("silver", spec.table), schema).select(*schema.names)
    return [
        *stage(source, spec.cdc, layers, quarantine, tally=tally),
        apply_changes(spark, spec.cdc, schema, layers, tally=tally),
    ]


def _named_schema(spark: SparkSession, spec: TableSpec, layers: Layers, layer: str) -> T.StructType:
    """The schema kept for a flow, with the partition columns; no data file is opened."""
    schema = silver_schema(spark, spec, layers)
    if layer == "gold":
        return target_schema(schema, spec.cdc.resolved(schema))
    parts = known_schema().fields[-2:] if spec.within is not None and spec.dedupe else []
    return T.StructType([*schema.fields, *parts])


def _add_partitions(spark: SparkSession, name: str, path: str, parts: Sequence[str]) -> None:
    """Partitions that the folder has and the catalog hasn't, and away with those that are gone.

    Names only are compared: a table's folders are listed, not what is in them.
    """
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    there = [""]
    for part in parts:
        deeper = []
        for place in there:
            names = children(spark, f"{path}/{place}" if place else path)
            deeper += [f"{place}/{n}".strip("/") for n in names if n.startswith(f"{part}=")]
        there = deeper

    def spec_of(place: str) -> str:
        pairs = [p.split("=", 1) for p in place.split("/")]
        return ", ".join(f"`{n}`=null" if v in NO_VALUE else f"`{n}`='{v}'" for n, v in pairs)

    for name_ in NO_VALUE:
        known = {k.replace(f"={name_}", f"={NO_VALUE[0]}") for k in known}
    new, gone = sorted(set(there) - known), sorted(known - set(there))
    for places, verb in ((new, "ADD IF NOT EXISTS"), (gone, "DROP IF EXISTS")):
        joint = " " if verb.startswith("ADD") else ", "
        for at in range(0, len(places), PARTITIONS_AT_ONCE):
            listed = joint.join(f"PARTITION ({spec_of(p)})" for p in places[at : at + PARTITIONS_AT_ONCE])
            spark.sql(f"ALTER TABLE {name} {verb} {listed}")


def name_tables(spark: SparkSession, specs: Sequence[TableSpec], layers: Layers) -> list[str]:
    """Silver and gold under their names in the configured schema, over the layers' folders.

    A name has the schema kept for its flow: columns that a run has brought are added to it, so earlier rows
    read NULL there. Of gold only partitions that are new or gone are told to the catalog.
    """
    names = []
    if layers.schema:
        parts = [p for p in (layers.catalog, layers.schema) if p]
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(f'`{p}`' for p in parts)}")
    for spec in specs:
        for layer in ("silver", "gold"):
            name, path = layers.table(layer, spec.table), layers.path(layer, spec.table)
            if name is None or not has_data(spark, path):
                continue
            schema = _named_schema(spark, spec, layers, layer)
            parted = [f for f in schema.names if f in (BUCKET, UNTIL, BATCH, DAY)]
            if not spark.catalog.tableExists(name):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parted)})" if parted else ""
                spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{path}'")
            known = {f.lower() for f in spark.table(name).columns}
            added = [f for f in schema.fields if f.name.lower() not in known]
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            if parted:
                _add_partitions(spark, name, path, parted)
            # Files have changed behind the name.
            spark.catalog.refreshTable(name)
            names.append(name)
    return names


def start(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    layers: Layers,
    quarantine: bool = False,
    interval: str = "1 minute",
) -> dict[str, list[StreamingQuery]]:
    """The flows of tables with ``once=False``, running; the handles tell of a later failure.

    Each looks for news every ``interval``. A table needs rows in bronze to begin with, as they give its schema.
    Their micro-batches are written down as they end, see ``read_flows``.
    """
    log = FlowLog(spark, layers)
    spark.streams.addListener(log)
    running: dict[str, list[StreamingQuery]] = {}
    for spec in specs:
        begun = None if spec.cdc.once else bronze_to_silver(spark, spec, layers, interval)
        if begun is None:
            continue
        schema, query = begun
        running[spec.table] = [query]
        log.follow(f"{spec.table}_silver", query.id)
        # The streams above need folders to look at.
        query.processAllAvailable()
        source = stream_table(spark, layers.path("silver", spec.table), schema).select(*schema.names)
        staged = stage(source, spec.cdc, layers, quarantine, interval)
        running[spec.table] += staged
        log.follow(f"{spec.table}_stage", staged[0].id)
        staged[0].processAllAvailable()
        running[spec.table].append(apply_changes(spark, spec.cdc, schema, layers, interval))
        log.follow(f"{spec.table}_apply", running[spec.table][-1].id)
        forget(spark, [spec.table], layers)
    return running


def run(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    reader: Reader,
    layers: Layers,
    only: Sequence[str] | None = None,
    quarantine: bool = False,
    parallel: int = 4,
    stats: bool = False,
) -> list[Outcome]:
    """One pass over all tables, or over those named in ``only``.

    With a schema in ``layers`` the silver and gold tables are named in it. ``stats`` appends each
    layer's row count, freshness and keys to a log. They are counted while the layers are written (see ``tally``):
    only the first pass with ``stats``, or one after a pass without, reads what was there before.
    Tables whose flows run on (``once=False``) are only landed here; see ``start``.

    Each layer takes what the one below has new, so a pass after a failure picks up what the
    failed one left. One table's failure does not stop the others; all are logged before
    they are raised together.
    """
    chosen = [s for s in specs if only is None or s.table in only]
    tallies = {s.table: Tally(spark, s, layers) for s in chosen if stats and s.cdc.once}
    counted = {table for table, tally in tallies.items() if tally.begin()}
    forget(spark, [s.table for s in chosen if s.table not in counted], layers)
    counting = {s.ingest.table: tallies[s.table] for s in chosen if s.table in counted}
    outcomes = run_all(spark, [s.ingest for s in chosen], reader, layers, parallel, counting)
    record_runs(spark, outcomes, layers)

    def upwards(spec: TableSpec) -> Outcome | None:
        tally = tallies.get(spec.table)
        try:
            begun = bronze_to_silver(spark, spec, layers) if spec.cdc.once else None
            if begun is not None:
                adding = tally if spec.table in counted else None
                silver_to_gold(spark, spec, layers, begun[0], quarantine, adding)
            if tally and begun is not None:
                tally.end(spec.table in counted)
                found = tally.totals(begun[0][spec.cdc.sequence_by].dataType)
                record_stats(spark, outcomes[0].run_id, spec.table, found, layers)
            return None
        except Exception as error:
            return failure(outcomes[0].run_id, spec.table, error)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        broken = [o for o in pool.map(upwards, chosen) if o is not None]
    name_tables(spark, chosen, layers)
    if broken:
        record_runs(spark, broken, layers)
    failed = [o for o in outcomes if o.status == "failed"] + broken
    if failed:
        raise RuntimeError("; ".join(f"{o.table}: {o.error}" for o in failed))
    return outcomes
