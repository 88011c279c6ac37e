"""The operators as queries over the test tables; each takes a session and a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import CdcSpec, IngestSpec, JoinSpec, Layers, SkewPolicy, TableSpec
from strataflow.functions import bucketize, drop_columns, regex_clean, upper_columns
from strataflow.operators import (
    any_per_key, as_of, build_join, classify, closed_versions, current_versions, distinct_dates,
    expect_all_or_drop, expect_all_or_fail, high_watermark, join_as_of, latest_per_key,
    one_per_change, preview, scd1, scd2, split, sum_by,
)
from strataflow.plans.datasets import Dataset, read_dataset, refresh
from strataflow.plans.ingest import backfill, ingest_table, land, run_all
from strataflow.plans.monitor import layer_stats, read_runs, read_stats, record_runs
from strataflow.plans.music import DURATIONS, LONGEST, TABLES, serving
from strataflow.plans.pipeline import run, silver_schema
from strataflow.session import put_marker, remove_folder, scratch_dir
from strataflow.sources import read_layer, read_since, read_table, resolve_schema, stream_files
from strataflow.streaming import (
    SumSpec, append_known, append_stream, append_within, apply_changes, changes_between, kept_sums, read_as_of, read_gold,
    read_snapshot, rebuild, stage, stream_dedupe, stream_dedupe_changes, write_snapshot,
)

Query = Callable[[SparkSession, str], DataFrame]
HALF = "2024-01-15"
VERSION = {"start": "start_at", "end": "end_at"}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its name; a trailing underscore keeps clear of an operator's name."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_layer(spark, f"{sf}/{name}.parquet")


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A stream over one table, whether it is one file or a folder of files."""
    return stream_files(spark, f"{sf}/{name}.parque[t]", table(spark, sf, name).schema)


def work(spark: SparkSession, name: str) -> Layers:
    return Layers(scratch_dir(spark, name))


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "event_type", "value", "ts")


def named(history: DataFrame) -> DataFrame:
    return history.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


# Scans, projections, filters


@query
def scan_project(spark, sf):
    return drop_columns(table(spark, sf, "events"), ["props", "_rescued_data"])


@query
def select_star(spark, sf):
    return table(spark, sf, "nation").select("*")


@query
def table_scan(spark, sf):
    table(spark, sf, "supplier").createOrReplaceTempView("supplier_source")
    return read_table(spark, "supplier_source")


@query
def sql_text(spark, sf):
    return spark.sql(
        "SELECT event_type, count(*) AS n_events FROM {events} "
        "WHERE ts > CAST(:low AS TIMESTAMP_NTZ) GROUP BY event_type",
        args={"low": HALF},
        events=table(spark, sf, "events"),
    )


@query
def upper_bucket(spark, sf):
    part = upper_columns(table(spark, sf, "part"), ["p_name"])
    flag = bucketize("p_size", [(15, "low"), (30, "medium")], "high")
    return part.select("p_partkey", "p_name", flag.alias("durationflag"))


@query
def regex_clean_(spark, sf):
    return regex_clean(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query
def filter_in(spark, sf):
    return table(spark, sf, "part").where(F.col("p_partkey").isin(46, 5)).select("p_partkey", "p_name")


@query
def topk_preview(spark, sf):
    return preview(table(spark, sf, "events"), 100, [F.col("value").desc(), "event_id"])


# Joins


def listens(spark: SparkSession, sf: str) -> DataFrame:
    specs = [
        JoinSpec("events", "e", "e.event_id, e.value"),
        JoinSpec("customer", "c", "c.c_custkey, c.c_name", "e.user_id = c.c_custkey"),
        JoinSpec("part", "p", "p.p_partkey, p.p_name", "e.event_id = p.p_partkey"),
    ]
    return build_join(spark, specs, {s.table: table(spark, sf, s.table) for s in specs})


@query
def meta_left_join(spark, sf):
    return listens(spark, sf)


@query
def star_join(spark, sf):
    specs = [
        JoinSpec("lineitem", "l", "l.l_orderkey, l.l_linenumber, l.l_extendedprice"),
        JoinSpec("orders", "o", "o.o_orderdate", "l.l_orderkey = o.o_orderkey"),
        JoinSpec("customer", "c", "c.c_name", "o.o_custkey = c.c_custkey", parent="o"),
        JoinSpec("nation", "n", "n.n_name", "c.c_nationkey = n.n_nationkey", parent="c"),
        JoinSpec("region", "r", (), "n.n_regionkey = r.r_regionkey", parent="n", unique=True),
    ]
    return build_join(spark, specs, {s.table: table(spark, sf, s.table) for s in specs})


def priorities(spark: SparkSession, sf: str) -> DataFrame:
    """The history of each customer's order priority."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return scd2(rows, ["o_custkey"], "o_orderdate", **VERSION)


@query
def star_current(spark, sf):
    tables = {
        "orders": table(spark, sf, "orders"),
        "priorities": current_versions(priorities(spark, sf), "end_at"),
    }
    specs = [
        JoinSpec("orders", "o", "o.o_orderkey, o.o_custkey"),
        JoinSpec("priorities", "h", "h.o_orderpriority AS latest_priority", "o.o_custkey = h.o_custkey"),
    ]
    return build_join(spark, specs, tables)


def shipped(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query
def pit_join(spark, sf):
    history = priorities(spark, sf).withColumnRenamed("o_orderpriority", "priority_asof")
    # The history becomes a table, as it is in the gold layer: it is read more than once.
    path = work(spark, "history").path("gold", "priorities")
    write_snapshot(history.drop("o_orderkey", "o_orderdate"), path)
    return join_as_of(
        shipped(spark, sf), read_snapshot(spark, path), ["o_custkey"], "l_shipdate", **VERSION
    )


def crowded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Facts and a history in which a third of all orders are those of one customer."""
    orders = table(spark, sf, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *lines.columns, "o_custkey"
    )
    rows = orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    rows = one_per_change(rows, ["o_custkey"], "o_orderdate")
    history = scd2(rows, ["o_custkey"], "o_orderdate", **VERSION)
    history = history.withColumnRenamed("o_orderpriority", "priority_asof")
    path = work(spark, "crowded").path("gold", "priorities")
    write_snapshot(history.drop("o_orderkey", "o_orderdate"), path)
    return facts, read_snapshot(spark, path)


@query
def pit_join_skewed(spark, sf):
    """One customer has thousands of versions: only its facts take the sorted way."""
    facts, history = crowded(spark, sf)
    return join_as_of(facts, history, ["o_custkey"], "l_shipdate", broadcast_rows=0, **VERSION)


@query
def pit_join_hot(spark, sf):
    """The same with each key's rows cut into runs."""
    facts, history = crowded(spark, sf)
    return join_as_of(
        facts, history, ["o_custkey"], "l_shipdate", broadcast_rows=0, policy=HOT, **VERSION
    )


@query
def pit_join_cells(spark, sf):
    """The customer with thousands of versions is met by cells of time."""
    facts, history = crowded(spark, sf)
    return join_as_of(
        facts, history, ["o_custkey"], "l_shipdate", broadcast_rows=0, few=4, cells=True, **VERSION
    )


# Aggregation and de-duplication


@query
def sum_by_key(spark, sf):
    return sum_by(table(spark, sf, "events"), ["user_id"], "value", "total_value", scale=2)


@query
def latest_change(spark, sf):
    return high_watermark(table(spark, sf, "events"), "ts")


@query
def dim_date(spark, sf):
    return distinct_dates(table(spark, sf, "orders"), "o_orderdate")


@query
def dedupe_any(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    return any_per_key(table(spark, sf, "lineitem").select(*keys), keys)


@query
def dedupe_latest(spark, sf):
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def dedupe_change(spark, sf):
    return one_per_change(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


# Row rules


@query
def expect_drop(spark, sf):
    return expect_all_or_drop(listens(spark, sf), {"rule_1": "p_partkey IS NOT NULL"})


@query
def expect_fail(spark, sf):
    rules = {"has_key": "o_orderkey IS NOT NULL", "has_customer": "o_custkey IS NOT NULL"}
    return expect_all_or_fail(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), rules)


CUSTOMER_RULES = {"not_in_debt": "c_acctbal >= 0", "known_segment": "c_mktsegment <> 'MACHINERY'"}


@query
def quarantine(spark, sf):
    _, rejected = split(table(spark, sf, "customer"), {"not_in_debt": "c_acctbal >= 0"})
    return rejected.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query
def rule_counts(spark, sf):
    marked = classify(table(spark, sf, "customer"), CUSTOMER_RULES)
    names = marked.select(F.explode("failed_rules").alias("rule"))
    return names.groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))


# Change application


@query
def scd1_(spark, sf):
    return scd1(changes(spark, sf), ["user_id"], "ts")


@query
def scd2_(spark, sf):
    return scd2(changes(spark, sf), ["user_id"], "ts", **VERSION)


@query
def scd2_tracked(spark, sf):
    return scd2(changes(spark, sf), ["user_id"], "ts", untracked=["value"], **VERSION)


# Every user and customer counts as a key with too many rows, as far as there are that many.
HOT = SkewPolicy(rows_per_task=16, check_above_bytes=0)


@query
def scd1_hot(spark, sf):
    return scd1(changes(spark, sf), ["user_id"], "ts", HOT)


@query
def scd2_hot(spark, sf):
    return scd2(changes(spark, sf), ["user_id"], "ts", policy=HOT, **VERSION)


@query
def scd2_tracked_hot(spark, sf):
    return scd2(changes(spark, sf), ["user_id"], "ts", untracked=["value"], policy=HOT, **VERSION)


@query
def scd2_ties(spark, sf):
    return priorities(spark, sf).select("o_custkey", "o_orderpriority", "start_at", "end_at")


@query
def scd2_closed(spark, sf):
    return closed_versions(scd2_(spark, sf), "end_at")


@query
def scd2_current(spark, sf):
    return current_versions(scd2_(spark, sf), "end_at")


@query
def as_of_(spark, sf):
    return as_of(scd2_(spark, sf), HALF, "start_at", "end_at")


# Incremental ingest

EVENTS = IngestSpec("events", "ts")


def early(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("ts") <= F.lit(HALF).cast("timestamp_ntz"))


def late(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("ts") > F.lit(HALF).cast("timestamp_ntz"))


@query
def ingest_window(spark, sf):
    return read_since(lambda: table(spark, sf, "events"), "ts", HALF)


@query
def ingest_two_runs(spark, sf):
    layers = work(spark, "ingest")
    ingest_table(spark, EVENTS, lambda spec: early(spark, sf), layers)
    ingest_table(spark, EVENTS, lambda spec: table(spark, sf, spec.table), layers)
    return read_layer(spark, layers.path("bronze", "events"))


@query
def backfill_window(spark, sf):
    layers = work(spark, "backfill")
    backfill(spark, EVENTS, lambda spec: table(spark, sf, spec.table), layers, "2024-01-10", HALF)
    return read_layer(spark, layers.path("bronze", "events"))


@query
def ingest_overlap(spark, sf):
    """The second run reads two days again; the repeats go by key and sequence."""
    layers = work(spark, "overlap")
    spec = IngestSpec("events", "ts", overlap="2 days")
    ingest_table(spark, spec, lambda spec: early(spark, sf), layers)
    ingest_table(spark, spec, lambda spec: table(spark, sf, spec.table), layers)
    bronze = read_layer(spark, layers.path("bronze", "events"))
    return one_per_change(bronze, ["user_id"], "ts")


@query
def ingest_late_quiet(spark, sf):
    """Half the rows of a day turn up late, and nothing newer with them."""
    layers = work(spark, "quiet")
    spec = IngestSpec("events", "ts", overlap="3 days")
    day = F.to_date("ts") == F.lit("2024-01-13").cast("date")
    punctual = early(spark, sf).where(~(day & (F.col("event_id") % 2 == 0)))
    for source in (punctual, early(spark, sf), early(spark, sf)):
        ingest_table(spark, spec, lambda spec, source=source: source, layers)
    return read_layer(spark, layers.path("bronze", "events"))


@query
def backfill_silver(spark, sf):
    """A backfill lands rows again; silver has each once."""
    layers = work(spark, "again")
    spec = TableSpec(EVENTS, CdcSpec("events", ["user_id"], "ts", 1, buckets=4), dedupe="change")
    source = changes(spark, sf)
    run(spark, [spec], lambda spec: source, layers)
    backfill(spark, EVENTS, lambda spec: source, layers, "2024-01-10", HALF)
    run(spark, [spec], lambda spec: source, layers)
    return read_layer(spark, layers.path("silver", "events"))


@query
def run_log(spark, sf):
    """Three passes over two tables; the last finds nothing new, and one entry always fails."""
    layers = work(spark, "runs")
    specs = [EVENTS, IngestSpec("orders", "o_orderdate"), IngestSpec("absent", "ts")]
    bulk = {"events": early}
    for readers in (bulk, {}, {}):
        def reader(spec, readers=readers):
            read = readers.get(spec.table)
            return read(spark, sf) if read else table(spark, sf, spec.table)

        record_runs(spark, run_all(spark, specs, reader, layers), layers)
    marks = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("low", "high")]
    return read_runs(spark, layers).select("table", "status", "n_rows", *marks)


@query
def layer_stats_(spark, sf):
    bronze = changes(spark, sf)
    layers = {
        "bronze": bronze,
        "silver": expect_all_or_drop(bronze, {"priced": "value > 10"}),
        "gold": scd1(bronze, ["user_id"], "ts"),
    }
    return layer_stats(layers, "ts", "user_id")


# Streams


@query
def stream_append(spark, sf):
    layers = work(spark, "append")
    stream = drop_columns(table_stream(spark, sf, "events"), ["props", "_rescued_data"])
    append_stream(stream, layers.checkpoint("events"), layers.path("silver", "events"))
    return read_layer(spark, layers.path("silver", "events"))


@query
def stream_evolve(spark, sf):
    """A column that appears in the second batch of files; the first batch reads NULL for it."""
    layers = work(spark, "evolve")
    bronze, silver = layers.path("bronze", "events"), layers.path("silver", "events")
    schema = None
    for batch in (early(spark, sf).drop("props"), late(spark, sf)):
        land(batch, bronze)
        schema = resolve_schema(spark, bronze, layers.state("schema", "events"))
        append_stream(stream_files(spark, bronze, schema), layers.checkpoint("events"), silver)
    return read_layer(spark, silver, schema)


@query
def stream_evolve_nested(spark, sf):
    """The second batch has wider numbers and new fields in a struct, an array and a map."""
    layers = work(spark, "evolve_nested")
    bronze, silver = layers.path("bronze", "events"), layers.path("silver", "events")
    shapes = (
        (early, "int", "named_struct('user', int(user_id))", "named_struct('kind', event_type)"),
        (
            late,
            "bigint",
            "named_struct('props', props, 'user', user_id)",
            "named_struct('kind', event_type, 'value', value)",
        ),
    )
    schema = None
    for part, number, detail, tag in shapes:
        batch = part(spark, sf).selectExpr(
            f"CAST(event_id AS {number}) AS event_id", f"{detail} AS detail",
            f"array({tag}) AS tags", f"map(event_type, CAST(user_id AS {number})) AS users",
        )
        land(batch, bronze)
        schema = resolve_schema(spark, bronze, layers.state("schema", "events"), deep=True)
        append_stream(stream_files(spark, bronze, schema), layers.checkpoint("events"), silver)
    return read_layer(spark, silver, schema).selectExpr(
        "event_id", "detail.user AS user_id", "detail.props AS props", "tags[0].kind AS kind",
        "tags[0].value AS value", "users[tags[0].kind] AS mapped",
    )


@query
def stream_dedupe_(spark, sf):
    layers = work(spark, "dedupe")
    keys = ["l_orderkey", "l_linenumber"]
    stream = stream_dedupe(table_stream(spark, sf, "lineitem").select(*keys), keys)
    append_stream(stream, layers.checkpoint("lineitem"), layers.path("silver", "lineitem"))
    return read_layer(spark, layers.path("silver", "lineitem"))


@query
def stream_dedupe_within(spark, sf):
    """Two runs, the second with rows of the first again: keys are looked up in the days near a batch."""
    layers = work(spark, "within")
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select(*keys, "l_shipdate")
    bronze, silver = layers.path("bronze", "lineitem"), layers.path("silver", "lineitem")
    for batch in (lines.where("l_orderkey % 2 = 0"), lines):
        land(batch, bronze)
        stream = stream_files(spark, bronze, batch.schema)
        # The copies of a line are shipped up to seven years apart.
        append_known(
            stream, keys, "l_shipdate", layers.checkpoint("lineitem"), silver,
            within="2600 days", change=False, period="year",
        )
    return read_layer(spark, silver).select(*keys)


@query
def flow_dedupe_within(spark, sf):
    """The flow with its silver layer kept without state: late rows and copies in three passes."""
    layers = work(spark, "flow_within")
    spec = TableSpec(
        EVENTS, CdcSpec("events", ["user_id"], "ts", 2, buckets=4), dedupe="change", within="0 days"
    )
    source = changes(spark, sf)
    moment = F.lit(HALF).cast("timestamp_ntz")
    run(spark, [spec], lambda spec: source.where(F.col("ts") > moment), layers)
    backfill(spark, EVENTS, lambda spec: source, layers, "2024-01-01", "2024-01-20")
    run(spark, [spec], lambda spec: source, layers)
    backfill(spark, EVENTS, lambda spec: source, layers, "2023-01-01", "2024-02-01")
    run(spark, [spec], lambda spec: source, layers)
    return read_layer(spark, layers.path("silver", "events")).select(*source.columns)


@query
def stream_dedupe_change(spark, sf):
    """Copies of a change go, the changes of a key stay, over two runs that overlap."""
    layers = work(spark, "changes")
    bronze, silver = layers.path("bronze", "events"), layers.path("silver", "events")
    for batch in (early(spark, sf), table(spark, sf, "events")):
        land(batch, bronze)
        stream = stream_files(spark, bronze, batch.schema)
        once = stream_dedupe_changes(stream, ["user_id"], "ts")
        append_stream(once, layers.checkpoint("events"), silver)
    return read_layer(spark, silver)


@query
def stream_dedupe_exact(spark, sf):
    """Payloads that differ by a microsecond are two changes; their copies in a second run go."""
    layers = work(spark, "exact")
    bronze, silver = layers.path("bronze", "events"), layers.path("silver", "events")
    for batch in (early(spark, sf), table(spark, sf, "events")):
        seen = batch.select("event_id", "user_id", F.to_date("ts").alias("day"), F.col("ts").alias("seen"))
        later = seen.withColumn("seen", F.col("seen") + F.expr("INTERVAL 0.000001 SECOND"))
        land(seen.unionAll(later), bronze)
        once = stream_dedupe_changes(stream_files(spark, bronze, seen.schema), ["event_id"], "day")
        append_stream(once, layers.checkpoint("events"), silver)
    return read_layer(spark, silver)


@query
def stream_dedupe_late(spark, sf):
    """The earlier half comes second: what is too late to compare is kept apart, not lost."""
    layers = work(spark, "too_late")
    bronze, silver = layers.path("bronze", "events"), layers.path("silver", "events")
    apart = layers.path("late", "events")
    for batch in (late(spark, sf), early(spark, sf)):
        batch = batch.select("event_id", "user_id", "ts")
        land(batch.unionAll(batch), bronze)
        stream = stream_files(spark, bronze, batch.schema)
        append_within(stream, ["event_id"], "ts", "20 days", layers.checkpoint("events"), silver, apart)
    columns = ["event_id", "user_id", "ts"]
    kept = read_layer(spark, silver).select(*columns, F.lit(False).alias("late"))
    # Late rows are kept as they came, copies included.
    return kept.unionAll(read_layer(spark, apart).select(*columns, F.lit(True).alias("late")))


@query
def stream_quarantine(spark, sf):
    layers = work(spark, "reject")
    spec = CdcSpec("customer", ["c_custkey"], "c_acctbal", 1, CUSTOMER_RULES, buckets=4)
    stage(table_stream(spark, sf, "customer"), spec, layers, quarantine=True)
    rejected = read_layer(spark, layers.path("quarantine", "customer"))
    return rejected.select("c_custkey", F.array_join("failed_rules", ",").alias("failed_rules"))


def applied(spark: SparkSession, sf: str, spec: CdcSpec, batches: list[DataFrame] | None = None) -> DataFrame:
    """The gold table after a run per batch, or after one run over the whole table."""
    layers = work(spark, spec.flow)
    if batches is None:
        source = table_stream(spark, sf, "events").select(*changes(spark, sf).columns)
        stage(source, spec, layers)
        apply_changes(spark, spec, source.schema, layers)
    for batch in batches or []:
        land(batch, layers.path("bronze", spec.table))
        source = stream_files(spark, layers.path("bronze", spec.table), batch.schema)
        stage(source, spec, layers)
        apply_changes(spark, spec, source.schema, layers)
    return named(read_gold(spark, spec, layers, source.schema))


@query
def stream_scd1(spark, sf):
    return applied(spark, sf, CdcSpec("events", ["user_id"], "ts", 1, buckets=8))


@query
def stream_scd2(spark, sf):
    return applied(spark, sf, CdcSpec("events", ["user_id"], "ts", 2, buckets=8))


@query
def stream_rules(spark, sf):
    """Rules hold on the way into the log and again on the target."""
    rules = {"priced": "value > 10", "known": "event_type IS NOT NULL"}
    return applied(spark, sf, CdcSpec("events", ["user_id"], "ts", 2, rules, buckets=8))


def filled(spark: SparkSession, sf: str, spec: CdcSpec, rows: DataFrame, layers: Layers) -> T.StructType:
    """A run of the flow over some of the events; gives their schema."""
    rows = rows.select(*changes(spark, sf).columns)
    land(rows, layers.path("bronze", spec.table))
    source = stream_files(spark, layers.path("bronze", spec.table), rows.schema)
    stage(source, spec, layers)
    apply_changes(spark, spec, rows.schema, layers)
    return rows.schema


@query
def rebuild_rebucketed(spark, sf):
    """The whole table again, in fewer buckets: nothing of the old layout stays."""
    layers = work(spark, "rebucketed")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=8, period="week")
    schema = filled(spark, sf, spec, table(spark, sf, "events"), layers)
    fewer = replace(spec, buckets=2)
    rebuild(spark, fewer, schema, layers)
    return named(read_gold(spark, fewer, layers, schema))


@query
def rebuild_rule_change(spark, sf):
    """The whole table again, under rules it didn't have before."""
    layers = work(spark, "ruled")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=8)
    schema = filled(spark, sf, spec, table(spark, sf, "events"), layers)
    ruled = replace(spec, rules={"priced": "value > 10", "known": "event_type IS NOT NULL"})
    rebuild(spark, ruled, schema, layers)
    return named(read_gold(spark, ruled, layers, schema))


@query
def apply_after_spec_change(spark, sf):
    """Other buckets and another way to merge from one run to the next."""
    layers = work(spark, "changed")
    first = CdcSpec("events", ["user_id"], "ts", 2, buckets=8)
    filled(spark, sf, first, early(spark, sf), layers)
    then = replace(first, buckets=3, merge="log")
    schema = filled(spark, sf, then, late(spark, sf), layers)
    return named(read_gold(spark, then, layers, schema))


@query
def stream_scd2_late(spark, sf):
    """The later half first: the earlier rows must find their place in the history."""
    columns = changes(spark, sf).columns
    batches = [late(spark, sf).select(*columns), early(spark, sf).select(*columns)]
    spec = CdcSpec("events", ["user_id"], "ts", 2, untracked=["value"], buckets=8)
    return applied(spark, sf, spec, batches)


@query
def stream_scd2_runs(spark, sf):
    """Four runs out of order, merged by runs of like changes: a late row splits the run it falls into."""
    rows = changes(spark, sf)
    parts = [rows.where(F.pmod(F.hash("ts"), F.lit(4)) == k) for k in (2, 0, 3, 1)]
    spec = CdcSpec("events", ["user_id"], "ts", 2, untracked=["value"], buckets=4, merge="table", period="week")
    return applied(spark, sf, spec, parts)


@query
def apply_after_compaction(spark, sf):
    """The log is compacted after each run; late rows then find it as it is, and recompute from it."""
    rows = changes(spark, sf)
    parts = [rows.where(F.pmod(F.hash("ts"), F.lit(3)) == k) for k in (1, 0, 2)]
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=4, merge="log", compact_after=1)
    return applied(spark, sf, spec, parts)


@query
def rebuild_after_compaction(spark, sf):
    """Rules that come after a compaction: what the old ones left out of the table is in the log still."""
    layers = work(spark, "compacted")
    spec = CdcSpec("events", ["user_id"], "ts", 2, {"priced": "value > 50"}, buckets=4, compact_after=1)
    open_ = replace(spec, rules={})
    filled(spark, sf, open_, early(spark, sf), layers)
    schema = filled(spark, sf, open_, late(spark, sf), layers)
    rebuild(spark, spec, schema, layers)
    ruled = replace(spec, rules={"priced": "value > 10", "known": "event_type IS NOT NULL"})
    rebuild(spark, ruled, schema, layers)
    return named(read_gold(spark, ruled, layers, schema))


@query
def release_rejected(spark, sf):
    """Rows in quarantine come into the table once rules change that kept them out."""
    layers = work(spark, "released")
    strict = CdcSpec("events", ["user_id"], "ts", 2, {"priced": "value > 50"}, buckets=4)
    loose = replace(strict, rules={"priced": "value > 10", "known": "event_type IS NOT NULL"})
    for spec, rows in ((strict, early(spark, sf)), (loose, late(spark, sf))):
        rows = rows.select(*changes(spark, sf).columns)
        land(rows, layers.path("bronze", "events"))
        source = stream_files(spark, layers.path("bronze", "events"), rows.schema)
        stage(source, spec, layers, quarantine=True)
        apply_changes(spark, spec, rows.schema, layers)
    return named(read_gold(spark, loose, layers, rows.schema))


@query
def recover_twice(spark, sf):
    """Two crashes in a row: one in the middle of a write, one while its marker was being written."""
    layers = work(spark, "crashed")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=4)
    filled(spark, sf, spec, early(spark, sf), layers)
    # What they leave behind: files of a bucket gone, and a marker without its end.
    remove_folder(spark, f"{layers.path('gold', 'events')}/__bucket=1")
    put_marker(spark, f"{layers.state('attempt', 'events')}/cut-short", "1 2")
    schema = filled(spark, sf, spec, late(spark, sf), layers)
    return named(read_gold(spark, spec, layers, schema))


@query
def stream_merge_scd1(spark, sf):
    """Two runs, the later half first, each merged with the rows the table has."""
    columns = changes(spark, sf).columns
    batches = [late(spark, sf).select(*columns), early(spark, sf).select(*columns)]
    return applied(spark, sf, CdcSpec("events", ["user_id"], "ts", 1, buckets=8, merge="table"), batches)


@query
def stream_merge_scd2(spark, sf):
    """Two runs in time order: the second reads and rewrites the current versions only."""
    columns = changes(spark, sf).columns
    batches = [early(spark, sf).select(*columns), late(spark, sf).select(*columns)]
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=8, merge="table", period="week")
    return applied(spark, sf, spec, batches)


@query
def gold_as_of(spark, sf):
    """The history as it was at a moment, from the periods that end after it."""
    layers = work(spark, "as_of")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=4, period="week")
    schema = filled(spark, sf, spec, table(spark, sf, "events"), layers)
    return named(read_as_of(spark, spec, layers, schema, HALF))


@query
def gold_changes(spark, sf):
    """What became of the history in five days: versions that came, and versions that went."""
    layers = work(spark, "feed")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=4, period="week")
    schema = filled(spark, sf, spec, table(spark, sf, "events"), layers)
    feed = changes_between(spark, spec, layers, schema, "2024-01-01 02:00:00", "2024-01-06")
    return named(feed).withColumnRenamed("__change", "change")


@query
def sum_incremental(spark, sf):
    """Sums over the versions in force, kept over three runs with late rows: versions that went are taken back."""
    layers = work(spark, "kept_sums")
    spec = CdcSpec("events", ["user_id"], "ts", 2, buckets=4, period="week")
    sums = SumSpec("in_force", spec, ["event_type"], {"total_value": ("value", 2)}, "__END_AT IS NULL")
    rows = changes(spark, sf)
    for k in (1, 0, 2):
        schema = filled(spark, sf, spec, rows.where(F.pmod(F.hash("ts"), F.lit(3)) == k), layers)
        found = kept_sums(spark, sums, layers, schema)
    return found.withColumn("total_value", F.col("total_value").cast("double"))


@query
def snapshot_sum(spark, sf):
    """Two datasets, the second computed from the first as it was written."""
    layers = work(spark, "datasets")
    write_snapshot(changes(spark, sf), layers.path("gold", "trips"))
    trips = read_snapshot(spark, layers.path("gold", "trips"))
    write_snapshot(
        sum_by(trips, ["user_id"], "value", "total_value", scale=2), layers.path("gold", "totals")
    )
    return read_snapshot(spark, layers.path("gold", "totals"))


@query
def refresh_downstream(spark, sf):
    """Three datasets in a row and one beside; the first is refreshed, and what is made from it follows."""
    layers = work(spark, "graph")
    datasets = [
        Dataset("bands", ["totals"], lambda totals: totals.groupBy(
            F.floor(F.col("total_value") / 100).alias("band")).agg(F.count("*").alias("n_users"))),
        Dataset("totals", ["trips"], lambda trips: sum_by(trips, ["user_id"], "value", "total_value", scale=2)),
        Dataset("kinds", ["trips"], lambda trips: trips.select("event_type").distinct()),
        Dataset("trips", ["events"], lambda events: events.select("user_id", "event_type", "value")),
    ]
    refresh(spark, datasets, lambda name: early(spark, sf), layers)
    refresh(spark, datasets, lambda name: table(spark, sf, name), layers, only=["trips"])
    return read_dataset(spark, layers, "bands")


# The whole flow


def warehouse(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The test tables in the shape of a listening warehouse."""
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    events = table(spark, sf, "events")
    loaded = F.lit("2024-01-01").cast("timestamp_ntz")
    return {
        "DimUser": orders.select(
            F.col("o_custkey").alias("user_id"),
            F.concat(F.lit("user-"), "o_custkey").alias("user_name"),
            F.col("o_orderpriority").alias("subscription_type"),
            F.col("o_orderdate").alias("updated_at"),
        ),
        "DimTrack": part.select(
            F.col("p_partkey").alias("track_id"),
            F.concat_ws("-", "p_brand", "p_name").alias("track_name"),
            (F.col("p_size") * 10).alias("duration_sec"),
            loaded.alias("updated_at"),
        ),
        "FactStream": events.select(
            F.col("event_id").alias("stream_id"),
            "user_id",
            F.col("event_id").alias("track_id"),
            F.col("value").alias("listen_duration"),
            F.col("ts").alias("stream_timestamp"),
        ),
    }


WAREHOUSE = [
    TableSpec(
        IngestSpec("DimUser", "updated_at"),
        CdcSpec("DimUser", ["user_id"], "updated_at", 2, {"rule_1": "user_id IS NOT NULL"}, buckets=8,
                merge="table", period="year"),
        clean=[lambda df: upper_columns(df, ["user_name"])],
        dedupe="change",
    ),
    TableSpec(
        IngestSpec("DimTrack", "updated_at"),
        CdcSpec("DimTrack", ["track_id"], "updated_at", 2, buckets=8),
        clean=[
            lambda df: df.withColumn("durationflag", bucketize("duration_sec", DURATIONS, LONGEST)),
            lambda df: regex_clean(df, "track_name"),
        ],
    ),
    TableSpec(
        IngestSpec("FactStream", "stream_timestamp"),
        CdcSpec("FactStream", ["stream_id"], "stream_timestamp", 1, buckets=8),
    ),
]


@query
def medallion_star(spark, sf):
    """Source to bronze to silver to gold for three tables, then the configured star join."""
    layers = work(spark, "medallion")
    source = warehouse(spark, sf)
    run(spark, WAREHOUSE, lambda spec: source[spec.table], layers)
    specs = [
        JoinSpec("FactStream", "f", "f.stream_id, f.listen_duration"),
        JoinSpec("DimUser", "u", "u.user_id, u.user_name, u.subscription_type", "f.user_id = u.user_id"),
        JoinSpec("DimTrack", "t", "t.track_id, t.track_name, t.durationflag", "f.track_id = t.track_id"),
    ]
    return build_join(spark, specs, serving(spark, WAREHOUSE, layers))


@query
def rules_all_gold(spark, sf):
    """Rows without a key reach no gold table; each is in quarantine. Rows per table and place."""
    layers = work(spark, "ruled_gold")
    source = warehouse(spark, sf)
    # Few buckets and long periods, as the tables are small.
    specs = [
        replace(s, cdc=replace(s.cdc, buckets=4, period="year"), salts=0)
        for s in TABLES
        if s.table in source
    ]
    for spec in specs:
        key = spec.cdc.keys[0]
        source[spec.table] = source[spec.table].withColumn(
            key, F.when(F.col(key) % 10 != 0, F.col(key))
        )
    run(spark, specs, lambda spec: source[spec.table], layers, quarantine=True)

    def counted(spec: TableSpec, place: str, rows: DataFrame) -> DataFrame:
        key = F.col(spec.cdc.keys[0])
        return rows.agg(F.count("*").alias("n_rows"), F.count(key).alias("n_keys")).select(
            F.lit(spec.table).alias("table"), F.lit(place).alias("place"), "n_rows", "n_keys"
        )

    parts = [
        counted(s, place, rows)
        for s in specs
        for place, rows in (
            ("gold", read_gold(spark, s.cdc, layers, silver_schema(spark, s, layers))),
            ("quarantine", read_layer(spark, layers.path("quarantine", s.table))),
        )
    ]
    return reduce(DataFrame.unionAll, parts)


@query
def catalog_layers(spark, sf):
    """A pass whose silver and gold tables have names, read by name."""
    folder = scratch_dir(spark, "named")
    layers = Layers(folder, schema=f"strata_{uuid.uuid4().hex}")
    source = warehouse(spark, sf)
    run(spark, WAREHOUSE, lambda spec: source[spec.table], layers, only=["FactStream"])
    columns = ["stream_id", "user_id", "track_id", "listen_duration", "stream_timestamp"]
    gold = read_table(spark, layers.table("gold", "FactStream")).select(*columns)
    silver = read_table(spark, layers.table("silver", "FactStream")).select("stream_id")
    return gold.join(silver, "stream_id", "left_semi")


@query
def catalog_widened(spark, sf):
    """A column that the second pass brings is in the named tables too; earlier rows have NULL there."""
    layers = Layers(scratch_dir(spark, "widened"), schema=f"strata_{uuid.uuid4().hex}")
    facts = warehouse(spark, sf)["FactStream"]
    half = facts.where(F.col("stream_timestamp") <= F.lit(HALF).cast("timestamp_ntz"))
    wider = facts.withColumn("device_type", F.concat(F.lit("device "), F.col("user_id") % 3))
    for rows in (half, wider):
        run(spark, WAREHOUSE, lambda spec, rows=rows: rows, layers, only=["FactStream"])
    columns = ["stream_id", "user_id", "device_type", "stream_timestamp"]
    gold = read_table(spark, layers.table("gold", "FactStream")).select(*columns)
    silver = read_table(spark, layers.table("silver", "FactStream")).select("stream_id", "device_type")
    both = (gold["stream_id"] == silver["stream_id"]) & gold["device_type"].eqNullSafe(silver["device_type"])
    return gold.join(silver, both, "left_semi")


@query
def run_stats(spark, sf):
    """Rows and newest change of each layer after each of two passes."""
    layers = work(spark, "stats")
    source = warehouse(spark, sf)
    facts = source["FactStream"]
    half = facts.where(F.col("stream_timestamp") <= F.lit(HALF).cast("timestamp_ntz"))
    for rows in (half, facts):
        run(spark, WAREHOUSE, lambda spec, rows=rows: rows, layers, only=["FactStream"], stats=True)
    newest = F.col("newest").cast("timestamp_ntz").alias("newest")
    return read_stats(spark, layers).select("table", "layer", "n_rows", newest)


@query
def refresh_one(spark, sf):
    """A pass over a single table of the warehouse."""
    layers = work(spark, "refresh")
    source = warehouse(spark, sf)
    run(spark, WAREHOUSE, lambda spec: source[spec.table], layers, only=["DimUser"])
    users = read_gold(spark, WAREHOUSE[0].cdc, layers)
    return named(users).select("user_id", "user_name", "subscription_type", "start_at", "end_at")
