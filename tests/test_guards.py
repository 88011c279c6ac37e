"""What must not get lost, stay behind or slip through: changed specs, broken runs, rules, digests."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_history import expected
from test_streaming import changes, dated, dated_flow, flow

import strataflow.streaming.cdc as cdc
from strataflow.config import CdcSpec, IngestSpec, TableSpec
from strataflow.functions.keys import from_micros, payload_order, row_digest, to_micros
from strataflow.operators import RuleBroken, expect_all_or_fail
from strataflow.plans import run
from strataflow.plans.ingest import land
from strataflow.plans.monitor import read_stats
from strataflow.plans.music import serving
from strataflow.plans.pipeline import start
from strataflow.sources import stream_files
from strataflow.sources.jdbc import database_options
from strataflow.streaming import append_within, read_snapshot, rebuild, write_snapshot


def digests(df, columns):
    return [tuple(r) for r in df.select(*row_digest(df, columns)).collect()]


def test_digest_tells_values_apart(spark):
    nested = "struct<a:string,b:string>, l array<string>, ll array<array<string>>, m map<string,int>"
    df = spark.createDataFrame(
        [
            (("x", None), ["x", None], [["x"], ["y"]], {"a": 1, "b": 2}),
            ((None, "x"), [None, "x"], [["x", "y"]], {"a": 2, "b": 1}),
            (None, None, None, None),
            (("x", ""), ["x", ""], [["x"], ["y"], []], {}),
        ],
        f"s {nested}",
    )
    for column in df.columns:
        assert len(set(digests(df, [column]))) == 4, column
    swapped = spark.createDataFrame([("x", None), (None, "x"), ("", "x")], "a string, b string")
    assert len(set(digests(swapped, ["a", "b"]))) == 3
    instants = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.000001' t UNION ALL SELECT timestamp_ntz'2024-01-01'"
    )
    assert len(set(digests(instants, ["t"]))) == 2


def test_digest_ignores_an_added_null_column_and_map_order(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1, 'b', 2) AS m, CAST(NULL AS int) AS later")
    other = spark.sql("SELECT 1 AS k, map('b', 2, 'a', 1) AS m")
    assert digests(df, ["k", "m", "later"]) == digests(other, ["k", "m"])


def test_maps_inside_structs_can_be_ordered(spark):
    df = spark.sql("SELECT named_struct('m', map('b', 2, 'a', 1), 'n', array(map(1, 2))) AS s")
    assert df.orderBy(*payload_order(df, [])).count() == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_micros_and_back(spark, kind):
    df = spark.sql(f"SELECT CAST('2024-03-31 23:59:58.123457' AS {kind}) AS t")
    kind = df.schema["t"].dataType
    again = df.select("t", from_micros(to_micros(F.col("t"), kind), kind).alias("u")).first()
    assert again["t"] == again["u"]


def test_late_rows_are_kept_apart_and_a_batch_can_repeat(spark, layers):
    day = datetime(2024, 1, 1)
    batches = [[(1, day + timedelta(40)), (1, day + timedelta(40)), (2, None)],
               [(3, day), (4, day + timedelta(35)), (1, day + timedelta(41)), (2, None)]]
    bronze, kept, late = (layers.path(x, "t") for x in ("bronze", "silver", "late"))
    for batch in batches:
        land(spark.createDataFrame(batch, "k int, at timestamp_ntz"), bronze)
        stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema)
        append_within(stream, ["k"], "at", "10 days", layers.checkpoint("t"), kept, late)
    assert rows(spark.read.parquet(kept), "k") == [(1,), (2,), (4,)]
    assert rows(spark.read.parquet(late), "k") == [(3,)]


@pytest.mark.parametrize("merge", ["table", "log"])
def test_another_spec_writes_the_table_anew(spark, layers, merge):
    data = dated(changes(80, 4))
    spec = CdcSpec("t", ["k"], "at", 2, buckets=8)
    dated_flow(spark, layers, spec, data[:50])
    then = replace(spec, buckets=3, merge=merge, period="year")
    assert dated_flow(spark, layers, then, data[50:]) == expected(data)
    assert dated_flow(spark, layers, then, data[10:20]) == expected(data)
    again = replace(spec, buckets=8, merge=merge)
    assert dated_flow(spark, layers, again, data[:1]) == expected(data)


def test_recovery_redoes_the_named_buckets_only(spark, layers, monkeypatch):
    data = dated(changes(90, 11))
    spec = CdcSpec("t", ["k"], "at", 2, buckets=8)
    dated_flow(spark, layers, spec, data[:60])
    real, seen = cdc._replace, []

    def dies(state, spec, target, balance=False):
        real(state.where("u <> 1"), spec, target, balance)
        raise OSError("driver lost")

    def watched(state, spec, target, balance=False):
        seen.append((balance, {r[0] for r in state.select("__bucket").distinct().collect()}))
        real(state, spec, target, balance)

    one_key = [row for row in data[60:] if row[0] == 40]
    with monkeypatch.context() as patch:
        patch.setattr(cdc, "_replace", dies)
        with pytest.raises(Exception, match="driver lost"):
            dated_flow(spark, layers, spec, one_key)
    with monkeypatch.context() as patch:
        patch.setattr(cdc, "_replace", watched)
        assert dated_flow(spark, layers, spec, []) == expected(data[:60] + one_key)
    assert [balance for balance, _ in seen] == [False] and len(seen[0][1]) == 1


def test_more_buckets_than_can_be_named(spark, layers, monkeypatch):
    monkeypatch.setattr(cdc, "MOST_NAMED", 2)
    data = dated(changes(90, 12))
    for name, merge in (("a", "table"), ("b", "log")):
        spec = CdcSpec(name, ["k"], "at", 2, buckets=8, merge=merge)
        dated_flow(spark, layers, spec, data[:60])
        assert dated_flow(spark, layers, spec, data[60:]) == expected(data)


def test_a_rule_can_stop_the_flow(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 1, {"known": "t <> 'X'"}, buckets=2, on_broken="fail")
    before = flow(spark, layers, spec, [(1, "A", 0, 1)])
    with pytest.raises(Exception, match="rule known is broken by 2 rows"):
        flow(spark, layers, spec, [(1, "X", 0, 2), (2, "X", 0, 2), (3, "B", 0, 2)])
    assert rows(cdc.read_gold(spark, spec, layers)) == before
    schema = spark.createDataFrame([], "k int, t string, u int, at int").schema
    with pytest.raises(RuleBroken):
        rebuild(spark, spec, schema, layers)
    assert rows(cdc.read_gold(spark, spec, layers)) == before


def test_no_filter_hides_a_broken_rule(spark):
    df = spark.createDataFrame([(None,), (7,)], "k int")
    with pytest.raises(RuleBroken, match="rule key is broken by 1 rows"):
        expect_all_or_fail(df, {"key": "k IS NOT NULL"}).where("k > 5").limit(1).collect()


def test_a_broken_snapshot_is_not_published(spark, tmp_path):
    path, rules = str(tmp_path), {"key": "k IS NOT NULL"}
    good = spark.createDataFrame([(1,)], "k int")
    write_snapshot(good, path, rules)
    with pytest.raises(RuleBroken):
        write_snapshot(good.union(spark.createDataFrame([(None,)], "k int")), path, rules)
    assert rows(read_snapshot(spark, path)) == [(1,)]
    for k in (2, 3):
        write_snapshot(spark.createDataFrame([(k,)], "k int"), path, rules, keep=2)
    assert rows(read_snapshot(spark, path)) == [(3,)]
    assert len(list(tmp_path.glob("*-*"))) == 2


def test_database_reads_need_bounds():
    found = database_options("jdbc:x", "t", "id", 0, 100, 8, fetchsize="1000")
    assert found == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "1000", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert database_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    for wrong in ({"split_by": "id"}, {"split_by": "id", "lower": 1, "upper": 2}, {"partitions": 4}):
        with pytest.raises(ValueError):
            database_options("jdbc:x", "t", **wrong)


SOURCE = "k int, t string, u int, at timestamp_ntz"


def test_serving_reads_open_versions_and_no_footer(spark, layers):
    spec = TableSpec(IngestSpec("t", "at"), CdcSpec("t", ["k"], "at", 2, buckets=2), dedupe="change")
    data = dated(changes(40, 5))
    run(spark, [spec], lambda _: spark.createDataFrame(data, SOURCE), layers, stats=True)
    current = serving(spark, [spec], layers)["t"]
    text = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__until" in text
    assert rows(current) == [r for r in expected(data) if r[-1] is None]
    stats = rows(read_stats(spark, layers), "layer", "n_rows")
    assert [s[0] for s in stats] == ["bronze", "gold", "silver"] and stats[0][1] == 40


def test_flows_that_run_on_give_their_handles(spark, layers):
    spec = TableSpec(IngestSpec("t", "at"), CdcSpec("t", ["k"], "at", 1, buckets=2, once=False))
    source = lambda *ks: spark.createDataFrame(
        [(k, "A", 0, datetime(2024, 1, k)) for k in ks], SOURCE
    )
    run(spark, [spec], lambda _: source(1), layers)
    running = start(spark, [spec], layers, interval="1 second")["t"]
    try:
        assert len(running) == 3 and all(q.isActive for q in running)
        run(spark, [spec], lambda _: source(1, 2), layers)
        for query in running:
            query.processAllAvailable()
        assert rows(cdc.read_gold(spark, spec.cdc, layers), "k") == [(1,), (2,)]
    finally:
        for query in running:
            query.stop()
