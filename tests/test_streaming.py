import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from test_history import expected

from strataflow.config import CdcSpec, Layers, SkewPolicy
from strataflow.functions.keys import bucket_of
from strataflow.plans.ingest import land
from strataflow.sources import stream_files
from strataflow.streaming import (
    append_stream, apply_changes, read_current, read_gold, read_snapshot, rebuild, stage, stream_dedupe,
    stream_dedupe_changes, write_snapshot,
)

SCHEMA = "k int, t string, u int, at int"


def flow(spark, layers, spec, data):
    land(spark.createDataFrame(data, SCHEMA), layers.path("bronze", spec.table))
    schema = spark.createDataFrame([], SCHEMA).schema
    stage(stream_files(spark, layers.path("bronze", spec.table), schema), spec, layers, quarantine=True)
    apply_changes(spark, spec, schema, layers)
    return rows(read_gold(spark, spec, layers))


DATED = "k int, t string, u int, at timestamp_ntz"


def dated(data):
    """The same changes, a sequence step being five days."""
    return [(k, t, u, datetime(2024, 1, 1) + timedelta(days=5 * at)) for k, t, u, at in data]


def dated_flow(spark, layers, spec, data, schema=DATED):
    df = spark.createDataFrame(data, schema)
    land(df, layers.path("bronze", spec.table))
    stage(stream_files(spark, layers.path("bronze", spec.table), df.schema), spec, layers)
    apply_changes(spark, spec, df.schema, layers)
    return rows(read_gold(spark, spec, layers, df.schema))


def changes(n, seed):
    rnd = random.Random(seed)
    return [
        (rnd.choice([1, 2, 3, 40, 41, None]), rnd.choice("AB"), rnd.randrange(3), rnd.randrange(60))
        for _ in range(n)
    ]


@pytest.mark.parametrize("untracked", [(), ("u",)])
def test_any_split_and_order_gives_the_same_history(spark, tmp_path, untracked):
    data = changes(120, 3)
    want = expected(data, bool(untracked))
    spec = CdcSpec("t", ["k"], "at", 2, untracked=untracked, buckets=4)
    parts = [data[:50], data[50:90], data[90:], data[20:60]]
    for i, order in enumerate(([0, 1, 2, 3], [2, 3, 0, 1])):
        layers = Layers(str(tmp_path / str(i)))
        found = [flow(spark, layers, spec, parts[p]) for p in order]
        assert found[-1] == want


def test_type_1_equals_the_current_versions(spark, tmp_path):
    data = changes(80, 4)
    one = flow(spark, Layers(str(tmp_path / "1")), CdcSpec("t", ["k"], "at", 1, buckets=4), data)
    assert one == sorted(
        (r[:4] for r in expected(data) if r[5] is None), key=lambda r: (r[0] is not None, r)
    )


def test_rules_apply_and_rejects_are_kept(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 2, {"rule_1": "k IS NOT NULL"}, buckets=2)
    found = flow(spark, layers, spec, [(1, "A", 0, 5), (None, "A", 0, 5), (2, "B", 0, None)])
    assert found == [(1, "A", 0, 5, 5, None)]
    rejected = spark.read.parquet(layers.path("quarantine", "t"))
    assert rows(rejected, "k", "failed_rules") == [(None, ["rule_1"]), (2, ["has_sequence"])]


def files_of(spark, layers, bucket):
    found = spark.read.parquet(layers.path("gold", "t")).inputFiles()
    return {name for name in found if f"__bucket={bucket}/" in name}


def test_only_touched_buckets_are_rewritten(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 2, bucket_expr="k div 100")
    flow(spark, layers, spec, [(1, "A", 0, 1), (101, "A", 0, 1)])
    before = files_of(spark, layers, 0)
    found = flow(spark, layers, spec, [(102, "B", 0, 1)])
    assert before and files_of(spark, layers, 0) == before
    assert [r[0] for r in found] == [1, 101, 102]


def test_a_run_without_new_rows_and_a_rebuild_change_nothing(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 2, buckets=4)
    data = changes(40, 6)
    found = flow(spark, layers, spec, data)
    schema = spark.createDataFrame([], SCHEMA).schema
    apply_changes(spark, spec, schema, layers)
    assert rows(read_gold(spark, spec, layers)) == found
    width = spark.conf.get("spark.sql.shuffle.partitions")
    rebuild(spark, spec, schema, layers)
    assert rows(read_gold(spark, spec, layers)) == found
    assert spark.conf.get("spark.sql.shuffle.partitions") == width


def test_hot_key_is_split_in_a_stream(spark, layers):
    data = [(1, "AAB"[at % 3], at % 5, at) for at in range(200)] + [(1, "A", 0, 9)] * 100 + changes(60, 8)
    spec = CdcSpec(
        "t", ["k"], "at", 2, untracked=("u",), buckets=4,
        skew=SkewPolicy(rows_per_task=30, check_above_bytes=0),
    )
    assert flow(spark, layers, spec, data) == expected(data, True)


def test_hash_buckets_follow_the_shuffle(spark):
    df = spark.range(2000).repartition(8, "id")
    placed = df.selectExpr("spark_partition_id() AS p", "id").withColumn("b", bucket_of(["id"], 4))
    assert placed.groupBy("p").agg({"b": "min"}).count() == 8
    assert placed.select("p", "b").distinct().count() == 8


def test_wrong_type_is_refused(spark, layers):
    from strataflow.streaming.cdc import state_of

    with pytest.raises(ValueError):
        state_of(spark.createDataFrame([], SCHEMA), CdcSpec("t", ["k"], "at", 3))


@pytest.mark.parametrize("salts", [0, 4])
def test_key_dedupe_remembers_between_runs(spark, layers, salts):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    for batch in ([(1, "Free", 1)] * 5, [(1, "Premium", 2), (3, "Free", 2), (None, "x", 1), (None, "x", 1)]):
        land(spark.createDataFrame(batch, "id int, plan string, at int").repartition(3), bronze)
        stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema)
        append_stream(stream_dedupe(stream, ["id"], salts=salts), layers.checkpoint("u"), silver)
    assert rows(spark.read.parquet(silver)) == [(None, "x", 1), (1, "Free", 1), (3, "Free", 2)]


def test_key_dedupe_keeps_one_state_and_thins_before_it(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    # NULL keys, text keys, and two thirds of all rows with one key.
    land(spark.range(60_000, numPartitions=2).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 7 WHEN id % 2 = 0 THEN id END AS k", "string(id % 3 > 0) AS s", "id AS v"
    ), bronze)
    stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema)
    query = append_stream(stream_dedupe(stream, ["k", "s"]), layers.checkpoint("u"), silver)
    assert rows(spark.read.parquet(silver), "k", "s") == [
        (None, "false"), *sorted({(n, "false") for n in range(0, 60_000, 6)} | {(7, "true")})
    ]
    done = next(p for p in query.recentProgress if p["numInputRows"])
    assert [s["numRowsUpdated"] for s in done["stateOperators"]] == [10_002]
    # Copies that reach the state: one per key and 10,000 rows at most, of 49,998.
    assert done["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"] <= 20


def test_key_dedupe_thins_what_other_filters_leave(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    land(spark.range(1_000, numPartitions=1).selectExpr("id % 10 AS k", "id AS v"), bronze)
    stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema).where("v >= 990")
    append_stream(stream_dedupe(stream, ["k"]), layers.checkpoint("u"), silver)
    assert rows(spark.read.parquet(silver)) == [(k, 990 + k) for k in range(10)]


def test_key_dedupe_on_a_nested_key(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    land(spark.range(100).selectExpr("named_struct('a', id % 3) AS k"), bronze)
    stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema)
    append_stream(stream_dedupe(stream, ["k"], salts=2), layers.checkpoint("u"), silver)
    assert rows(spark.read.parquet(silver), "k.a") == [(0,), (1,), (2,)]


def test_change_dedupe_drops_copies_only(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    narrow, wide = "id int, plan string, at int", "id int, plan string, at int, mail string"
    runs = [
        ([(1, "Free", 1)] * 2, narrow),
        ([(1, "Premium", 2), (1, "Free", 1), (1, "Family", 2)], narrow),
        ([(1, "Free", 1, None), (1, "Free", 1, "x@y"), (3, "Free", 2, None)], wide),
    ]
    for batch, schema in runs:
        df = spark.createDataFrame(batch, schema)
        land(df, bronze)
        stream = stream_files(spark, bronze, df.schema)
        append_stream(stream_dedupe_changes(stream, ["id"], "at"), layers.checkpoint("u"), silver)
    assert rows(spark.read.schema(df.schema).parquet(silver), "id", "plan", "at", "mail") == sorted([
        (1, "Family", 2, None), (1, "Free", 1, None), (1, "Free", 1, "x@y"),
        (1, "Premium", 2, None), (3, "Free", 2, None),
    ], key=lambda r: [(v is not None, v) for v in r])


def test_bounded_dedupe_on_wall_clock_time(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    land(spark.sql("SELECT explode(array(1, 1, 2)) AS id, timestamp_ntz'2024-01-01' AS ts"), bronze)
    stream = stream_files(spark, bronze, spark.read.parquet(bronze).schema)
    bounded = stream_dedupe(stream, ["id"], within=("ts", "1 day"), salts=2)
    assert bounded.columns == ["id", "ts"]
    append_stream(bounded, layers.checkpoint("u"), silver)
    assert rows(spark.read.parquet(silver), "id") == [(1,), (2,)]


def test_continuous_stream_runs_until_stopped(spark, layers):
    bronze, silver = layers.path("bronze", "u"), layers.path("silver", "u")
    land(spark.range(5), bronze)
    stream = stream_files(spark, bronze, spark.range(1).schema)
    query = append_stream(stream, layers.checkpoint("u"), silver, name="numbers", once=False, interval="1 second")
    try:
        assert query.isActive and query.name == "numbers"
        query.processAllAvailable()
        assert spark.read.parquet(silver).count() == 5
    finally:
        query.stop()


def test_snapshots(spark, layers):
    path = layers.path("gold", "s")
    write_snapshot(spark.range(3), path)
    write_snapshot(read_snapshot(spark, path).where("id > 0"), path)
    assert read_snapshot(spark, path).count() == 2
    with pytest.raises(Exception):
        write_snapshot(spark.range(3).selectExpr("raise_error('x') AS id"), path)
    assert read_snapshot(spark, path).count() == 2


def test_a_run_cut_short_is_repeated(spark, layers, monkeypatch):
    """The target is written but the batch is not yet marked done; then everything runs again."""
    import strataflow.streaming.cdc as cdc

    spec = CdcSpec("t", ["k"], "at", 2, buckets=4)
    data = changes(60, 9)
    real = cdc._replace

    def dies(state, spec, target, balance=False):
        real(state, spec, target, balance)
        raise OSError("driver lost")

    monkeypatch.setattr(cdc, "_replace", dies)
    with pytest.raises(Exception, match="driver lost"):
        flow(spark, layers, spec, data[:30])
    monkeypatch.setattr(cdc, "_replace", real)
    assert flow(spark, layers, spec, data[30:]) == expected(data)


def test_continuous_change_flow(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 1, buckets=2, name="live", once=False)
    bronze = layers.path("bronze", "t")
    land(spark.createDataFrame([(1, "A", 0, 1), (1, "B", 0, 2)], SCHEMA), bronze)
    schema = spark.createDataFrame([], SCHEMA).schema
    queries = stage(stream_files(spark, bronze, schema), spec, layers, interval="1 second")
    try:
        queries[0].processAllAvailable()
        queries.append(apply_changes(spark, spec, schema, layers, interval="1 second"))
        queries[-1].processAllAvailable()
        assert rows(read_gold(spark, spec, layers)) == [(1, "B", 0, 2)]
        assert rows(read_gold(spark, spec, layers, schema)) == [(1, "B", 0, 2)]
    finally:
        for query in queries:
            query.stop()


def test_null_key_has_a_bucket_of_its_own(spark, layers):
    spec = CdcSpec("t", ["k"], "at", 1, bucket_expr="k div 100")
    assert flow(spark, layers, spec, [(None, "A", 0, 1), (1, "B", 0, 1)]) == [(None, "A", 0, 1), (1, "B", 0, 1)]


def merged(**options):
    return CdcSpec("t", ["k"], "at", **{"scd_type": 2, "buckets": 3, "merge": "table", **options})


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [2, 3, 0, 1], [3, 0, 2, 1]])
@pytest.mark.parametrize("period", ["month", "year"])
def test_merge_with_the_table_gives_the_same_history(spark, layers, order, period):
    data = dated(sorted(changes(150, 12), key=lambda r: r[3]))
    parts = [data[:50], data[50:90], data[90:], data[20:110:3]]
    spec = merged(period=period)
    seen = []
    for part in order:
        seen += parts[part]
        assert dated_flow(spark, layers, spec, parts[part]) == expected(seen)
    schema = spark.createDataFrame([], DATED).schema
    want = [r for r in expected(data) if r[5] is None]
    assert rows(read_current(spark, spec, layers, schema)) == want
    rebuild(spark, spec, schema, layers)
    assert rows(read_gold(spark, spec, layers)) == expected(data)


def test_merge_leaves_earlier_periods_alone(spark, layers):
    def files():
        names = spark.read.parquet(layers.path("gold", "t")).inputFiles()
        return {n for n in names if "__until=2024-02" in n or "__until=2024-01" in n}

    data = dated([(k, "A", 0, at) for k in range(20) for at in range(0, 30, 3)])
    dated_flow(spark, layers, merged(), data)
    before = files()
    late = dated([(k, "B", 0, 31) for k in range(5)])
    assert dated_flow(spark, layers, merged(), late) == expected(data + late)
    assert before and files() == before


@pytest.mark.parametrize("spec", [merged(), merged(scd_type=1), merged(scd_type=1, bucket_expr="k div 10")])
def test_merge_cut_short_in_the_middle(spark, layers, monkeypatch, spec):
    """Half of the partitions are written when the driver goes; the rest must not be lost."""
    import strataflow.streaming.cdc as cdc

    def want(data):
        full = expected(data)
        current = sorted((r[:4] for r in full if r[5] is None), key=lambda r: (r[0] is not None, r))
        return full if spec.scd_type == 2 else current

    data = dated(sorted(changes(120, 13), key=lambda r: r[3]))
    assert dated_flow(spark, layers, spec, data[:40]) == want(data[:40])
    real = cdc._replace

    def dies(state, spec, target, balance=False):
        real(state.where("__bucket = 0 AND NOT (u = 1)"), spec, target, balance)
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(cdc, "_replace", dies)
        with pytest.raises(Exception, match="driver lost"):
            dated_flow(spark, layers, spec, data[40:80])
    assert dated_flow(spark, layers, spec, data[80:]) == want(data)


def test_merge_with_zoned_times_and_dates(spark, layers):
    data = dated(changes(40, 14))
    for name, cut in (("timestamp", lambda t: t), ("date", lambda t: t.date())):
        spec = CdcSpec(name, ["k"], "at", 2, buckets=2, merge="table")
        schema = DATED.replace("timestamp_ntz", name)
        typed = [(k, t, u, cut(at)) for k, t, u, at in data]
        dated_flow(spark, layers, spec, typed[:20], schema)
        assert dated_flow(spark, layers, spec, typed[20:], schema) == expected(typed)


def test_merge_needs_times(spark, layers):
    with pytest.raises(Exception, match="a period needs a date or time"):
        flow(spark, layers, merged(), [(1, "A", 0, 1)])
