"""Counts per layer that are taken while writing equal those that are taken by reading."""

import time
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import DATED, changes, dated

from strataflow.config import CdcSpec, IngestSpec, TableSpec
from strataflow.plans import layer_stats, pipeline, run
from strataflow.plans.ingest import backfill
from strataflow.plans.monitor import read_stats
from strataflow.plans.tally import MOST_FILES, STORE, Tally, read_flows
from strataflow.session import children
from strataflow.streaming import read_gold

SPEC = TableSpec(IngestSpec("t", "at"), CdcSpec("t", ["k"], "at", 2, {"known": "k IS NOT NULL"}, buckets=2), dedupe="change")


def passed(spark, layers, spec, data, stats=True, schema=DATED):
    df = spark.createDataFrame(data, schema)
    run(spark, [spec], lambda _: df, layers, stats=stats)
    return df


def counted(spark, layers, spec, kind):
    """What reading the layers gives, as the log has it."""
    layers_ = {
        "bronze": spark.read.parquet(layers.path("bronze", "t")),
        "silver": spark.read.parquet(layers.path("silver", "t")),
        "gold": read_gold(spark, spec.cdc, layers),
    }
    columns = [spec.cdc.sequence_by, *spec.cdc.keys]
    found = layer_stats({n: d.select(*columns) for n, d in layers_.items()}, spec.cdc.sequence_by, spec.cdc.keys)
    # A NULL key is no key to either.
    return rows(found.select("layer", "n_rows", F.col("newest").cast("string").alias("newest")))


def newest_log(spark, layers):
    log = read_stats(spark, layers)
    last = log.groupBy("run_id").count().count()
    return log, last


@pytest.mark.parametrize("options", [{}, {"untracked": ("u",)}, {"scd_type": 1}, {"merge": "log"}])
def test_counts_while_writing(spark, layers, options):
    spec = replace(SPEC, cdc=replace(SPEC.cdc, **options))
    data = sorted(dated(changes(90, 51)), key=lambda r: r[3])
    tally = Tally(spark, spec, layers)
    kind = spark.createDataFrame([], DATED).schema["at"].dataType
    for end in (30, 70, 90, 90):
        passed(spark, layers, spec, data[:end] + data[:5])
        want = counted(spark, layers, spec, kind)
        assert rows(tally.totals(kind), "layer", "n_rows", "newest") == want
    # Late rows: a backfill lands them unseen, so the next pass counts anew.
    late = dated([(1, "B", 2, 3), (2, "A", 1, 2)])
    df = spark.createDataFrame(late, DATED)
    backfill(spark, spec.ingest, lambda _: df, layers, "2023-01-01", "2025-01-01")
    for end in (90, 90):
        passed(spark, layers, spec, data[:end])
        assert rows(tally.totals(kind), "layer", "n_rows", "newest") == counted(spark, layers, spec, kind)
    log = read_stats(spark, layers)
    assert log.groupBy("run_id").count().count() == 6
    keys = {r["layer"]: r["n_keys"] for r in tally.totals(kind).collect()}
    assert keys["gold"] == len({r[0] for r in data + late} - {None})


def test_no_layer_is_read_for_totals(spark, layers):
    passed(spark, layers, SPEC, dated(changes(40, 52)))
    tally = Tally(spark, SPEC, layers)
    found = tally.totals(spark.createDataFrame([], DATED).schema["at"].dataType)
    assert found.inputFiles() and all("/_state/tally/t/" in f for f in found.inputFiles())
    batches = rows(tally.batches(), "layer", "n_rows")
    # A row for the landing, for the micro-batch of silver rows, and for each partition of gold.
    assert [b[0] for b in batches].count("bronze") == 1 and [b[0] for b in batches].count("silver") == 1
    assert sum(n for layer, n in batches if layer == "gold") == read_gold(spark, SPEC.cdc, layers).count()


def test_a_pass_that_breaks_off_and_one_that_doesnt_count(spark, layers, monkeypatch):
    data = sorted(dated(changes(90, 53)), key=lambda r: r[3])
    kind = spark.createDataFrame([], DATED).schema["at"].dataType
    tally = Tally(spark, SPEC, layers)
    passed(spark, layers, SPEC, data[:30])
    real = pipeline.silver_to_gold

    def dies(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "silver_to_gold", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            passed(spark, layers, SPEC, data[:50])
    assert pipeline.silver_to_gold is real
    passed(spark, layers, SPEC, data[:60])
    assert rows(tally.totals(kind), "layer", "n_rows", "newest") == counted(spark, layers, SPEC, kind)
    passed(spark, layers, SPEC, data[:80], stats=False)
    passed(spark, layers, SPEC, data)
    assert rows(tally.totals(kind), "layer", "n_rows", "newest") == counted(spark, layers, SPEC, kind)


def test_many_small_files_become_one(spark, layers):
    tally = Tally(spark, SPEC, layers)
    df = spark.createDataFrame(dated(changes(8, 54)), DATED)
    kind = df.schema["at"].dataType
    for k in range(3):
        watched, seen = tally.watched(df)
        watched.write.format("noop").mode("overwrite").save()
        tally.put("bronze", f"b{k % 2}", seen)
    before = rows(tally.totals(kind))
    one = spark.read.schema(STORE).parquet(tally.store)
    one.repartition(MOST_FILES).write.mode("append").parquet(tally.store)
    for k in range(MOST_FILES):
        one.limit(1).write.mode("append").parquet(tally.store)
    tally.fold()
    assert len([n for n in children(spark, tally.store) if n.endswith(".parquet")]) == 1
    assert rows(tally.totals(kind)) == before and before[0][1] == 16


@pytest.mark.parametrize("kind", ["int", "date", "timestamp", "string"])
def test_change_values_of_other_types(spark, layers, kind):
    df = spark.createDataFrame(dated(changes(12, 55)), DATED)
    df = df.withColumn("at", F.dayofyear("at") if kind == "int" else F.col("at").cast(kind))
    tally = Tally(spark, SPEC, layers)
    watched, seen = tally.watched(df)
    watched.write.format("noop").mode("overwrite").save()
    tally.put("bronze", "b", seen)
    want = df.agg(F.max("at").cast("string")).first()[0]
    assert tally.totals(df.schema["at"].dataType).first()["newest"] == want


def test_running_flows_are_written_down(spark, layers):
    spec = replace(SPEC, cdc=replace(SPEC.cdc, once=False, scd_type=1))
    df = spark.createDataFrame(dated(changes(20, 56)), DATED)
    run(spark, [spec], lambda _: df, layers)
    flows = pipeline.start(spark, [spec], layers, interval="1 second")
    try:
        for query in flows["t"]:
            query.processAllAvailable()
    finally:
        for query in flows["t"]:
            query.stop()
    for _ in range(40):
        log = read_flows(spark, layers)
        if log.where("ended").count() == 3:
            break
        time.sleep(0.5)
    seen = dict(rows(log.where("ended IS NULL").groupBy("flow").agg(F.sum("n_rows").alias("n"))))
    # Spark counts a row once for each look at its micro-batch; a merge takes several.
    assert seen["t_silver"] == 20 and seen["t_stage"] == df.distinct().count() <= seen["t_apply"]
    assert rows(log.where("ended"), "flow", "error") == [("t_apply", None), ("t_silver", None), ("t_stage", None)]
