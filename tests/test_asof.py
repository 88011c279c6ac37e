import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import SkewPolicy
from strataflow.operators import join_as_of, scd2, skew
from strataflow.operators.cells import MOST_COPIES, choose_cells, in_cells

WAYS = {
    "join": dict(few=10**9),
    "join unbounded": dict(few=10**9, broadcast_rows=0),
    "split join": dict(
        few=10**9, broadcast_rows=0, policy=SkewPolicy(rows_per_task=30, check_above_bytes=0)
    ),
    "cells": dict(few=0, cells=True),
    "cells of busy keys": dict(few=20, broadcast_rows=0, cells=True),
    "scan": dict(few=0),
    "split scan": dict(few=0, policy=SkewPolicy(rows_per_task=30, check_above_bytes=0)),
}


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(11)
    changes = {(7, rnd.randrange(400)): rnd.choice("abc") for _ in range(150)}
    changes |= {(rnd.randrange(50), rnd.randrange(400)): rnd.choice("abc") for _ in range(100)}
    changes |= {(None, 5): "n", (None, 9): "m"}
    facts = [(i, 7, rnd.randrange(-20, 420)) for i in range(300)]
    facts += [(1000 + i, 7, 200) for i in range(150)]
    facts += [(2000 + i, rnd.randrange(60), rnd.randrange(400)) for i in range(200)]
    facts += [(3000, None, 7), (3001, 7, None), (3002, None, None)]
    return changes, facts


@pytest.mark.parametrize("way", WAYS)
def test_each_way_gives_the_version_valid_then(spark, data, way):
    changes, facts = data
    history = scd2(
        spark.createDataFrame([(k, at, v) for (k, at), v in changes.items()], "k int, at int, plan string"),
        ["k"], "at",
    )
    found = join_as_of(
        spark.createDataFrame(facts, "id int, k int, ts int").repartition(5),
        history, ["k"], "ts", ["plan"], **WAYS[way],
    )

    def plan(k, ts):
        if k is None or ts is None:
            return None
        past = [(at, v) for (key, at), v in changes.items() if key == k and at <= ts]
        return max(past)[1] if past else None

    assert found.columns == ["id", "k", "ts", "plan"]
    assert {tuple(r) for r in found.collect()} == {(i, k, ts, plan(k, ts)) for i, k, ts in facts}
    assert found.count() == len(facts)


@pytest.mark.parametrize("way", WAYS)
def test_start_belongs_end_does_not(spark, way):
    history = spark.createDataFrame(
        [(1, "a", 10, 20), (1, "b", 20, 30)], "k int, plan string, __START_AT int, __END_AT int"
    )
    facts = spark.createDataFrame([(1, t) for t in (9, 10, 19, 20, 29, 30)], "k int, ts int")
    assert rows(join_as_of(facts, history, ["k"], "ts", **WAYS[way])) == [
        (1, 9, None), (1, 10, "a"), (1, 19, "a"), (1, 20, "b"), (1, 29, "b"), (1, 30, None),
    ]


def test_empty_history(spark):
    history = spark.createDataFrame([], "k int, plan string, __START_AT int, __END_AT int")
    facts = spark.createDataFrame([(1, 9)], "k int, ts int")
    assert rows(join_as_of(facts, history, ["k"], "ts")) == [(1, 9, None)]


def test_column_clash_is_refused(spark):
    history = spark.createDataFrame([(1, "a", 10, 20)], "k int, plan string, __START_AT int, __END_AT int")
    with pytest.raises(ValueError, match="plan"):
        join_as_of(spark.createDataFrame([(1, 9, "x")], "k int, ts int, plan string"), history, ["k"], "ts")


@pytest.mark.parametrize("unit", ["date", "timestamp", "timestamp_ntz", "double"])
def test_cells_of_each_kind_of_time(spark, unit):
    def moment(n):
        day = f"date_add(date'2023-12-01', cast({n} as int))"
        return f"cast({n} / 3 as double)" if unit == "double" else f"cast({day} as {unit})"

    changes = spark.range(60).selectExpr("id % 2 as k", f"{moment('id * 7 % 120')} as at", "id as plan")
    facts = spark.range(200).selectExpr("id", "id % 3 as k", f"{moment('id - 20')} as ts")
    history = scd2(changes, ["k"], "at")
    ways = [join_as_of(facts, history, ["k"], "ts", ["plan"], few=few, cells=True) for few in (3, 10**9)]
    assert rows(ways[0]) == rows(ways[1])


def test_cells_are_few_and_their_rows_bounded(spark):
    # One key with a version per second of an hour, others that change once in years.
    dense = spark.range(3600).selectExpr("1 as k", "id + 1000000000 as at")
    sparse = spark.range(2000).selectExpr("id % 200 + 2 as k", "id * 1000000 as at")
    changes = dense.unionAll(sparse).withColumn("plan", F.rand(1))
    history = scd2(changes, ["k"], "at")
    begins, stops = F.col("__START_AT"), F.col("__END_AT")
    kind = history.schema["__START_AT"].dataType
    cells = choose_cells(history, ["k"], begins, stops, kind, 16)
    laid = in_cells(history, cells, begins, stops)
    assert laid.count() == cells.rows <= MOST_COPIES * history.count()
    only = history.where("k = 1")
    cells = choose_cells(only, ["k"], begins, stops, kind, 16)
    assert cells.most <= 16 and cells.rows <= 2 * 3600


def test_cells_without_versions(spark):
    history = spark.createDataFrame([], "k int, at int, plan string")
    assert choose_cells(history, ["k"], F.col("at"), F.col("at"), history.schema["at"].dataType, 8) is None


def test_a_task_sorts_no_more_of_a_key_than_fits_its_memory(spark, data):
    changes, facts = data
    history = scd2(
        spark.createDataFrame([(k, at, v) for (k, at), v in changes.items()], "k int, at int, plan string"),
        ["k"], "at",
    )
    facts = spark.createDataFrame(facts, "id int, k int, ts int")
    # 20 million rows are allowed by number, a few dozen by their bytes.
    found, whole = (
        join_as_of(facts, history, ["k"], "ts", ["plan"], few=0, policy=policy)
        for policy in (SkewPolicy(bytes_per_task=4096), SkewPolicy())
    )
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (found, whole)]
    assert ["__chunk" in plan for plan in plans] == [True, False]
    assert rows(found) == rows(whole)


def test_a_wide_row_counts_for_more():
    narrow = T.StructType([T.StructField("k", T.LongType())])
    wide = T.StructType([*narrow.fields, *[T.StructField(f"c{i}", T.StringType()) for i in range(50)]])
    cut = [skew.fitted(SkewPolicy(), kind).rows_per_task for kind in (narrow, wide)]
    assert cut[0] > 10 * cut[1] and cut[1] * skew.row_bytes(wide) <= SkewPolicy().bytes_per_task


def test_cells_need_no_order_in_time(spark, data):
    facts = data[1]
    history = spark.createDataFrame(
        [(7, n, n + 1, "x") for n in range(400)], "k int, __START_AT int, __END_AT int, plan string"
    )
    facts = spark.createDataFrame(facts, "id int, k int, ts int")
    plan = join_as_of(facts, history, ["k"], "ts", few=10, broadcast_rows=0, cells=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "__cell" in text
