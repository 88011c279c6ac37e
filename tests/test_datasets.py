"""Datasets made from others."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataflow.plans.datasets import Dataset, RefreshFailed, dependents, in_order, read_dataset, refresh, stale


def plus(n):
    return lambda *frames: frames[0].select((F.col("v") + n).alias("v"))


def both(one, other):
    return one.unionAll(other).agg(F.sum("v").alias("v"))


GRAPH = [
    Dataset("d", ["b", "c"], both),
    Dataset("b", ["a"], plus(10)),
    Dataset("c", ["a", "other"], plus(100)),
    Dataset("a", ["source"], plus(0)),
    Dataset("alone", ["other"], plus(1)),
]


def reader(spark, value):
    return lambda name: spark.createDataFrame([(value,)], "v int")


def value(spark, layers, name):
    return rows(read_dataset(spark, layers, name))[0][0]


def test_order_and_dependents():
    order = in_order(GRAPH)
    assert sorted(order) == ["a", "alone", "b", "c", "d"]
    assert order.index("a") < min(order.index("b"), order.index("c")) < order.index("d")
    assert dependents(GRAPH, ["b"]) == ["b", "d"]
    assert set(dependents(GRAPH, ["other"])) == {"c", "d", "alone"}
    with pytest.raises(ValueError, match="nobody"):
        dependents(GRAPH, ["nobody"])


def test_cycles_and_doubles_are_refused():
    with pytest.raises(ValueError, match="read each other"):
        in_order([*GRAPH[1:4], Dataset("source", ["d"], plus(0)), GRAPH[0]])
    with pytest.raises(ValueError, match="read each other"):
        in_order([Dataset("x", ["x"], plus(0))])
    with pytest.raises(ValueError, match="given twice: a"):
        in_order([*GRAPH, GRAPH[3]])


def test_a_refresh_follows_what_is_read(spark, layers):
    done = refresh(spark, GRAPH, reader(spark, 1), layers)
    assert {d.name for d in done} == {"a", "b", "c", "d", "alone"} and {d.status for d in done} == {"written"}
    assert value(spark, layers, "d") == 112 and stale(spark, GRAPH, layers) == []
    done = refresh(spark, GRAPH, reader(spark, 2), layers, only=["a"])
    assert [d.name for d in done if d.name != "alone"] == [d.name for d in done] and len(done) == 4
    assert value(spark, layers, "d") == 114 and value(spark, layers, "alone") == 2
    # Only the one: what is made from it is behind, and known to be.
    assert [d.name for d in refresh(spark, GRAPH, reader(spark, 5), layers, only=["a"], below=False)] == ["a"]
    assert value(spark, layers, "d") == 114
    assert stale(spark, GRAPH, layers) == [n for n in in_order(GRAPH) if n in "bcd"]
    refresh(spark, GRAPH, reader(spark, 9), layers, only=stale(spark, GRAPH, layers))
    assert value(spark, layers, "a") == 5 and value(spark, layers, "d") == 120


def test_what_was_never_made_is_made_first(spark, layers):
    done = refresh(spark, GRAPH, reader(spark, 1), layers, only=["b"], below=False)
    assert [d.name for d in done] == ["a", "b"]
    done = refresh(spark, GRAPH, reader(spark, 7), layers, only=["b"])
    assert [d.name for d in done] == ["b", "c", "d"] or [d.name for d in done] == ["c", "b", "d"]
    assert value(spark, layers, "d") == 112
    refresh(spark, GRAPH, reader(spark, 3), layers, only=["source"], below=False)
    assert value(spark, layers, "a") == 3 and value(spark, layers, "b") == 11


def test_a_failure_stops_what_depends_on_it_only(spark, layers):
    refresh(spark, GRAPH, reader(spark, 1), layers)

    def fails(*frames):
        raise ArithmeticError("no such luck")

    broken = [Dataset("b", ["a"], fails) if d.name == "b" else d for d in GRAPH]
    with pytest.raises(RefreshFailed, match="b: no such luck") as error:
        refresh(spark, broken, reader(spark, 4), layers)
    status = {d.name: d.status for d in error.value.outcomes}
    assert status == {"a": "written", "b": "failed", "c": "written", "d": "skipped", "alone": "written"}
    assert value(spark, layers, "d") == 112 and value(spark, layers, "c") == 104
    assert stale(spark, GRAPH, layers) == ["b", "d"]
    refresh(spark, GRAPH, reader(spark, 0), layers, only=stale(spark, GRAPH, layers))
    assert value(spark, layers, "d") == 118


def test_rules_keep_the_last_snapshot(spark, layers):
    ruled = [Dataset("a", ["source"], plus(0), {"small": "v < 10"}, keep=2), Dataset("b", ["a"], plus(10))]
    for n in (1, 2, 3):
        refresh(spark, ruled, reader(spark, n), layers)
    with pytest.raises(RefreshFailed, match="small"):
        refresh(spark, ruled, reader(spark, 30), layers)
    assert value(spark, layers, "a") == 3 and value(spark, layers, "b") == 13
    with pytest.raises(ValueError, match="keep"):
        Dataset("a", [], plus(0), keep=1)
