import random
from itertools import groupby

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflow.config import SkewPolicy
from strataflow.operators import as_of, closed_versions, current_versions, scd1, scd2

SCHEMA = "k int, t string, u int, at int"
SPLIT = SkewPolicy(rows_per_task=25, check_above_bytes=0)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def low(value):
    return (value is not None, value)


def expected(data, untracked=False):
    """The history worked out row by row."""
    out = []
    best = {}
    for k, t, u, at in data:
        if at is not None:
            best[k, at] = max(best.get((k, at), (t, u)), (t, u), key=lambda p: (low(p[0]), low(p[1])))
    changes = sorted(((k, at, *p) for (k, at), p in best.items()), key=lambda r: (low(r[0]), r[1]))
    for k, group in groupby(changes, key=lambda r: r[0]):
        versions = []
        for _, at, t, u in group:
            if untracked and versions and versions[-1][0] == t:
                versions[-1][1:3] = [u, at]
            else:
                versions.append([t, u, at, at])
        ends = [v[3] for v in versions[1:]] + [None]
        out += [(k, t, u, at, start, end) for (t, u, at, start), end in zip(versions, ends)]
    return sorted(out, key=lambda r: [low(v) for v in r])


def test_out_of_order_rows(spark):
    df = frame(spark, [(1, "A", 0, 3), (1, "B", 0, 1), (1, "C", 0, 2)])
    assert rows(scd2(df, ["k"], "at"), "t", "__START_AT", "__END_AT") == [("A", 3, None), ("B", 1, 2), ("C", 2, 3)]


def test_untracked_column_and_late_row(spark):
    data = [(1, "A", 1, 10), (1, "A", 2, 20), (1, "B", 3, 30)]
    shown = ["t", "u", "__START_AT", "__END_AT"]
    assert rows(scd2(frame(spark, data), ["k"], "at", ["u"]), *shown) == [("A", 2, 10, 30), ("B", 3, 30, None)]
    data.append((1, "B", 9, 15))
    assert rows(scd2(frame(spark, data), ["k"], "at", ["u"]), *shown) == [
        ("A", 1, 10, 15), ("A", 2, 20, 30), ("B", 3, 30, None), ("B", 9, 15, 20),
    ]


def test_all_columns_untracked_is_one_version(spark):
    df = frame(spark, [(1, "A", 1, 10), (1, "B", 2, 20)])
    assert rows(scd2(df, ["k"], "at", ["t", "u"])) == [(1, "B", 2, 20, 10, None)]


def test_ties_duplicates_and_null_sequence(spark):
    df = frame(spark, [(1, "A", 0, 1), (1, "B", 0, 1), (1, "B", 0, 1), (1, "C", 0, None), (None, "D", 1, 5)])
    assert rows(scd2(df, ["k"], "at")) == [(None, "D", 1, 5, 5, None), (1, "B", 0, 1, 1, None)]
    assert rows(scd1(df, ["k"], "at")) == [(None, "D", 1, 5), (1, "B", 0, 1)]


def test_late_old_row_does_not_change_the_latest(spark):
    assert rows(scd1(frame(spark, [(1, "A", 0, 2), (1, "B", 0, 1)]), ["k"], "at")) == [(1, "A", 0, 2)]


def test_reads_of_history(spark):
    history = scd2(frame(spark, [(1, "A", 0, 1), (1, "B", 0, 5), (2, "C", 0, 3)]), ["k"], "at")
    assert rows(current_versions(history), "t") == [("B",), ("C",)]
    assert rows(closed_versions(history), "t") == [("A",)]
    assert rows(as_of(history, "4"), "t") == [("A",), ("C",)]
    assert rows(as_of(history, "5"), "t") == [("B",), ("C",)]
    assert rows(as_of(history, "0"), "t") == []


changes = st.lists(
    st.tuples(
        st.sampled_from([1, 2, None]), st.sampled_from(["A", "B", None]),
        st.integers(0, 3), st.one_of(st.none(), st.integers(0, 12)),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=changes, untracked=st.booleans(), split=st.booleans())
def test_any_changes(spark, data, untracked, split):
    policy = SkewPolicy(rows_per_task=3, check_above_bytes=0) if split else SkewPolicy()
    columns = ["u"] if untracked else []
    history = scd2(frame(spark, data), ["k"], "at", columns, policy=policy)
    assert rows(history) == expected(data, untracked)
    assert rows(current_versions(history).select("k")) == rows(scd1(frame(spark, data), ["k"], "at").select("k"))


@pytest.mark.parametrize("untracked", [False, True])
def test_hot_keys_are_split(spark, untracked):
    rnd = random.Random(5)
    data = [(7, rnd.choice("AAAB"), rnd.randrange(3), rnd.randrange(150)) for _ in range(400)]
    data += [(7, "A", 1, 75)] * 200 + [(None, rnd.choice("AB"), 0, rnd.randrange(90)) for _ in range(100)]
    data += [(rnd.randrange(100, 160), rnd.choice("AB"), 0, rnd.randrange(20)) for _ in range(300)]
    # A stretch of a hot key without any change spans several chunks.
    data += [(8, "A" if at < 300 else "B", at % 5, at) for at in range(400)]
    df = frame(spark, data).repartition(5)
    columns = ["u"] if untracked else []
    assert rows(scd2(df, ["k"], "at", columns, policy=SPLIT)) == expected(data, untracked)


def test_split_plan_partitions_by_chunk(spark):
    df = frame(spark, [(7, "A", i, i) for i in range(200)])
    plan = scd2(df, ["k"], "at", policy=SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "__chunk" in plan


def test_one_shuffle_and_one_sort_per_history(spark):
    df = frame(spark, [(1, "A", 1, 1)])
    plan = scd2(df, ["k"], "at", ["u"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
