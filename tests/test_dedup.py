from conftest import rows

from strataflow.config import SkewPolicy
from strataflow.operators import any_per_key, latest_per_key, one_per_change
from strataflow.operators.skew import find_hot

SPLIT = SkewPolicy(rows_per_task=40, check_above_bytes=0)


def test_null_is_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], "k int, v int")
    assert len(any_per_key(df, ["k"]).collect()) == 2
    assert rows(latest_per_key(df, ["k"], "v")) == [(None, 2), (3, 1)]


def test_latest_is_independent_of_order_and_breaks_ties(spark):
    data = [(1, 5, "a", None), (1, 5, "b", 1), (1, 4, "z", 9), (2, 1, "q", 0), (2, 1, "q", 0)]
    for d in (data, data[::-1]):
        df = spark.createDataFrame(d, "k int, s int, a string, b int")
        assert rows(latest_per_key(df, ["k"], "s")) == [(1, 5, "b", 1), (2, 1, "q", 0)]


def test_map_columns_can_break_ties(spark):
    df = spark.createDataFrame([(1, 1, {"x": 1}), (1, 1, {"x": 2})], "k int, s int, m map<string,int>")
    assert latest_per_key(df, ["k"], "s").first().m == {"x": 2}


def test_change_dedupe_keeps_history_key_dedupe_does_not(spark):
    df = spark.createDataFrame(
        [(1, "Free", 1), (1, "Free", 1), (1, "Premium", 2), (3, "Free", 2)], "user_id int, plan string, at int"
    )
    assert rows(one_per_change(df, ["user_id"], "at")) == [(1, "Free", 1), (1, "Premium", 2), (3, "Free", 2)]
    assert len(any_per_key(df, ["user_id"]).collect()) == 2


def skewed(spark):
    """A third of the rows is one key, a sixth is copies of one row."""
    data = [(7, i % 90, i % 4) for i in range(300)] + [(7, 5, 3)] * 150
    data += [(100 + i % 200, i, i % 3) for i in range(500)] + [(None, i, 0) for i in range(60)]
    return spark.createDataFrame(data, "k int, s int, v int").repartition(6)


def test_hot_keys_are_found_only_above_the_size_limit(spark):
    df = skewed(spark)
    hot = find_hot(df, ["k"], SPLIT)
    from strataflow.functions import key_hash

    expected = {r[0] for r in spark.createDataFrame([(7,), (None,)], "k int").select(key_hash(["k"])).collect()}
    assert set(hot) == expected
    assert find_hot(spark.range(10), ["id"], SkewPolicy()) == []


def test_hot_keys_give_the_same_result(spark):
    df = skewed(spark)
    assert rows(latest_per_key(df, ["k"], "s", SPLIT)) == rows(latest_per_key(df, ["k"], "s"))
    assert rows(one_per_change(df, ["k"], "s", SPLIT)) == rows(one_per_change(df, ["k"], "s"))


def test_hot_rows_are_thinned_before_their_shuffle(spark):
    plan = latest_per_key(skewed(spark), ["k"], "s", SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
