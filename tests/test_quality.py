import pytest
from conftest import rows

from strataflow.operators import classify, expect_all_or_drop, expect_all_or_fail, split

RULES = {"rule_1": "user_id IS NOT NULL", "rule_2": "x > 0"}


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, 1), (None, 1), (2, None), (None, -1)], "user_id int, x int")


def test_drop_keeps_only_true(df):
    assert rows(expect_all_or_drop(df, RULES)) == [(1, 1)]
    assert expect_all_or_drop(df, {}).count() == 4


def test_split_names_the_failed_rules(df):
    valid, rejected = split(df, RULES)
    assert rows(valid) == [(1, 1)]
    assert rows(rejected) == [
        (None, -1, ["rule_1", "rule_2"]), (None, 1, ["rule_1"]), (2, None, ["rule_2"]),
    ]
    assert classify(df, {}).where("size(failed_rules) > 0").count() == 0


def test_fail_stops_the_job_and_writes_nothing(df, tmp_path):
    with pytest.raises(Exception, match="rule rule_1 is broken"):
        expect_all_or_fail(df, {"rule_1": RULES["rule_1"]}).write.parquet(str(tmp_path / "out"))
    assert not (tmp_path / "out" / "_SUCCESS").exists()
    assert expect_all_or_fail(df.where("x > 0 AND user_id IS NOT NULL"), RULES).count() == 1


def test_rules_reach_the_scan(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "t"))
    read = expect_all_or_drop(spark.read.parquet(str(tmp_path / "t")), RULES)
    assert "GreaterThan(x,0)" in read._jdf.queryExecution().executedPlan().toString()
