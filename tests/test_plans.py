"""What the queries' plans must and must not contain."""

import pytest

from strataflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
WRITES = ("pit_join", "stream", "ingest", "backfill", "run_log", "snapshot", "medallion", "refresh", "layer")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(WRITES)])
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in text
    # The cut points of hot keys come from the driver.
    if not name.endswith("_hot"):
        assert "Scan ExistingRDD" not in text


def test_scans_read_only_what_is_asked(spark):
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan(QUERIES["filter_in"](spark, SF))
    assert "In(p_partkey, [46,5])" in plan(QUERIES["filter_in"](spark, SF)).replace("[5,46]", "[46,5]")
    assert "GreaterThan(ts,2024-01-15" in plan(QUERIES["ingest_window"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan(QUERIES["latest_change"](spark, SF))


def test_sums_and_keys_are_combined_before_the_shuffle(spark):
    for name in ("sum_by_key", "dedupe_any", "dim_date", "rule_counts"):
        text = plan(QUERIES[name](spark, SF))
        assert text.count("HashAggregate") >= 2, name


def test_history_takes_one_shuffle(spark):
    for name in ("scd1", "scd2", "scd2_tracked", "scd2_ties", "as_of"):
        text = plan(QUERIES[name](spark, SF))
        assert (text.count("Exchange hashpartitioning"), text.count("Sort [")) == (1, 1), name


def test_large_facts_are_shuffled_once_for_a_snowflake(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["star_join"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    above = text[: text.index("Exchange hashpartitioning(l_orderkey")]
    assert above.count("Join") == 1
    assert "region" not in text


def test_a_rule_turns_the_outer_join_into_an_inner_one(spark):
    assert "Inner" in plan(QUERIES["expect_drop"](spark, SF))
