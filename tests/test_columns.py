from conftest import rows
from pyspark.sql import functions as F

from strataflow.functions import bucketize, drop_columns, regex_clean, upper_columns
from strataflow.functions.keys import search_steps, upper_bound
from strataflow.operators import distinct_dates, high_watermark, preview, sum_by
from strataflow.plans.music import DURATIONS, LONGEST


def test_bucket_edges_and_null(spark):
    df = spark.createDataFrame([(149,), (150,), (299,), (300,), (None,)], "d int")
    found = {r.d: r.flag for r in df.select("d", bucketize("d", DURATIONS, LONGEST).alias("flag")).collect()}
    assert found == {149: "low", 150: "medium", 299: "medium", 300: "high", None: "high"}


def test_regex_replaces_every_match(spark):
    df = spark.createDataFrame([("a-b--c",), (None,)], "name string")
    assert rows(regex_clean(df, "name")) == [(None,), ("a b  c",)]


def test_upper_and_missing_drop(spark):
    df = spark.createDataFrame([(1, "ann"), (2, None)], "id int, name string")
    assert rows(upper_columns(df, ["name"])) == [(1, "ANN"), (2, None)]
    assert drop_columns(df, ["_rescued_data", "name"]).columns == ["id"]


def test_upper_bound_counts_items_at_most_value(spark):
    for n in (0, 1, 2, 3, 7, 8, 9):
        items = list(range(0, 2 * n, 2))
        df = spark.createDataFrame([(items, v) for v in range(-1, 2 * n + 1)], "items array<int>, v int")
        found = df.select("v", upper_bound(F.col("items"), F.col("v"), search_steps(n)).alias("n")).collect()
        assert all(r.n == sum(i <= r.v for i in items) for r in found)


def test_sum_preview_and_watermark(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 5.0), (None, 1.0)], "k string, v double")
    assert rows(sum_by(df, ["k"], "v", "t", scale=2)) == [(None, 1.0), ("a", 0.3), ("b", 5.0)]
    assert rows(preview(df, 1, [F.col("v").desc()])) == [("b", 5.0)]
    assert high_watermark(df, "v").first() == (5.0, 4)
    assert high_watermark(df.where("false"), "v").first() == (None, 0)


def test_calendar(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-02-29 10:00:00', timestamp'2024-02-29 11:00:00', NULL)) AS t")
    (day,) = distinct_dates(df, "t").collect()
    assert (day.date_key, str(day.date), day.day, day.month, day.year, day.weekday) == (
        20240229, "2024-02-29", 29, 2, 2024, "Thursday",
    )
