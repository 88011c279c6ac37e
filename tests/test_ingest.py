import os

import pytest
from conftest import rows

import strataflow.plans.ingest as ingest
from strataflow.config import IngestSpec
from strataflow.plans import backfill, ingest_table, layer_stats, read_runs, record_runs, run_all
from strataflow.session import has_data, scratch_dir

SPEC = IngestSpec("t", "ts")


def source(spark, *days):
    data = [(d, f"v{d}") for d in days]
    df = spark.createDataFrame(data, "id int, v string")
    return df.selectExpr("id", "v", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,id) AS ts")


def load(spark, layers, *days, spec=SPEC):
    return ingest_table(spark, spec, lambda _: source(spark, *days), layers)


def landed(spark, layers):
    return [r[0] for r in rows(spark.read.parquet(layers.path("bronze", "t")), "id")]


def test_bulk_then_increment_then_nothing(spark, layers):
    first = load(spark, layers, 1, 2)
    assert (first.status, first.n_rows, first.low, first.high) == ("loaded", 2, "1900-01-01", "2024-01-03 00:00:00")
    second = load(spark, layers, 1, 2, 3)
    assert (second.status, second.n_rows, second.low) == ("loaded", 1, "2024-01-03 00:00:00")
    files = len(os.listdir(layers.path("bronze", "t")))
    third = load(spark, layers, 1, 2, 3)
    assert (third.status, third.n_rows, third.high) == ("empty", 0, "2024-01-04 00:00:00")
    assert len(os.listdir(layers.path("bronze", "t"))) == files
    assert landed(spark, layers) == [1, 2, 3]


def test_empty_source_writes_nothing(spark, layers):
    assert load(spark, layers).status == "empty"
    assert not has_data(spark, layers.path("bronze", "t"))
    assert not has_data(spark, layers.state("watermark", "t"))


def test_failed_write_leaves_the_mark(spark, layers, monkeypatch):
    load(spark, layers, 1)
    real = ingest.land

    def broken(df, path):
        raise OSError("disk gone")

    monkeypatch.setattr(ingest, "land", broken)
    with pytest.raises(OSError):
        load(spark, layers, 1, 2)
    monkeypatch.setattr(ingest, "land", real)
    again = load(spark, layers, 1, 2)
    assert (again.n_rows, again.low) == (1, "2024-01-02 00:00:00")
    assert landed(spark, layers) == [1, 2]


def test_lost_mark_repeats_the_window(spark, layers, monkeypatch):
    def broken(self, spec, value, data_type):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.WatermarkStore, "put", broken)
        with pytest.raises(OSError):
            load(spark, layers, 1)
    assert load(spark, layers, 1).n_rows == 1
    assert landed(spark, layers) == [1, 1]


def test_backfill_lands_again_and_keeps_the_mark(spark, layers):
    load(spark, layers, 1, 2, 3)
    outcome = backfill(spark, SPEC, lambda _: source(spark, 1, 2, 3), layers, "2024-01-01", "2024-01-03")
    assert (outcome.status, outcome.n_rows) == ("backfilled", 2)
    assert landed(spark, layers) == [1, 1, 2, 2, 3]
    assert load(spark, layers, 1, 2, 3).status == "empty"


def test_start_date_and_overlap(spark, layers):
    spec = IngestSpec("t", "ts", from_date="2024-01-03", overlap="2 days")
    assert load(spark, layers, 1, 2, 3, spec=spec).n_rows == 1
    # The two days before the mark are looked at again, but what is there doesn't land twice.
    assert load(spark, layers, 1, 2, 3, 5, spec=spec).n_rows == 1
    assert landed(spark, layers) == [1, 2, 3, 5]


def test_a_late_row_lands_without_news(spark, layers):
    spec = IngestSpec("t", "ts", overlap="2 days")
    load(spark, layers, 1, 4, spec=spec)
    outcome = load(spark, layers, 1, 3, 4, spec=spec)
    assert (outcome.status, outcome.n_rows, outcome.n_late) == ("loaded", 0, 1)
    assert load(spark, layers, 1, 3, 4, spec=spec).status == "empty"
    load(spark, layers, 1, 3, 4, 9, spec=spec)
    assert landed(spark, layers) == [1, 3, 4, 9]


def test_backfill_of_what_is_lacking(spark, layers):
    load(spark, layers, 1, 4)
    window = ("2024-01-01", "2024-01-05")
    again = lambda: backfill(
        spark, SPEC, lambda _: source(spark, 1, 2, 4), layers, *window, only_lacking=True
    )
    assert again().status == "backfilled"
    again()
    assert landed(spark, layers) == [1, 2, 4]


def test_rows_without_a_change_value_are_counted(spark, layers):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None)], "id int, n long")
    outcome = ingest_table(spark, IngestSpec("t", "n"), lambda _: df, layers)
    assert (outcome.n_rows, outcome.n_null) == (1, 2)


def test_a_long_error_is_kept_whole():
    assert ingest.failure("r", "t", ValueError("x" * 9000)).error.endswith("x" * 9000)


def test_number_and_date_change_columns(spark, layers):
    df = spark.createDataFrame([(9,), (10,), (None,)], "n long")
    empty = ingest_table(spark, IngestSpec("none", "n"), lambda _: df.where("n IS NULL"), layers)
    assert empty.status == "empty"
    spec = IngestSpec("n", "n")
    first = ingest_table(spark, spec, lambda _: df, layers)
    assert (first.low, first.high, first.n_rows) == (None, "10", 2)
    more = df.union(spark.createDataFrame([(11,)], "n long"))
    assert ingest_table(spark, spec, lambda _: more, layers).n_rows == 1
    dates = spark.sql("SELECT date'2024-01-01' AS d")
    assert ingest_table(spark, IngestSpec("d", "d"), lambda _: dates, layers).high == "2024-01-01"


@pytest.mark.parametrize("name", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_marks_do_not_shift_with_the_session_zone(spark, layers, name, zone):
    # Both instants show as 01:30 in New York, on the night the clocks go back.
    moments = ["2024-11-03T05:30:00.000001Z", "2024-11-03T06:30:00.000001Z", "2024-11-04T00:00:00Z"]
    spec = IngestSpec("z", "ts")

    def table(n):
        df = spark.createDataFrame([(i, m) for i, m in enumerate(moments[:n])], "id int, ts string")
        return df.selectExpr("id", f"cast(replace(ts, '{'Z' if name.endswith('ntz') else '#'}', '') AS {name}) AS ts")

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for n in (1, 2, 2, 3):
            ingest_table(spark, spec, lambda _: table(n), layers)
        assert rows(spark.read.parquet(layers.path("bronze", "z")), "id") == [(0,), (1,), (2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_failure_does_not_stop_the_others(spark, layers):
    def reader(spec):
        return source(spark, 1) if spec.table == "t" else spark.read.parquet("/no/such/place")

    outcomes = run_all(spark, [IngestSpec("gone", "ts"), SPEC], reader, layers)
    assert [o.status for o in outcomes] == ["failed", "loaded"]
    record_runs(spark, outcomes, layers)
    record_runs(spark, outcomes, layers)
    log = read_runs(spark, layers)
    assert log.count() == 4
    assert "PATH_NOT_FOUND" in log.where("status = 'failed'").first().error


def test_layer_stats(spark):
    df = source(spark, 1, 2, 2)
    stats = layer_stats({"bronze": df, "none": df.where("false")}, "ts", ["id", "v"], now="2024-01-04 00:00:00")
    found = {r.layer: r for r in stats.collect()}
    assert (found["bronze"].n_rows, found["bronze"].n_keys, found["bronze"].age_seconds) == (3, 2, 86400)
    assert (found["none"].n_rows, found["none"].newest) == (0, None)
    assert layer_stats({"a": df}, "ts", "id", approximate=True).first().n_keys == 2


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second
