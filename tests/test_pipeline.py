"""Bulk load, then an increment: history grows in the dimensions, not in the fact."""

from datetime import date, datetime

import pytest
from conftest import rows

from strataflow.plans import read_runs, run
from strataflow.plans.music import TABLES, USER, gold_tables, listens, register_gold
from strataflow.streaming import read_gold

D1, D2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMAS = {
    "DimUser": "user_id long, user_name string, country string, subscription_type string, updated_at timestamp_ntz",
    "DimArtist": "artist_id long, artist_name string, genre string, country string, updated_at timestamp_ntz",
    "DimTrack": "track_id long, track_name string, artist_id long, duration_sec int, updated_at timestamp_ntz",
    "DimDate": "date_key int, date date, day int, month int, year int, weekday string",
    "FactStream": "stream_id long, user_id long, track_id long, date_key int, listen_duration int, "
                  "device_type string, stream_timestamp timestamp_ntz",
}
BULK = {
    "DimUser": [(1, "ann", "NL", "Free", D1), (2, "bob", "DE", "Family", D1), (None, "eve", "X", "Free", D1)],
    "DimArtist": [(10, "Band", "rock", "NL", D1)],
    "DimTrack": [(46, "a-b--c", 10, 149, D1), (5, "plain", 10, 300, D1), (6, "long", 10, None, D1)],
    "DimDate": [(20240101, date(2024, 1, 1), 1, 1, 2024, "Monday")],
    "FactStream": [(100, 1, 46, 20240101, 60, "phone", D1), (101, 9, 5, 20240101, 70, "tv", D1)],
}
MORE = {
    "DimUser": [(1, "ann", "NL", "Premium", D2), (3, "cas", "BE", "Free", D2)],
    "DimArtist": [(10, "Band", "pop", "NL", D2)],
    "DimTrack": [(46, "a-b--c", 10, 150, D2)],
    "DimDate": [(20240201, date(2024, 2, 1), 1, 2, 2024, "Thursday")],
    "FactStream": [(100, 1, 46, 20240101, 65, "phone", D2), (102, 3, 46, 20240201, 10, "tv", D2)],
}


@pytest.fixture
def warehouse(spark):
    data = {name: list(found) for name, found in BULK.items()}
    return data, lambda spec: spark.createDataFrame(data[spec.table], SCHEMAS[spec.table])


def test_bulk_then_increment(spark, layers, warehouse):
    data, reader = warehouse
    run(spark, TABLES, reader, layers, quarantine=True)
    gold = gold_tables(spark, layers)
    assert rows(gold["DimUser"], "user_id", "user_name") == [(1, "ANN"), (2, "BOB")]
    assert rows(gold["DimTrack"], "track_id", "track_name", "durationflag") == [
        (5, "plain", "high"), (6, "long", "high"), (46, "a b  c", "low"),
    ]
    assert rows(spark.read.parquet(layers.path("quarantine", "DimUser")), "user_name") == [("EVE",)]
    assert rows(listens(spark, layers)) == [
        (100, 60, 1, "ANN", 46, "a b  c"), (101, 70, None, None, 5, "plain"),
    ]

    for name, found in MORE.items():
        data[name] += found
    outcomes = run(spark, TABLES, reader, layers, quarantine=True)
    assert {o.table: o.n_rows for o in outcomes} == {name: len(found) for name, found in MORE.items()}
    users = read_gold(spark, USER.cdc, layers)
    assert rows(users, "user_id", "subscription_type", "__START_AT", "__END_AT") == [
        (1, "Free", D1, D2), (1, "Premium", D2, None), (2, "Family", D1, None), (3, "Free", D2, None),
    ]
    gold = gold_tables(spark, layers)
    assert rows(gold["DimArtist"], "genre") == [("pop",)]
    tracks = gold["DimTrack"].where("track_id IN (46, 5)")
    assert rows(tracks, "track_id", "durationflag") == [(5, "high"), (46, "medium")]
    assert gold["DimDate"].count() == 2
    register_gold(spark, layers)
    assert spark.sql("SELECT * FROM gold_dimtrack").count() == 4
    closed = spark.sql("SELECT track_id, durationflag FROM gold_dimtrack WHERE `__END_AT` IS NOT NULL")
    assert rows(closed) == [(46, "low")]
    assert spark.sql("SELECT * FROM gold_dimtrack WHERE track_id IN (46, 5)").count() == 3
    assert rows(gold["FactStream"], "stream_id", "listen_duration") == [(100, 65), (101, 70), (102, 10)]

    assert {o.status for o in run(spark, TABLES, reader, layers)} == {"empty"}
    assert rows(read_gold(spark, USER.cdc, layers)) == rows(users)
    assert read_runs(spark, layers).count() == 15


def test_single_table_failure_and_new_column(spark, layers, warehouse):
    data, reader = warehouse
    outcomes = run(spark, TABLES, reader, layers, only=["DimUser"])
    assert [o.table for o in outcomes] == ["DimUser"]

    def failing(spec):
        if spec.table == "DimArtist":
            raise OSError("source down")
        return spark.createDataFrame([(7, "new", "FR", "Free", D2, "x@y")], SCHEMAS["DimUser"] + ", mail string")

    with pytest.raises(RuntimeError, match="DimArtist: OSError: source down"):
        run(spark, TABLES, failing, layers, only=["DimUser", "DimArtist"])
    assert rows(read_gold(spark, USER.cdc, layers), "user_id", "mail") == [(1, None), (2, None), (7, "x@y")]
    assert rows(read_runs(spark, layers), "table", "status") == [
        ("DimArtist", "failed"), ("DimUser", "loaded"), ("DimUser", "loaded"),
    ]


def test_a_table_that_fails_on_the_way_up_does_not_stop_the_others(spark, layers, warehouse, monkeypatch):
    import strataflow.plans.pipeline as pipeline

    real = pipeline.silver_to_gold

    def failing(spark, spec, *rest):
        if spec.table == "DimTrack":
            raise OSError("no space")
        real(spark, spec, *rest)

    _, reader = warehouse
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "silver_to_gold", failing)
        with pytest.raises(RuntimeError, match="DimTrack: OSError: no space"):
            run(spark, TABLES, reader, layers, only=["DimTrack", "DimArtist"])
    log = read_runs(spark, layers)
    assert rows(log.where("status = 'failed'"), "table", "error") == [("DimTrack", "OSError: no space")]
    assert {o.status for o in run(spark, TABLES, reader, layers, only=["DimTrack", "DimArtist"])} == {"empty"}
    gold = {s.table: read_gold(spark, s.cdc, layers).count() for s in TABLES if s.table in ("DimTrack", "DimArtist")}
    assert gold == {"DimTrack": 3, "DimArtist": 1}


def test_show_a_catalog_table(spark, capsys):
    from strataflow.__main__ import main

    spark.sql("CREATE DATABASE IF NOT EXISTS shown")
    spark.range(9).write.mode("overwrite").saveAsTable("shown.numbers")
    try:
        main(["--catalog", "spark_catalog", "--schema", "shown", "--table", "numbers", "--rows", "2"])
    finally:
        spark.catalog.setCurrentDatabase("default")
    assert "only showing top 2 rows" in capsys.readouterr().out
