import pytest
from conftest import rows

from strataflow.config import IngestSpec
from strataflow.plans.ingest import land
from strataflow.sources import (
    SchemaConflict, read_layer, read_since, read_table, resolve_schema, stream_files, stream_table,
)
from strataflow.sources.schema import widen
from strataflow.streaming import append_stream


def test_resolved_schema_widens_and_is_kept(spark, layers):
    bronze, store = layers.path("bronze", "t"), layers.state("schema", "t")
    land(spark.createDataFrame([(1, "a")], "id long, name string"), bronze)
    first = resolve_schema(spark, bronze, store)
    assert first.names == ["id", "name"]
    land(spark.createDataFrame([(2, "b", "X")], "id long, name string, country string"), bronze)
    assert resolve_schema(spark, bronze, store, evolve=False) == first
    widened = resolve_schema(spark, bronze, store)
    assert widened.names == ["id", "name", "country"]
    assert resolve_schema(spark, bronze, store) == widened
    assert rows(read_layer(spark, bronze, widened)) == [(1, "a", None), (2, "b", "X")]
    assert rows(read_layer(spark, bronze, evolved=True)) == [(1, "a", None), (2, "b", "X")]


def test_a_column_missing_from_new_files_stays(spark, layers):
    bronze, store = layers.path("bronze", "t"), layers.state("schema", "t")
    land(spark.createDataFrame([(1, "a")], "id long, name string"), bronze)
    resolve_schema(spark, bronze, store)
    land(spark.createDataFrame([(2,)], "id long"), bronze)
    assert resolve_schema(spark, bronze, store).names == ["id", "name"]


@pytest.mark.parametrize("other", ["int", "string"])
def test_type_conflict_is_refused(spark, layers, other):
    bronze, store = layers.path("bronze", "t"), layers.state("schema", "t")
    land(spark.createDataFrame([(1,)], "id long"), bronze)
    resolve_schema(spark, bronze, store)
    land(spark.createDataFrame([(2,)], "id long").selectExpr(f"cast(id as {other}) id"), bronze)
    with pytest.raises(SchemaConflict):
        resolve_schema(spark, bronze, store)


def test_widen_goes_into_structs_arrays_and_maps(spark):
    schema = lambda text: spark.createDataFrame([], text).schema
    known = schema("n int, f float, d decimal(5,2), s struct<a:smallint>, l array<struct<x:int>>, m map<string,int>")
    other = schema(
        "m map<string,bigint>, l array<struct<x:bigint,y:string>>, s struct<b:date,a:int>, "
        "d decimal(8,3), f double, n bigint, more string"
    )
    want = schema(
        "n bigint, f double, d decimal(8,3), s struct<a:int,b:date>, l array<struct<x:bigint,y:string>>, "
        "m map<string,bigint>, more string"
    )
    assert widen(known, other, True) == want and widen(want, want, True) == want
    for narrow in ("s struct<a:tinyint>", "l array<struct<x:string>>", "d decimal(7,4)", "n float", "f float"):
        with pytest.raises(SchemaConflict):
            widen(want, schema(narrow), True)


def test_wider_files_are_read_with_older_ones(spark, layers):
    bronze, store = layers.path("bronze", "t"), layers.state("schema", "t")
    for k, kind in enumerate(("int", "int", "bigint", "bigint")):
        land(spark.range(k, k + 1).selectExpr(f"cast(id as {kind}) id", f"array(struct(cast(id as {kind}) x)) l"), bronze)
        if k != 2:  # the first look after the change sees both types
            schema = resolve_schema(spark, bronze, store, deep=True)
    assert schema.simpleString() == "struct<id:bigint,l:array<struct<x:bigint>>>"
    assert rows(read_layer(spark, bronze, schema).selectExpr("id", "l[0].x")) == [(k, k) for k in range(4)]
    assert rows(read_layer(spark, bronze, schema).where("id >= 1").select("id")) == [(1,), (2,), (3,)]
    land(spark.range(1).selectExpr("cast(id as int) id"), bronze)
    with pytest.raises(SchemaConflict):
        resolve_schema(spark, bronze, store, deep=True)


def test_widen_refuses_another_type(spark):
    schema = lambda text: spark.createDataFrame([], text).schema
    with pytest.raises(SchemaConflict):
        widen(schema("a int"), schema("a long"))
    assert widen(schema("a int"), schema("b int, a int")).names == ["a", "b"]


def test_window_bounds_and_overlap(spark):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_interval(0,0,0,cast(id as int)) AS ts FROM range(6)")

    def ids(**bounds):
        return [r[0] for r in rows(read_since(lambda: df, "ts", **bounds), "id")]

    assert ids() == [0, 1, 2, 3, 4, 5]
    assert ids(low="2024-01-03") == [3, 4, 5]
    assert ids(low="2024-01-03", high="2024-01-05") == [3, 4]
    assert ids(low="2024-01-03", overlap="1 day") == [1, 2, 3, 4, 5]


def test_window_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT id, timestamp_ntz'2024-01-01' AS ts FROM range(6)").write.parquet(str(tmp_path / "t"))
    df = read_since(lambda: spark.read.parquet(str(tmp_path / "t")), "ts", "2023-01-01", "2025-01-01")
    assert "GreaterThan(ts,2023-01-01" in df._jdf.queryExecution().executedPlan().toString()


def test_stream_reads_each_file_once_and_schema_may_widen(spark, layers):
    bronze, silver = layers.path("bronze", "t"), layers.path("silver", "t")
    land(spark.createDataFrame([(1,)], "id long").coalesce(1), bronze)
    schema = spark.read.parquet(bronze).schema
    append_stream(stream_files(spark, bronze, schema), layers.checkpoint("t"), silver)
    append_stream(stream_files(spark, bronze, schema), layers.checkpoint("t"), silver)
    assert rows(read_layer(spark, silver)) == [(1,)]
    land(spark.createDataFrame([(2, "X")], "id long, c string").coalesce(1), bronze)
    wide = resolve_schema(spark, bronze, layers.state("schema", "t"))
    query = append_stream(stream_files(spark, bronze, wide), layers.checkpoint("t"), silver)
    assert rows(read_layer(spark, silver, wide)) == [(1, None), (2, "X")]
    assert query.recentProgress[-1]["numInputRows"] == 1


@pytest.mark.parametrize("limit", [{"files_per_batch": 1}, {"bytes_per_batch": 1}])
def test_backlog_is_cut_into_batches(spark, layers, limit):
    bronze = layers.path("bronze", "t")
    spark.range(8).repartition(4).write.parquet(bronze)
    stream = stream_files(spark, bronze, spark.range(1).schema, **limit)
    query = append_stream(stream, layers.checkpoint("t"), layers.path("silver", "t"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert read_layer(spark, layers.path("silver", "t")).count() == 8


def test_catalog_tables(spark, layers):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_test")
    layers = type(layers)(layers.base, "spark_catalog", "silver_test")
    land(spark.range(3), layers.path("bronze", "t"))
    stream = stream_files(spark, layers.path("bronze", "t"), spark.range(1).schema)
    try:
        layers.use(spark)
        append_stream(stream, layers.checkpoint("t"), layers.path("silver", "t"), table="numbers")
        assert read_table(spark, "spark_catalog.silver_test.numbers").count() == 3
        append_stream(
            stream_table(spark, "silver_test.numbers"), layers.checkpoint("t2"), layers.path("silver", "t2")
        )
        assert read_layer(spark, layers.path("silver", "t2")).count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_default_schema_of_an_entry():
    assert IngestSpec("DimUser", "updated_at").schema == "dbo"
