import pytest
from conftest import rows

from strataflow.config import JoinSpec
from strataflow.operators import build_join


@pytest.fixture
def tables(spark):
    return {
        "fact": spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 20)], "id int, user int"),
        "user": spark.createDataFrame([(10, "a", 1), (20, "b", 2), (20, "c", 1)], "uid int, name string, c int"),
        "country": spark.createDataFrame([(1, "X")], "cid int, country string"),
    }


FACT = JoinSpec("fact", "f", "f.id")
USER = JoinSpec("user", "u", ["u.name"], "f.user = u.uid")
COUNTRY = JoinSpec("country", "c", "c.country", "u.c = c.cid")


def test_null_unmatched_and_duplicate_keys(spark, tables):
    assert rows(build_join(spark, [FACT, USER], tables)) == [(1, "a"), (2, None), (3, None), (4, "b"), (4, "c")]


def test_chain_and_parent_agree(spark, tables):
    nested = JoinSpec("country", "c", "c.country", "u.c = c.cid", parent="u")
    chain = rows(build_join(spark, [FACT, USER, COUNTRY], tables))
    assert rows(build_join(spark, [FACT, USER, nested], tables)) == chain
    assert (4, "b", None) in chain and (4, "c", "X") in chain


def test_aliases_expressions_and_catalog(spark, tables):
    tables["user"].createOrReplaceTempView("user_view")
    specs = [FACT, JoinSpec("user_view", "u", "upper(u.name) AS shouted", "f.user = u.uid")]
    assert build_join(spark, specs, {"fact": tables["fact"]}).columns == ["id", "shouted"]


def test_unused_unique_table_is_left_out(spark, tables):
    spare = JoinSpec("country", "c", (), "f.user = c.cid", unique=True)
    plan = build_join(spark, [FACT, spare], tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("specs", [
    [FACT, JoinSpec("user", "u", "u.name")],
    [USER],
    [FACT, JoinSpec("user", "u", "u.name", "f.user = u.uid", parent="absent")],
])
def test_faulty_configuration(spark, tables, specs):
    with pytest.raises(ValueError):
        build_join(spark, specs, tables)
