import numpy as np
import pytest

from strataflow.llm import ann
from strataflow.llm.ann import Tree, cells, nearest


def brute(rows, k, every):
    """Exact neighbours of each query; rows are (id, vector)."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % every == 0:
            scores = (vectors * np.array(v, np.float64)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def got(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def share(found, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in found.get(q, [])}) for q in want)
    return hits / max(1, sum(map(len, want.values())))


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found, info = nearest(table)
    want = brute(rows, 20, 20)
    assert share(got(found), want) >= 0.9 and info["visits"] <= info["leaves"]
    exact = dict((q, dict(v)) for q, v in brute(rows, len(rows), 20).items())
    for q, own in got(found).items():
        assert len(own) == 20
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert all(abs(exact[q][i] - s) < 1e-12 for i, s in own)


def test_every_leaf_is_exact(spark, monkeypatch):
    """All leaves visited: the same rows as brute force, ties and split cells included."""
    monkeypatch.setattr(ann, "cells", lambda held, most: cells(held, 16))
    monkeypatch.setattr(ann, "CELL_QUERIES", 3)
    monkeypatch.setattr(ann, "LEAF_ROWS", 20)
    chance = np.random.default_rng(3)
    rows = [(k, chance.integers(-3, 4, 5).astype(float).tolist()) for k in range(300)]
    rows = [(k, v if k % 3 else [1.0, 2.0, 0.0, 0.0, 0.5]) for k, v in rows if any(v)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found, _ = nearest(table, k=7, query_every=10, recall=1.0)
    want = brute(rows, 7, 10)
    assert got(found).keys() == want.keys() and share(got(found), want) > 0.9
    monkeypatch.setattr(Tree, "visits", lambda tree, query, count: list(range(len(tree.leaf))))
    found, _ = nearest(table, k=7, query_every=10, recall=1.0)
    assert got(found) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [-1.0, 0.0]), (None, [1.0, 1.0]),
        (20, [0.0, 0.0]), (40, [1.0, 0.0]), (60, []),
    ]
    frame = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows],
        "vec_id long, embedding array<double>, leaf int, vector string",
    )
    want = {0: [(40, 1.0), (1, 0.5), (8, -1.0)], 40: [(0, 1.0), (1, 0.5), (8, -1.0)]}
    assert got(nearest(frame)[0]) == want


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert nearest(frame)[0].collect() == []


def test_outliers_get_all_their_rows(spark, monkeypatch):
    """Groups of copies make the calibrated visits few; a small outlying leaf has too few rows."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 20)
    # The outliers would widen the visits of all, if they counted.
    monkeypatch.setattr(ann, "POOR", 0.2)
    centres = np.eye(12) * 10
    rows = [(k, centres[k // 20 % 12].tolist()) for k in range(1, 2400)]
    rows += [
        (20_000 + 1000 * k + j, (-(20 + j / 10) * centres[k]).tolist()) for k in range(3) for j in range(8)
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found, info = nearest(table, k=20, query_every=20, recall=0.95)
    queries = [i for i, _ in rows if i % 20 == 0]
    assert info["visits"] < info["leaves"] / 4
    assert {q: len(own) for q, own in got(found).items()} == dict.fromkeys(queries, 20)


def test_visits_go_on_until_enough():
    tree = Tree(np.array([[0.0], [3.0], [2.0], [1.0]]), {0: np.array([1, 2, 3])}, {1: 0, 2: 1, 3: 2})
    counted = np.array([1, 0, 5])
    reach = lambda count, least: tree.reach(np.ones(1), count, counted, least)
    assert reach(1, 1) == [0] and reach(1, 2) == [0, 1, 2] and reach(1, 99) == [0, 1, 2]
    assert reach(2, 1) == [0, 1]


def test_cells():
    cell, parts = cells(np.array([3, 4, 2, 30, 0, 1]), 8)
    assert cell.tolist() == [0, 0, 1, 2, 3, 3] and parts.tolist() == [1, 1, 1, 4, 1, 1]


def clustered(count, seed):
    """Groups of very different sizes and widths around centres of different lengths."""
    chance = np.random.default_rng(seed)
    centres = chance.normal(0, 1, (60, 16)) * chance.uniform(0.3, 3, (60, 1))
    group = np.minimum(chance.geometric(0.06, count) - 1, 59)
    rows = centres[group] + chance.normal(0, 0.15, (count, 16)) * chance.uniform(0.1, 2, (60, 1))[group]
    return [(k, v.tolist()) for k, v in enumerate(rows)]


def test_recall_of_each_query(spark):
    """What is reported holds for all queries; none of them goes without."""
    rows = clustered(6_400, 11)
    found, info = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    want, own = brute(rows, 20, 20), got(found)
    each = [len({i for i, _ in want[q]} & {i for i, _ in own[q]}) / 20 for q in want]
    assert np.mean(each) >= 0.95 and abs(np.mean(each) - info["recall"]) < 0.05
    assert min(each) > 0 and np.mean(np.array(each) < 0.5) <= 0.02


def test_exact_where_the_tree_saves_nothing(spark):
    chance = np.random.default_rng(12)
    rows = [(k, chance.normal(0, 1, 24).tolist()) for k in range(3_000)]
    found, info = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    assert info == {"leaves": info["leaves"], "visits": info["leaves"], "recall": 1.0, "poor": 0.0}
    want, own = brute(rows, 20, 20), got(found)
    assert {q: [i for i, _ in v] for q, v in own.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_visits_are_settled_for_each_query():
    # Nine neighbours in ten are in the first leaf, but one query of two needs 30 visits for any.
    needed = {q: [1] * 20 for q in range(0, 190)} | {q: [30] * 20 for q in range(190, 200)}
    visits, recall, poor = ann.settled(needed, 100, 0.9)
    assert (visits, recall, poor) == (30, 1.0, 0.0)
    assert ann.settled(needed, 50, 0.9) == (50, 1.0, 0.0)
    # Measured on others than those that settle the visits.
    needed = {q: [1] * 20 if q % 2 == 0 else [1] * 15 + [9] * 5 for q in range(200)}
    assert ann.settled(needed, 100, 0.97) == (1, 0.75, 0.0)


def test_scores_of_visited_leaves_only(spark, monkeypatch):
    """With few visits, what is found has its exact score, and nothing is found elsewhere."""
    monkeypatch.setattr(ann, "POOR", 0.7)
    rows = clustered(4_000, 13)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    monkeypatch.setattr(ann, "LEAF_ROWS", 40)
    exact = brute(rows, 20, 20)
    found, info = nearest(table, recall=0.3)
    assert info["visits"] <= info["leaves"] / 2 and info["recall"] < 0.9
    scores = {q: dict(v) for q, v in brute(rows, len(rows), 20).items()}
    own = got(found)
    assert own.keys() == exact.keys()
    assert all(abs(scores[q][i] - s) < 1e-9 for q, v in own.items() for i, s in v)
