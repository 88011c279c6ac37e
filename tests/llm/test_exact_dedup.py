import hashlib
import re
from collections import defaultdict

import pytest

from strataflow.llm.exact_dedup import exact_groups

from .conftest import found

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append(doc)
    out = []
    for digest, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("least", [2, 64])
def test_edges(edge_docs, least):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert found(exact_groups(edge_docs, least_copies=least), *COLUMNS) == brute(rows)


def test_hot_group_with_a_small_sketch(spark):
    rows = [(i, "same  text" if i % 3 else f"text {i // 6}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_groups(docs, tracked=64, most_winners=8, least_copies=10)
    assert found(got, *COLUMNS) == brute(rows)


def test_more_heavy_digests_than_winners(spark):
    rows = [(i, f"text {i % 5000}") for i in range(20_000)] + [(None, "no id"), (None, "no id"), (None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_groups(docs, most_winners=50, least_copies=2)
    assert found(got, *COLUMNS) == brute(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_empty_table(no_docs):
    got = exact_groups(no_docs)
    assert got.columns == COLUMNS and got.count() == 0


def test_no_python_on_the_path(small_docs):
    plan = exact_groups(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "BroadcastHashJoin" in plan
