import random

import numpy as np
import pytest
import xxhash

from strataflow.llm import simhash
from strataflow.llm.graph import components
from strataflow.llm.simhash import fingerprint, near, near_duplicates

from .conftest import found

COLUMNS = ["doc_id", "fingerprint", "component_id"]


def plain_fingerprint(text, shingle=4):
    data = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in data).split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    grams = grams or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(fps, bits=4):
    """Component id of each (id, fingerprint)."""
    parent = list(range(len(fps)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    values = np.array([f for _, f in fps], np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits).tolist():
            parent[root(j)] = root(i)
    least = {}
    for k, (doc, _) in enumerate(fps):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return [least.get(root(k)) for k in range(len(fps))]


def want(docs):
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    rows = [(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute(fps))]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("compared", [8192, 1])
@pytest.mark.parametrize("name", ["edge_docs", "small_docs", "no_docs"])
def test_against_all_pairs(name, compared, request):
    docs = request.getfixturevalue(name)
    assert found(near_duplicates(docs, compared=compared), *COLUMNS) == want(docs)


def test_long_text_in_blocks(monkeypatch):
    text = "One two\tthree  four five. " * 50
    whole = plain_fingerprint(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "_BLOCK", size)
        assert fingerprint(text.encode(), 4) == whole


@pytest.mark.parametrize("compared", [8192, 3])
def test_clusters(spark, monkeypatch, compared):
    """Dense clusters with chains, found the same way with and without busy keys."""
    chance = random.Random(5)
    values = []
    for _ in range(12):
        centre = chance.getrandbits(64)
        for _ in range(25):
            bits = chance.sample(range(64), chance.randint(0, 5))
            values.append(centre ^ sum(1 << b for b in bits))
    fps = [(k, v) for k, v in enumerate(values)]
    signed = [(k, k, int(np.uint64(v).view(np.int64))) for k, v in fps]
    frame = spark.createDataFrame(signed, "doc_id long, text_hash long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: frame)
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = found(near_duplicates(docs, compared=compared), "doc_id", "component_id")
    assert got == sorted((d, c) for (d, _), c in zip(fps, brute(fps)))


def test_near_groups():
    values = np.array([0, 1, 3, 7, 0xFF << 20, 0xFF << 21, 1 << 60], np.uint64)
    groups = sorted(sorted(g.tolist()) for g in near(values, 1))
    assert groups == [[0, 1, 2, 3], [0, 6]] or groups == [[0, 1, 2, 3, 6]]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    chance = random.Random(seed)
    links = [(chance.randint(-99, 99), chance.randint(-99, 99)) for _ in range(70)]
    links += [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2000, 2050)]
    got = dict(found(components(spark.createDataFrame(links, "u long, v long")), "node", "root"))
    roots = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in range(len(roots)):
        for u, v in links:
            if u != v:
                roots[u] = roots[v] = min(roots[u], roots[v])
    assert got == roots
