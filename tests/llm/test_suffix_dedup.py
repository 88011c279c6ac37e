import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import suffix_dedup
from strataflow.llm.suffix_dedup import (
    COVER, PERIOD, cover_ranks, merged, named_runs, remove_repeats, repeated_windows, runs_of,
    sliding_least, words_at,
)

from .conftest import found

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows, length):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda row: [(v is not None, v) for v in row])


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_difference_cover():
    shifts = {(a - b) % PERIOD for a in COVER for b in COVER}
    assert shifts == set(range(PERIOD))


@pytest.mark.parametrize("width", [1, 2, 7, 50])
def test_sliding_least(width):
    values = np.random.default_rng(width).integers(0, 1 << 63, 333).astype(np.uint64)
    want = [values[k : k + width].min() for k in range(333 - width + 1)]
    assert sliding_least(values, width).tolist() == want


@pytest.mark.parametrize("periods", [1, 2, 3, 5, 6])
def test_cover_ranks(periods):
    chance = np.random.default_rng(periods)
    data = np.tile(chance.integers(97, 99, 150), 8).astype(np.uint8)
    data[chance.integers(0, len(data), 6)] = 100
    ranks, size = cover_ranks(data, words_at(data), periods), periods * PERIOD
    at = [k for k in range(len(data) - size) if k % PERIOD in COVER]
    raw = data.tobytes()
    texts = [raw[k : k + size] for k in at]
    order = {t: n for n, t in enumerate(sorted(set(texts)))}
    own = [ranks[k] for k in at]
    assert np.argsort(own, kind="stable").tolist() == np.argsort(
        [order[t] for t in texts], kind="stable"
    ).tolist()
    assert len(set(own)) == len(order)


@pytest.mark.parametrize("length", [94, 100, 200])
def test_repeated_windows(length):
    chance = random.Random(length)
    base = bytes(chance.choices(b"ab", k=400))
    data = b""
    for _ in range(12):
        piece = bytearray(base[chance.randint(0, 60) :])
        if chance.random() < 0.5:
            piece[chance.randrange(len(piece))] = 99
        data += bytes(piece)
    at = np.array([k for k in range(len(data) - length)])
    group = at % 3
    got = repeated_windows(np.frombuffer(data, np.uint8), at, group, length)
    seen = Counter((k % 3, data[k : k + length]) for k in at.tolist())
    assert got.tolist() == [seen[k % 3, data[k : k + length]] > 1 for k in at.tolist()]


def test_runs_name_all_windows(monkeypatch):
    chance = random.Random(1)
    texts = [bytes(chance.choices(b"abc", k=n)) for n in (0, 99, 100, 101, 900)] + [b"x" * 500]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    runs = named_runs(data, offsets, 100)
    windows = [(t, k) for t, lo, hi in zip(runs["text"], runs["lo"], runs["hi"]) for k in range(lo, hi + 1)]
    assert windows == [(t, k) for t, text in enumerate(texts) for k in range(len(text) - 99)]
    monkeypatch.setattr(suffix_dedup, "PART", 150)
    parts = runs_of(texts, 100)
    again = [(t, k) for t, lo, hi in zip(parts["text"], parts["lo"], parts["hi"]) for k in range(lo, hi + 1)]
    assert again == windows
    name = dict(zip(windows, np.repeat(runs["name"], runs["hi"] - runs["lo"] + 1).tolist()))
    assert name == dict(zip(again, np.repeat(parts["name"], parts["hi"] - parts["lo"] + 1).tolist()))


def test_merged():
    lo, hi = merged(np.array([5, 0, 6, 20, 9]), np.array([7, 2, 6, 22, 10]))
    assert list(zip(lo.tolist(), hi.tolist())) == [(0, 2), (5, 7), (9, 10), (20, 22)]
    assert [x.tolist() for x in merged(np.zeros(0, int), np.zeros(0, int))] == [[], []]


def passages(spark, seed):
    """Few letters, shared passages, edited copies, periodic stretches, exact copies."""
    chance = random.Random(seed)
    shared = ["".join(chance.choices("ab é", k=chance.randint(80, 400))) for _ in range(4)]
    texts = []
    for _ in range(60):
        text = ""
        for _ in range(chance.randint(0, 3)):
            text += "".join(chance.choices("abcdefgh", k=chance.randint(0, 150)))
            piece = chance.choice(shared)
            cut = chance.randint(0, len(piece))
            text += chance.choice([piece, piece[:cut] + "#" + piece[cut:], "xy" * 90, ""])
        texts.append(text)
    texts += chance.choices(texts, k=15)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("bucket, block, tracked", [
    (65_536, 400_000, 65_536), (65_536, 50, 65_536), (1, 400_000, 65_536), (6, 400, 64),
])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, bucket, block, tracked):
    docs = passages(spark, seed)
    got = remove_repeats(docs, 100, bucket=bucket, block=block, tracked=tracked)
    assert found(got, *COLUMNS) == brute(rows(docs), 100)


@pytest.mark.parametrize("name", ["edge_docs", "no_docs"])
def test_edges(name, request):
    docs = request.getfixturevalue(name)
    assert found(remove_repeats(docs), *COLUMNS) == brute(rows(docs), 200)


def test_table(small_docs):
    docs = small_docs.limit(150)
    got = remove_repeats(docs, keep=["doc_id", "lang"], with_text=True)
    want = brute(rows(docs), 200)
    whole = {r[0]: r[4] for r in want}
    assert "lang" in got.columns
    for r in got.collect():
        if r["kept"].isascii():
            assert hashlib.sha256(r["kept"].encode()).hexdigest() == whole[r["doc_id"]]
    assert found(got, *COLUMNS) == want and sum(r[2] for r in want) > 0
