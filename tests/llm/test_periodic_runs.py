import hashlib
import random
import zlib

import numpy as np
import pytest

from strataflow.llm import periodic_runs as module
from strataflow.llm.periodic_runs import Words, periodic_runs, smallest, stretches, word_hashes

from .conftest import found

COLUMNS = [c.split()[0] for c in module.SCHEMA.split(", ")]


def brute_runs(words):
    """All runs, from the definition: every lag, every stretch of matches, its smallest period."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            s = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = s - q, i - s + q
            if length < max(12, 2 * q):
                continue
            run = words[start:i]
            if all(any(run[k] != run[k - p] for k in range(p, length)) for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, rearrange):
    words = (text or "").encode().split()
    n = len(words)
    if rearrange and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    return (
        doc_id, len(runs), *longest, 1000 * longest[1] // longest[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def runs_of(words):
    keys = word_hashes(b" ".join(words)).view(np.uint64)
    return smallest([tuple(r) for r in stretches(keys, np.array([0, len(words)])).tolist()])


@pytest.mark.parametrize("seed", range(60))
def test_all_runs(seed):
    chance = random.Random(seed)
    letters = [b"a", b"b", b"c", b"d"][: chance.randint(1, 4)]
    words = []
    while len(words) < chance.randint(0, 260):
        piece = chance.choices(letters, k=chance.randint(1, 40))
        words += piece * chance.choice([1, 1, 2, 3, 8])
        if chance.random() < 0.3:
            words += words[-chance.randint(1, 60) :]
    assert runs_of(words) == brute_runs(words)


def test_many_texts_at_once(monkeypatch):
    monkeypatch.setattr(module, "PAIRS", 7)
    chance, lists = random.Random(1), []
    for _ in range(40):
        lists.append(chance.choices([b"x", b"y"], k=chance.randint(0, 30)) * chance.choice([1, 2, 3]))
    keys = [word_hashes(b" ".join(w)).view(np.uint64) + np.uint64(k << 8) for k, w in enumerate(lists)]
    offsets = np.cumsum([0, *map(len, lists)])
    rows = stretches(np.concatenate(keys), offsets)
    for k, words in enumerate(lists):
        own = rows[(rows[:, 0] >= offsets[k]) & (rows[:, 0] < offsets[k + 1])] - [offsets[k], 0, 0]
        assert smallest([tuple(r) for r in own.tolist()]) == brute_runs(words), words


@pytest.mark.parametrize("words", [
    [b"na"] * 100_000,
    [b"a", b"b"] * 50_000,
    ([b"a"] * 9_000 + [b"x"]) * 3 + [b"a"] * 20_000,
])
def test_work_stays_in_proportion(words):
    """Pairs of blocks are at most some times the words, though pairs of equal words are billions."""
    steps = []
    step = module.Diagonals.step
    try:
        module.Diagonals.step = lambda self, place, lags: (steps.append(len(lags)), step(self, place, lags))
        found = runs_of(words)
    finally:
        module.Diagonals.step = step
    assert sum(steps) < 3 * len(words) * len(words).bit_length()
    assert max(r[1] for r in found) >= 20_000


def test_hashes_that_meet(monkeypatch):
    """If different words have one hash, the words themselves settle which runs there are."""
    words = b"a b c d e f g h i j k l m n o p".split() + [b"z"] * 15 + [b"u", b"v"] * 9
    monkeypatch.setattr(module, "hash", lambda w: len(w), raising=False)
    text = b" ".join(words)
    keys = word_hashes(text).view(np.uint64)
    rows = [tuple(r) for r in stretches(keys, np.array([0, len(words)])).tolist()]
    made = module.described(Words(text, None), len(words), rows)
    lines = "".join("%d,%d,%d\n" % r for r in brute_runs(words))
    assert made[0] == 2 and made[5] == hashlib.sha256(lines.encode()).hexdigest()


@pytest.mark.parametrize("name", ["edge_docs", "no_docs", "small_docs"])
@pytest.mark.parametrize("small", [False, True])
def test_rows(name, small, request, monkeypatch):
    docs = request.getfixturevalue(name)
    plain = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    plain = [r for r in plain if len((r[1] or "").split()) < 1500]
    keep = docs.sparkSession.createDataFrame(plain, "doc_id long, text string")
    if small:
        # Tasks import the module anew, so parts are made small where a text is looked at.
        monkeypatch.setattr(module, "TEXT_PART", 50)
        monkeypatch.setattr(module, "WORDS_PART", 7)
        for doc_id, text in plain[:60]:
            raw = (text or "").encode()
            own = word_hashes(raw)
            places = module.rearranged(doc_id, len(own))
            own = own if places is None else own[places]
            rows = stretches(own.view(np.uint64), np.array([0, len(own)]))
            made = module.described(Words(raw, places), len(own), [tuple(r) for r in rows.tolist()])
            assert (doc_id, *made) == brute_row(doc_id, text, True)
        return
    key = lambda row: [(v is not None, v) for v in row]
    want = sorted((brute_row(*r, True) for r in plain), key=key)
    assert found(periodic_runs(keep, rearrange=True), *COLUMNS) == want


def test_edges(edge_docs, no_docs):
    rows = {r["doc_id"]: r for r in periodic_runs(edge_docs).collect()}
    assert (rows[11]["n_runs"], rows[11]["length"], rows[11]["period"]) == (1, 6000, 2)
    assert rows[11]["collapsed_sha256"] == hashlib.sha256(b"long words").hexdigest()
    assert rows[5]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert periodic_runs(edge_docs).count() == edge_docs.count()
    assert periodic_runs(no_docs).collect() == []
