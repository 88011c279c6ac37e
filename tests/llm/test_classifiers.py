import zlib

import numpy as np
import pytest

from strataflow.llm import features, learn
from strataflow.llm.features import subword_gram_parts, subword_grams, word_gram_parts, word_grams
from strataflow.llm.quality import Subwords, quality
from strataflow.llm.toxicity import Ftrl, toxicity, without_toxic

from .conftest import found

SF = "/root/testdata/sf0.1"


def laid(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def per_text(pairs, count):
    bucket, owner = pairs
    return [sorted(bucket[owner == k].tolist()) for k in range(count)]


@pytest.mark.parametrize("grams", [
    lambda d, o: word_grams(d, o, 3, 2, (4,), 20),
    lambda d, o: tuple(map(np.concatenate, zip(*subword_grams(d, o, (2, 3), 20)))),
])
def test_features_don_t_depend_on_neighbours(grams):
    texts = ["One two THREE", "", "x", "été über", " a b\n", "one two three", "a a", "aaaa"]
    together = per_text(grams(*laid(texts)), len(texts))
    for k, text in enumerate(texts):
        assert per_text(grams(*laid([text])), 1)[0] == together[k]
    assert sum(map(len, together)) > 30


def test_words_ignore_case_and_marks():
    grams = per_text(word_grams(*laid(["One, two!", "one TWO"]), 2, 1, (), 20), 2)
    assert grams[0] == grams[1] and len(grams[0]) == 3


@pytest.mark.parametrize("part", [1, 2, 3, 7, 64])
def test_features_of_a_text_in_parts(monkeypatch, part):
    monkeypatch.setattr(features, "PART", part)
    chance = np.random.default_rng(part)
    texts = ["".join(chance.choice(list("aAbé9 .\n\0"), chance.integers(0, 90))) for _ in range(150)]
    for text in [*texts, "a", " ", "a" * 200, "a b " * 40, " " * 70 + "été"]:
        data, offsets = laid([text])
        whole = per_text(word_grams(data, offsets, 3, 2, (4, 5), 20), 1)[0]
        assert sorted(np.concatenate([[], *word_gram_parts(data, 3, 2, (4, 5), 20)])) == whole
        whole = per_text(map(np.concatenate, zip(*subword_grams(data, offsets, (2, 3, 4), 20))), 1)[0]
        assert sorted(np.concatenate([[], *subword_gram_parts(data, (2, 3, 4), 20)])) == whole


@pytest.mark.parametrize("model, told", [(Ftrl(), Ftrl.distinct), (Subwords(), Subwords.counted)])
def test_models_see_the_same_in_parts(monkeypatch, model, told):
    chance = np.random.default_rng(1)
    weights = chance.random(1 << model.bits) * (chance.random(1 << model.bits) < 0.5)
    texts = [" ".join(chance.choice([f"w{k}" for k in range(60)], n)) for n in (60, 300, 2000)]
    for text in [*texts, "x" * 3000]:
        laid_out = laid([text])
        whole, score = told(model, *laid_out), model.score(weights, 0.1, *laid_out)
        monkeypatch.setattr(features, "PART", 100)
        assert np.array_equal(whole, told(model, *laid_out))
        assert model.score(weights, 0.1, *laid_out) == pytest.approx(score, abs=1e-12)
        monkeypatch.undo()


def test_features_learnt_from_are_bounded(spark, monkeypatch):
    rows = [(k, list(range(k))) for k in range(1, 30)]
    lists = spark.createDataFrame(rows, "doc_id long, at array<int>")
    assert learn.bounded(lists).count() == 29
    monkeypatch.setattr(learn, "TRAIN_FEATURES", 100)
    few = [len(r["at"]) for r in learn.bounded(lists).collect()]
    assert 70 < sum(few) <= 100
    assert learn.bounded(lists.limit(0)).count() == 0


def fold(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


@pytest.mark.parametrize("operator, label, least", [(toxicity, "toxic", 0.95), (quality, "quality", 0.97)])
def test_held_out_rows(spark, operator, label, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = operator(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == fold(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    right = np.mean([r["predicted"] == r[label] for r in held])
    clean = [r for r in held if r["toxic"] == 0 and r["quality"] == 1]
    assert right >= least
    assert np.mean([r["predicted"] == r[label] for r in clean]) >= 0.99
    one = np.mean([r["score"] for r in held if r[label] == 1])
    assert one > np.mean([r["score"] for r in held if r[label] == 0]) + 0.4


@pytest.mark.parametrize("operator, column", [(toxicity, "toxic"), (quality, "quality")])
def test_edges(spark, edge_docs, no_docs, operator, column):
    labels = spark.createDataFrame(
        [(1, 0), (3, 1), (3, 0), (5, None), (None, 1), (9, 1), (11, 0), (13, 7)],
        f"doc_id long, {column} int",
    )
    got = operator(edge_docs, labels).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == fold(r["doc_id"]) for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (5, 1)]
    assert empty[0] == empty[1]
    assert operator(no_docs, labels).collect() == []
    unlabelled = operator(edge_docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in unlabelled} == {0 if operator is toxicity else 1}


def test_rows_without_toxic_keep_their_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = without_toxic(docs, labels)
    bad = {r["doc_id"] for r in toxicity(docs, labels).collect() if r["predicted"]}
    assert kept.schema == docs.schema
    want = [r for r in found(docs, *docs.columns) if r[0] not in bad]
    assert found(kept, *docs.columns) == want and bad


def test_weights_are_sparse():
    chance = np.random.default_rng(0)
    rows = [np.unique(chance.integers(0, 1 << 12, 50)) for _ in range(400)]
    labels = np.array([float(7 in r or k % 2 == 0) for k, r in enumerate(rows)])
    rows = [np.union1d(r, [9]) if y else np.setdiff1d(r, [9]) for r, y in zip(rows, labels)]
    weights, _ = Ftrl(bits=12).learn(rows, labels)
    assert (weights != 0).mean() < 0.1 and weights.argmax() == 9


def test_sgd_learns_a_bucket():
    chance = np.random.default_rng(0)
    rows, labels = [], np.arange(300) % 2
    for y in labels:
        at = np.unique(np.r_[chance.integers(0, 200, 20), 250 + y])
        rows.append((at, np.full(len(at), 1 / len(at), np.float32)))
    values, bias = Subwords(bits=8, epochs=5).learn(rows, labels)
    right = [(share @ values[at] + bias > 0) == y for (at, share), y in zip(rows, labels)]
    assert np.mean(right) > 0.95


def test_sample_takes_long_texts_and_known_ids_once(spark, monkeypatch):
    rows = [(k, f"{k} " * (30_000 if k % 2 else 3)) for k in range(1, 60)]
    learnt = [r for r in rows if not fold(r[0])]
    docs = spark.createDataFrame(rows + rows + [(4, "another text")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 5000)], "doc_id long, toxic int")
    took = lambda n: learn.sample(docs, labels, "toxic", n, "doc_id", "text").collect()
    got = took(len(learnt))
    assert sorted(r["doc_id"] for r in got) == [k for k, _ in learnt]
    assert all(r["label"] == r["doc_id"] % 2 for r in got)
    assert {r["text"] for r in got} - {"another text"} <= {t for _, t in learnt}
    monkeypatch.setattr(learn, "TRAIN_BYTES", 200_000)
    few = took(len(learnt))
    total = sum(len(r["text"]) for r in few)
    assert 100_000 < total <= 200_000 and any(len(r["text"]) > 50_000 for r in few)
