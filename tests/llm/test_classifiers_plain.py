"""Both text models against versions that go feature by feature, in plain Python."""

import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from strataflow.llm.quality import quality
from strataflow.llm.toxicity import toxicity

ALL = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & ALL
    return x ^ x >> 31


@lru_cache(None)
def hashed(span, more=0):
    total, power = more, 1
    for byte in span:
        total, power = total + (byte + 1) * power & ALL, power * BASE & ALL
    return mix(total)


def plain_toxic_features(text):
    words = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())
    own = [hashed(w) for w in words]
    out = set(own)
    for stem in (4, 5):
        out |= {mix(hashed(w[:stem]) + stem & ALL) for w in words}
    out |= {mix(a * BASE + b & ALL) for a, b in zip(own, own[1:])}
    out |= {mix((a + 2) * INVERSE + b & ALL) for a, b in zip(own, own[2:])}
    return sorted({x >> 44 for x in out})


def plain_quality_features(text):
    raw = (text or "").encode()
    own = [hashed(w) for w in re.findall(rb"[^\x20\x09-\x0d]+", raw)]
    out = Counter(own)
    out.update(BASE if a == b else mix(a * BASE + b & ALL) for a, b in zip(own, own[1:]))
    for n in (2, 3, 4):
        for span, count in Counter(raw[k : k + n] for k in range(len(raw) - n + 1)).items():
            out[hashed(span, n)] += count
    buckets = Counter()
    for x, count in out.items():
        buckets[x >> 46] += count
    return sorted(buckets.items())


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35, min(35, x))))


def plain_toxicity(rows, texts):
    """FTRL-proximal, a coordinate at a time; scores of ``texts``."""
    z, n, seen = Counter(), Counter(), 0.0
    positive = sum(y for _, y in rows)
    bias = math.log((positive + 1) / (len(rows) - positive + 10))

    def weight(at):
        if abs(z[at]) <= 4:
            return 0.0
        return (math.copysign(4, z[at]) - z[at]) / ((1 + math.sqrt(n[at])) / 0.5 + 0.5)

    order, found = np.random.default_rng(0), [plain_toxic_features(t) for t, _ in rows]
    for _ in range(6):
        for k in order.permutation(len(rows)):
            own = {at: weight(at) for at in found[k]}
            g = sigmoid(sum(own.values()) + bias) - rows[k][1]
            for at, w in own.items():
                z[at] += g - (math.sqrt(n[at] + g * g) - math.sqrt(n[at])) / 0.5 * w
                n[at] += g * g
            seen += g * g
            bias -= 0.5 / (1 + math.sqrt(seen)) * g
    return [sigmoid(sum(map(weight, plain_toxic_features(t))) + bias) for t in texts]


def plain_quality(rows, texts):
    """Gradient descent over mean vectors of eight numbers with a softmax of two; scores of ``texts``."""
    chance = np.random.default_rng(0)
    first = (chance.random((1 << 18, 8), np.float32) - 0.5) / 8
    vectors, output, bias = {}, [[0.0] * 8, [0.0] * 8], [0.0, 0.0]
    vector = lambda at: vectors.setdefault(at, [float(x) for x in first[at]])
    found, step = [plain_quality_features(t) for t, _ in rows], 0

    def mean_of(own):
        total, mean = max(1, sum(c for _, c in own)), [0.0] * 8
        for at, count in own:
            for d, x in enumerate(vector(at)):
                mean[d] += count / total * x
        return mean, total

    def chances(mean):
        logits = [sum(o * m for o, m in zip(output[c], mean)) + bias[c] for c in (0, 1)]
        powers = [math.exp(x - max(logits)) for x in logits]
        return [p / sum(powers) for p in powers]

    for _ in range(3):
        for k in chance.permutation(len(rows)):
            rate = 10 * (1 - step / (3 * len(rows)))
            step += 1
            mean, total = mean_of(found[k])
            error = [p - (c == rows[k][1]) for c, p in enumerate(chances(mean))]
            back = [error[0] * output[0][d] + error[1] * output[1][d] for d in range(8)]
            for c in (0, 1):
                bias[c] -= rate * 0.01 * error[c]
                for d in range(8):
                    output[c][d] -= rate * 0.1 * error[c] * mean[d]
            for at, count in found[k]:
                for d in range(8):
                    vector(at)[d] -= rate * count / total * back[d]
    return [chances(mean_of(plain_quality_features(t))[0])[1] for t in texts]


@pytest.mark.parametrize(
    "operator, column, plain, off",
    [(toxicity, "toxic", plain_toxicity, 1e-6), (quality, "quality", plain_quality, 1e-4)],
)
def test_like_the_plain_version(spark, operator, column, plain, off):
    chance = np.random.default_rng(5)
    words = [*(f"w{k}" for k in range(30)), "Über", "a-b", "LONGer", "x" * 40]
    rows = [(k, " ".join(chance.choice(words[k % 2 * 17 :][:17], 5 + k % 13))) for k in range(48)]
    # One text is longer than what is looked at at a time, with a word that crosses it.
    rows += [(90, None), (91, ""), (92, "w3 w20 " * 100_000 + "ab" * 400_000 + " w3" * 9), (93, "!")]
    labels = [(k, k % 2) for k in range(48)]
    fold = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    learnt = [(t, k % 2) for k, t in rows if k < 48 and k not in fold]
    want = dict(zip([k for k, _ in rows], plain(learnt, [t for _, t in rows])))
    got = operator(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, f"doc_id long, {column} int"),
    ).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    for row in got:
        assert row["score"] == pytest.approx(want[row["doc_id"]], abs=off), row["doc_id"]
        assert row["held_out"] == (row["doc_id"] in fold)
    assert max(want.values()) - min(want.values()) > 0.05
