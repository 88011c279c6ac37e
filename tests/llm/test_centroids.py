import numpy as np
import pytest

from strataflow.llm import centroids
from strataflow.llm.centroids import places, subtree_sums


def forest(chance, n, shape):
    if shape == "chain":
        return np.arange(n) - 1
    if shape == "star":
        return np.minimum(np.arange(n) - 1, 0)
    if shape == "comb":
        return np.array([-1 if k == 0 else k - 1 - (k % 2 == 0 and k > 1) for k in range(n)])
    return np.array([-1 if k == 0 or chance.random() < 0.1 else chance.integers(0, k) for k in range(n)])


def brute(parent, values):
    out = values.copy()
    for k in range(len(parent) - 1, -1, -1):
        if parent[k] >= 0:
            out[parent[k]] += out[k]
    return out


@pytest.mark.parametrize("shape", ["chain", "star", "comb", "random", "random", "random"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 400])
def test_like_adding_up(shape, n):
    chance = np.random.default_rng(n)
    parent = forest(chance, n, shape)
    values = chance.integers(-50, 50, (n, 2))
    size = brute(parent, chance.integers(1, 9, (n, 1)))[:, 0]
    shuffle = chance.permutation(n)
    back = np.argsort(shuffle)
    moved = np.where(parent[shuffle] >= 0, back[parent[shuffle]], -1)
    got = subtree_sums(moved, size[shuffle], values[shuffle])
    assert (got == brute(parent, values)[shuffle]).all()
    place = places(moved, size[shuffle])
    for k in np.flatnonzero(moved >= 0):
        above = moved[k]
        assert place[above] < place[k] < place[k] + size[shuffle][k] <= place[above] + size[shuffle][above]


def test_rounds_are_few(monkeypatch):
    rounds = []
    argsort = np.argsort
    monkeypatch.setattr(centroids.np, "argsort", lambda *a, **k: rounds.append(1) or argsort(*a, **k))
    n = 1 << 16
    parent = np.arange(n) - 1
    got = subtree_sums(parent, n - np.arange(n), np.ones((n, 1), np.int64))
    assert (got[:, 0] == n - np.arange(n)).all() and len(rounds) < 22


def test_no_nodes():
    none = np.zeros(0, np.int64)
    assert subtree_sums(none, none, np.zeros((0, 2), np.int64)).shape == (0, 2)
