"""Sums over the subtrees of a forest by centroid decomposition.

A component is cut at its centroid: the deepest node that has at least half of the component's weight at
or below it. What is below the centroid is summed and added to all nodes on the path from the centroid to
the component's top; then the parts go on, each with at most half of the weight. So the number of rounds is
the logarithm of the weight, however deep the trees are, and each round is a few passes over arrays.
"""

from __future__ import annotations

import numpy as np


def places(parent: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each node, such that those at or below it have the ``size`` numbers from its own on.

    Offsets among siblings are added up along the paths to the tops by doubling.
    """
    n = len(parent)
    order = np.argsort(parent, kind="stable")
    family, sizes = parent[order], size[order]
    before = np.cumsum(sizes) - sizes
    first = np.r_[True, family[1:] != family[:-1]]
    before -= np.maximum.accumulate(np.where(first, before, 0))
    # A node's own number comes before those of its children.
    place, jump = np.zeros(n + 1, np.int64), np.full(n + 1, n)
    place[order] = before + (family >= 0)
    jump[:n] = np.where(parent < 0, n, parent)
    while (jump != n).any():
        place, jump = place + place[jump], jump[jump]
    return place[:n]


def subtree_sums(parent: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each node the sum of ``values`` (a column each) at and below it.

    ``parent`` has -1 at tops. ``size`` is a node's weight and that of all below it: larger, by one or more,
    than the sizes of its children together.
    """
    n = len(parent)
    if not n:
        return values.copy()
    place = places(parent, size)
    out, now = values.copy(), size.copy()
    nodes = np.argsort(place)
    # Each top is the first of its component: a component's nodes are neighbours, by place.
    top = parent[nodes] < 0
    while len(nodes):
        starts = np.flatnonzero(top)
        part = np.cumsum(top) - 1
        path = 2 * now[nodes] >= now[nodes[starts]][part]
        index = np.arange(len(nodes))
        last = np.maximum.reduceat(np.where(path, index, -1), starts)
        centroid = nodes[last]
        low, high = place[centroid], place[centroid] + size[centroid]
        own = place[nodes]
        below = (own >= low[part]) & (own < high[part])
        total = np.add.reduceat(np.where(below[:, None], values[nodes], 0), starts, axis=0)
        out[centroid] += total - values[centroid]
        above = path & ~below
        out[nodes[above]] += total[part[above]]
        now[nodes[above]] -= now[centroid][part[above]]
        # What stays above keeps its top; each child of the centroid is the top of a new component.
        new = below & (parent[nodes] == centroid[part])
        label = np.where(below, np.maximum.accumulate(np.where(new, index, 0)), starts[part])
        rest = np.ones(len(nodes), bool)
        rest[last] = False
        order = np.argsort(label[rest], kind="stable")
        nodes, label = nodes[rest][order], label[rest][order]
        top = np.r_[True, label[1:] != label[:-1]] if len(nodes) else top[:0]
    return out
