"""Main text of web pages: a tree-structured graphical model over each page's elements.

Every node of a page (block element or run of text) is content or not. A node's own potential is
linear in features of its tag, names, words and links; each edge has a potential over the labels of parent and
child, by the kind of child. Sum-product messages go up from the leaves and down from the root, for all pages
of a batch together, level by level, and give every node's marginal. The same marginals give the gradient
that the potentials are learned by.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import saved, ship, slices
from strataflow.llm.html_layouts import labelled_pages
from strataflow.llm.html_tree import HEADINGS, TEXT, Tree, parse

DIM = 1 << 14
#: Bytes of HTML whose trees are in memory together.
SLICE = 2 << 20
SCHEMA = "page_id long, url string, text string, n_chars long"

# Landmark elements of HTML.
ARTICLE = {"article", "main"}
ASIDE = {"nav", "aside", "footer", "header", "form"}
GROUPS = [
    {TEXT}, HEADINGS, {"p"}, {"li", "dt", "dd"}, {"ul", "ol", "dl", "table", "tr", "td", "tbody"}, ASIDE, ARTICLE,
    {"blockquote", "pre", "figure", "figcaption"},
]
KIND = {tag: number for number, tags in enumerate(GROUPS) for tag in tags}
#: Any other element, without and with names.
KINDS = len(GROUPS) + 2


@lru_cache(1 << 16)
def _at(name: str) -> int:
    return zlib.crc32(name.encode()) % DIM


class Forest(NamedTuple):
    """The trees of some pages one after another; parents of roots are -1."""

    parent: np.ndarray
    kind: np.ndarray
    row: np.ndarray
    feature: np.ndarray
    levels: list[np.ndarray]


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth, the roots first."""
    depth = np.zeros(len(parent), np.int64)
    for node, above in enumerate(parent.tolist()):
        if above >= 0:
            depth[node] = depth[above] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(parent) else []


def _size(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= step for step in steps)


COUNTS = (1, 2, 4, 7, 12, 20, 40, 80, 200)
SHARES = (0.05, 0.3, 0.6, 0.9)


def features(tree: Tree) -> Iterator[tuple[int, str]]:
    """(node, feature) pairs: of a leaf its words, links and place, of an element what is in it."""
    n = len(tree.tag)
    # words, leaves, characters, linked characters and sentence ends below each node.
    sums = np.zeros((n, 5))
    for node in range(n):
        text = tree.text[node]
        if text:
            stops = text.count(".") + text.count("!") + text.count("?") + text.count("。")
            sums[node] = text.count(" ") + 1, 1, len(text), tree.linked[node], stops
    total = sums.copy()
    for node in range(n - 1, 0, -1):
        total[tree.parent[node]] += total[node]
    leaves = max(total[0, 1], 1)
    before = np.cumsum(sums[:, 1])
    # The nearest landmark around each node.
    under = [""] * n
    for node in range(1, n):
        above = tree.parent[node]
        under[node] = tree.tag[above] if tree.tag[above] in ARTICLE | ASIDE else under[above]
    for node, (words, many, chars, linked, stops) in enumerate(total.tolist()):
        tag, share = tree.tag[node], _size(linked / max(chars, 1), SHARES)
        if tag == TEXT:
            parent = tree.tag[tree.parent[node]]
            text = tree.text[node]
            size = _size(words, COUNTS)
            yield node, "leaf"
            yield node, f"in {parent}"
            yield node, f"under {under[node]}"
            yield node, f"size {size}"
            yield node, f"size {size} links {share}"
            yield node, f"ends {text[-1] in '.!?。:'} {size > 3}"
            yield node, f"stops {_size(stops / words, (0.01, 0.08, 0.2))} {size}"
            yield node, f"at {_size(before[node] / leaves, (0.1, 0.3, 0.7, 0.9))}"
            if "©" in text:
                yield node, "copyright"
            continue
        yield node, f"tag {tag}"
        yield node, f"tag {tag} under {under[node]}"
        yield node, f"holds {_size(words, COUNTS)} links {share}"
        yield node, f"each {_size(words / max(many, 1), COUNTS)} {_size(many, (1, 2, 4, 8))}"
        yield node, f"part {_size(words / max(total[0, 0], 1), (0.1, 0.3, 0.5, 0.8))}"
        for name in tree.names[node]:
            yield node, f"name {name}"
            if len(name) > 5:
                yield node, f"begins {name[:5]}"


def forest(trees: list[Tree]) -> Forest:
    parent, kind, row, feature, base = [], [], [], [], 0
    for tree in trees:
        parent += [p + base if p >= 0 else -1 for p in tree.parent]
        kind += [KIND.get(t, KINDS - 2 + bool(names)) for t, names in zip(tree.tag, tree.names)]
        for node, name in features(tree):
            row.append(node + base)
            feature.append(_at(name))
        base += len(tree.tag)
    above, kind, row, feature = (np.array(x, np.int64) for x in (parent, kind, row, feature))
    return Forest(above, kind, row, feature, _levels(above))


class Marginals(NamedTuple):
    content: np.ndarray  # of each node
    edge: np.ndarray  # of labels of parent and child, for each node but roots


def sum_product(trees: Forest, unary: np.ndarray, pair: np.ndarray) -> Marginals:
    """Exact marginals from potentials in logarithms: ``unary`` of label 1, ``pair`` by kind of child."""
    n = len(trees.parent)
    inside, sent = np.zeros((n, 2)), np.zeros((n, 2))
    inside[:, 1] = unary
    for level in trees.levels[:0:-1]:
        both = pair[trees.kind[level]] + inside[level][:, None, :]
        sent[level] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        np.add.at(inside, trees.parent[level], sent[level])
    belief, edge = inside.copy(), np.zeros((n, 2, 2))
    for level in trees.levels[1:]:
        above = belief[trees.parent[level]] - sent[level]
        joint = pair[trees.kind[level]] + above[:, :, None]
        belief[level] = inside[level] + np.logaddexp(joint[:, 0], joint[:, 1])
        joint = joint + inside[level][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        edge[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return Marginals(1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), edge)


class Model(NamedTuple):
    weight: np.ndarray
    pair: np.ndarray

    def unary(self, trees: Forest) -> np.ndarray:
        return np.bincount(trees.row, self.weight[trees.feature], len(trees.parent))


def learn(
    trees: Forest, label: np.ndarray, steps: int = 80, rate: float = 0.3, shrink: float = 1.0
) -> Model:
    """Maximum conditional likelihood of all labels, with an L2 penalty, by Adam over all pages."""
    weight, pair = np.zeros(DIM), np.zeros((KINDS, 2, 2))
    child = np.flatnonzero(trees.parent >= 0)
    kind = trees.kind[child]
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (kind, label[trees.parent[child]], label[child]), 1)
    moments = [[np.zeros(DIM), np.zeros(DIM)], [np.zeros_like(pair), np.zeros_like(pair)]]
    for step in range(1, steps + 1):
        model = Model(weight, pair)
        found = sum_product(trees, model.unary(trees), pair)
        expected = np.zeros((KINDS, 2, 2))
        np.add.at(expected, kind, found.edge[child])
        residual = (label - found.content)[trees.row]
        slopes = [
            np.bincount(trees.feature, residual, DIM) - shrink * weight,
            seen - expected - shrink * pair,
        ]
        moved = []
        for (first, second), slope in zip(moments, slopes):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            size = np.sqrt(second / (1 - 0.99**step)) + 1e-8
            moved.append(rate * (first / (1 - 0.9**step)) / size)
        weight, pair = weight + moved[0], pair + moved[1]
    return Model(weight, pair)


def by_landmarks(tree: Tree) -> list[int] | None:
    """A label for each node of a page that says itself where its article is."""
    inside = [0]
    for above, tag in zip(tree.parent[1:], tree.tag[1:]):
        own = inside[above]
        inside.append(1 if tag in ARTICLE and own >= 0 else -1 if tag in ASIDE else own)
    return [int(x > 0) for x in inside] if 1 in inside else None


def by_marks(tree: Tree) -> list[int]:
    """A label for each node of a labelled page, by the nearest element around it that has one."""
    inside = [int(tree.given[0] == "1")]
    for above, given in zip(tree.parent[1:], tree.given[1:]):
        inside.append(int(given) if given in ("0", "1") else inside[above])
    return inside


def plainer(tree: Tree, seed: int) -> Tree:
    """The page with some landmarks and names taken away, so that words and links must tell."""
    chance = np.random.default_rng(seed).random(len(tree.tag))
    plain, drop = Tree(), ARTICLE | ASIDE
    plain.parent, plain.text, plain.linked = tree.parent, tree.text, tree.linked
    plain.tag = ["div" if t in drop and c < 0.6 else t for t, c in zip(tree.tag, chance)]
    plain.names = [[] if c < 0.6 else names for names, c in zip(tree.names, chance)]
    return plain


def train(pages: list[str], marked: list[str]) -> Model:
    """The model from pages with landmarks and from labelled ones, as they are and made plainer."""
    trees, labels = [], []
    for html in pages:
        tree = parse(html)
        own = by_landmarks(tree)
        if own:
            trees.append(tree)
            labels.append(own)
    for html in marked:
        tree = parse(html)
        trees.append(tree)
        labels.append(by_marks(tree))
    trees += [plainer(tree, seed) for seed, tree in enumerate(trees)]
    return learn(forest(trees), np.array([x for own in labels * 2 for x in own], np.int64))


def main_texts(pages: list[str], model: Model, threshold: float = 0.5) -> list[str]:
    """Runs of text whose marginal reaches the threshold, in page order."""
    trees = [parse(html) for html in pages]
    whole = forest(trees)
    content = sum_product(whole, model.unary(whole), model.pair).content
    out, base = [], 0
    for tree in trees:
        kept = content[base : base + len(tree.tag)] >= threshold
        out.append(" ".join(text for text, keep in zip(tree.text, kept) if text and keep))
        base += len(tree.tag)
    return out


class Sample(NamedTuple):
    """How many pages of the table, of how many bytes in all, and how many layouts are learned from."""

    pages: int = 200
    bytes: int = 8 << 20
    layouts: int = 1000


def trained(pages: DataFrame, sample: Sample) -> Model:
    """The model, learned in one task from a bounded sample of ``pages`` (page_id, html).

    Pages are taken in the order of a hash of their text as long as they have at most ``sample.bytes`` in
    all; one that doesn't fit is passed over, equal ones count once.
    """
    sized = pages.select(
        F.xxhash64("html").alias("hash"), F.octet_length("html").cast("long").alias("bytes")
    )
    # One number and one size for each of at most ``sample.pages`` pages.
    first = sized.where((F.col("bytes") > 0) & (F.col("bytes") <= sample.bytes)).groupBy("hash")
    chosen, room = [], sample.bytes
    first = first.agg(F.min("bytes").alias("bytes")).orderBy("hash").limit(sample.pages)
    for row in first.collect():
        if row["bytes"] <= room:
            room -= row["bytes"]
            chosen.append((row["hash"],))
    spark = pages.sparkSession
    names = F.broadcast(spark.createDataFrame(chosen, "hash long"))
    rows = pages.withColumn("hash", F.xxhash64("html")).join(names, "hash")
    one = rows.groupBy("hash").agg(F.min("html").alias("html"))
    layouts = sample.layouts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = [html for batch in batches for html in batch.column("html").to_pylist()]
        model = train(shown, labelled_pages(layouts))
        values = [model.weight.tobytes(), model.pair.tobytes()]
        yield pa.record_batch([pa.array([0, 1], pa.int32()), pa.array(values)], ["part", "data"])

    # An empty partition is handed to a task too: without pages the layouts teach alone.
    ordered = one.repartition(1).sortWithinPartitions("hash").select("html")
    got = dict(saved(ordered.mapInArrow(run, "part int, data binary"), "html-model").collect())
    if not got:
        return train([], labelled_pages(layouts))
    return Model(np.frombuffer(got[0]), np.frombuffer(got[1]).reshape(KINDS, 2, 2))


def html_text(
    pages: DataFrame,
    sample: Sample = Sample(),
    threshold: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    The text is that of the article: runs between edges of blocks, character references decoded, white
    space turned into one space, joined by one space in page order. A NULL or empty page, and one without
    an article, has an empty text. Repeated rows and NULL ids or urls give a row each; other columns play no part; an
    empty table gives no rows. A page is one task's work, in memory in proportion to its length; any string
    is a page. No row but those of the sample is shuffled.
    """
    ship(pages.sparkSession)
    own = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    model = trained(own.select("html"), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", SLICE):
            found = main_texts(part.column("html").to_pylist(), model, threshold)
            columns = [part.column("page_id"), part.column("url"), pa.array(found, pa.string())]
            lengths = pa.array(list(map(len, found)), pa.int64())
            yield pa.record_batch([*columns, lengths], ["page_id", "url", "text", "n_chars"])

    return own.mapInArrow(run, SCHEMA)
