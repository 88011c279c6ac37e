import itertools
import re
import time
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import html_text as module
from strataflow.llm.html_layouts import labelled_pages
from strataflow.llm.html_text import (
    KINDS, TEXT, Forest, Sample, _levels, by_marks, forest, html_text, learn, main_texts, plainer,
    sum_product, train,
)
from strataflow.llm.html_tree import parse

from .conftest import found


def leaves(html):
    tree = parse(html)
    shown = zip(tree.parent, tree.tag, tree.text)
    return [(tree.tag[above], text) for above, tag, text in shown if tag == TEXT]


@pytest.mark.parametrize("html, want", [
    ("", []),
    ("just <b>te</b>xt", [("body", "just text")]),
    ("a&amp;b &lt;i&gt; &#233;&nbsp;&copy;", [("body", "a&b <i> é ©")]),
    ("<p>one<p>two</div></p>three", [("p", "one"), ("p", "two"), ("body", "three")]),
    ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d")]),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", [("td", "a"), ("td", "b"), ("th", "c"), ("body", "d")]),
    ("<table><tr><td><div>a</td></div><td>b", [("div", "a"), ("td", "b")]),
    ("x<br>y \n\t z<hr>w", [("body", "x y z"), ("body", "w")]),
    ("a<script>if (a < b) '</p>'</script>b<style>p{}</style><!-- <p>no -->c", [("body", "abc")]),
    ("a<!-->b<!--->c<!-- --!>d<?x y?>e<!x>f</ 3>g", [("body", "abcdefg")]),
    ("<p title='a>b'>x</p><p title=it's>y</p>", [("p", "x"), ("p", "y")]),
    ("a < b << c <3", [("body", "a < b << c <3")]),
    ("a<svg><text>no</text></svg>b<SELECT><option>no</select>c", [("body", "abc")]),
    ("a<button>b", [("body", "ab")]),
    ("a<script>lost", [("body", "a")]),
    ("a<!-- lost", [("body", "a")]),
    ("a<div", [("body", "a")]),
    ("<h1>a<h2>b</h3>c", [("h1", "a"), ("h2", "b"), ("body", "c")]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [("dt", "a"), ("dd", "b"), ("dt", "c")]),
])
def test_tree(html, want):
    assert leaves(html) == want


def test_links_and_names():
    tree = parse('<div class="mainNav top" id=x-1><a href=1>ab</a> cd</div><a>ef</div>')
    assert tree.names[1] == ["main", "nav", "top", "x"]
    assert [n for t, n in zip(tree.tag, tree.linked) if t == TEXT] == [2, 2]


@pytest.mark.parametrize("piece", [
    "<div>", "<p><b>", '<a b="', "<svg>", "</div><td>", "<!--", "<li><div>", "<", "&amp", "<a '=", "<ul><li>",
])
def test_any_page_takes_time_in_proportion(piece):
    html = piece * (400_000 // len(piece))
    begin = time.process_time()
    parse(html)
    assert time.process_time() - begin < 8


def random_forest(chance, count):
    parent = np.array([-1 if chance.random() < 0.2 else chance.integers(0, k) if k else -1 for k in range(count)])
    kind = chance.integers(0, KINDS, count)
    row = chance.integers(0, count, 3 * count)
    return Forest(parent, kind, row, chance.integers(0, 40, 3 * count), _levels(parent))


def brute(trees, unary, pair):
    """Marginals and the logarithm of the partition sum by adding up all labellings."""
    n = len(trees.parent)
    total, content, edge = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product([0, 1], repeat=n):
        score = sum(u for u, y in zip(unary, labels) if y)
        for v, p in enumerate(trees.parent):
            if p >= 0:
                score += pair[trees.kind[v], labels[p], labels[v]]
        weight = np.exp(score)
        total += weight
        content += weight * np.array(labels)
        for v, p in enumerate(trees.parent):
            if p >= 0:
                edge[v, labels[p], labels[v]] += weight
    return content / total, edge / total, np.log(total)


@pytest.mark.parametrize("seed", range(8))
def test_messages_give_the_marginals(seed):
    chance = np.random.default_rng(seed)
    trees = random_forest(chance, 10)
    unary, pair = chance.normal(0, 2, 10), chance.normal(0, 2, (KINDS, 2, 2))
    got, (content, edge, _) = sum_product(trees, unary, pair), brute(trees, unary, pair)
    assert np.allclose(got.content, content) and np.allclose(got.edge, edge)


def test_learning_climbs_the_likelihood():
    chance = np.random.default_rng(3)
    trees, label = random_forest(chance, 9), chance.integers(0, 2, 9)

    def objective(model):
        unary = model.unary(trees)
        score = unary @ label
        for v, p in enumerate(trees.parent):
            if p >= 0:
                score += model.pair[trees.kind[v], label[p], label[v]]
        penalty = 0.5 * ((model.weight**2).sum() + (model.pair**2).sum())
        return score - brute(trees, unary, model.pair)[2] - penalty

    best = learn(trees, label, steps=800, rate=0.02, shrink=1.0)
    top = objective(best)
    for _ in range(40):
        near = module.Model(
            best.weight + chance.normal(0, 0.02, len(best.weight)) * (best.weight != 0),
            best.pair + chance.normal(0, 0.02, best.pair.shape),
        )
        assert objective(near) < top


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    return train([r[0] for r in rows], labelled_pages(400))


@pytest.mark.parametrize("plain", [False, True])
def test_held_out_layouts(model, plain):
    trees = [parse(html) for html in labelled_pages(200, seed=5)]
    label = np.array([x for t in trees for x in by_marks(t)])
    leaf = np.array([tag == TEXT for t in trees for tag in t.tag])
    shown = forest([plainer(t, k) for k, t in enumerate(trees)] if plain else trees)
    content = sum_product(shown, model.unary(shown), model.pair).content >= 0.5
    assert (content == label)[leaf].mean() > (0.97 if plain else 0.99)


LONG = "Some words that make a sentence, as articles have, and one more to end it."


@pytest.mark.parametrize("html, want", [
    (f"<div id=menu><a href=1>Home</a> <a href=2>News</a></div><div class=post-body><h1>Title</h1><p>{LONG}</p>"
     f"<p>Short.</p><p>{LONG}</p></div><div id=comments><div class=comment><p>{LONG}</p></div></div>"
     "<div id=footer>&copy; Us</div>", f"Title {LONG} Short. {LONG}"),
    (f"<article><h1>T</h1><p>{LONG}</p><form><p>Subscribe to the letter</p><input></form><p>{LONG}</p>"
     f"<aside class=related><a href=1>Other</a></aside><section class=comments><p>{LONG}</p></section></article>",
     f"T {LONG} {LONG}"),
    (f"<div class=cookie-banner><p>{LONG}</p></div><main><p>{LONG}</p></main><footer>x</footer>", LONG),
])
def test_pages_of_other_kinds(model, html, want):
    assert main_texts([html], model) == [want]


def article(html):
    """What the pages of the table hold: one article element, with a few tags in it."""
    inner = re.search("<article>(.*?)</article>", html, re.S).group(1)
    plain = re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", inner))
    return " ".join(unescape(plain).split())


def test_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = found(html_text(pages), "page_id", "url", "text", "n_chars")
    want = []
    for row in pages.collect():
        text = article(row["html"])
        want.append((row["page_id"], row["url"], text, len(text)))
    assert got == sorted(want)


def test_edges(spark):
    long = f"<article><p>{'word ' * 300_000}</p></article>"
    rows = [
        (1, "u", None), (2, None, ""), (None, "v", "<p"), (3, "w", "  \n "), (3, "w", "  \n "), (4, "x", long),
        (5, "y", f"<article><p>{LONG}</p></article>"), (5, "y", f"<article><p>{LONG}</p></article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.select("*", *[F.lit("x").alias(n) for n in ("text", "n_chars", "hash", "bytes", "part")])
    small = Sample(pages=3, bytes=500, layouts=150)
    got = found(html_text(pages, small), "page_id", "url", "text", "n_chars")
    whole = " ".join(["word"] * 300_000)
    assert got == [
        (None, "v", "", 0), (1, "u", "", 0), (2, None, "", 0), (3, "w", "", 0), (3, "w", "", 0),
        (4, "x", whole, len(whole)), (5, "y", LONG, len(LONG)), (5, "y", LONG, len(LONG)),
    ]
    none = html_text(pages.where("false"), small)
    assert none.collect() == [] and none.columns == ["page_id", "url", "text", "n_chars"]
