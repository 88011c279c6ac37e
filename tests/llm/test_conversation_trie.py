import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import conversation_trie as module
from strataflow.llm.conversation_trie import conversation_trie, ends_hashes, running

from .conftest import found

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = own
    if rebuild:
        paths = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            base = c - int(c - 20 * int(c / 20))
            paths[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, tokens = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        tokens[node] = (len(members[node]) - 1) * words + sum(tokens[k] for k in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            leaves[node], tokens[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda row: [(v is not None, v) for v in row])


def made(seed, convs, turns, texts):
    chance, rows = random.Random(seed), []
    for c in chance.sample(range(3 * convs), convs):
        for turn in range(chance.randint(1, turns)):
            rows.append((c, turn, chance.choice(["user", "assistant"]), chance.choice(texts)))
    # A conversation whose turns are most of the table, next to one that shares all but its end.
    rows += [(5, k, "user", "hot") for k in range(3, 400)] + [(6, k, "user", "hot") for k in range(390)]
    rows += [(k, 0, "user", "same first turn") for k in range(1000, 1100)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("block", [1, 40])
def test_like_a_trie_in_memory(spark, rebuild, block):
    rows = made(block, 60, 6, ["a", "b b", "", " c\td\n"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = conversation_trie(df, rebuild=rebuild, least_block=block)
    assert found(got, *COLUMNS) == brute(rows, rebuild)


def test_large_nodes_are_cut(spark, monkeypatch):
    """A block below the root of the table: most nodes are in segments of chains."""
    monkeypatch.setattr(module.math, "isqrt", lambda n: 3)
    rows = made(9, 80, 9, ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA)
    got = conversation_trie(df, rebuild=True, least_block=3)
    assert found(got, *COLUMNS) == brute(rows, True)


def test_edges(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"),
        (1, 0, "user", "a tie"), (1, 0, "assistant", "z tie"), (2, None, "", ""), (2, 0, "assistant", "z tie"),
        (-7, 1, "user", None), (-40, 0, "user", "q"), (-45, 0, "user", "r"), (-45, 1, "user", "s"),
        (20, 3, "user", "w " * 200_000), (33, 3, "user", "w " * 200_000), (33, 4, None, ""), (2**40, 1, "u", "t"),
    ] + [(k, 0, "user", "x") for k in range(40, 80)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit("x").alias(n) for n in ("pos", "words", "part", "chain", "base", "h", "n", "first")])
    for rebuild in (False, True):
        assert found(conversation_trie(df, rebuild=rebuild), *COLUMNS) == brute(rows, rebuild)
    none = conversation_trie(df.where("false"), rebuild=True)
    assert none.collect() == [] and none.columns == COLUMNS


def test_conversation_over_many_ranges(spark):
    rows = [(k % 3 if k < 30 else 1, k) for k in range(5000)]
    df = spark.createDataFrame(rows, "c long, k long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df, "c", [F.col("k")], ["k"], {"n": F.lit(1), "s": F.col("k")}, "running").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, sums = [], defaultdict(lambda: [0, 0])
    for c, k in sorted(rows):
        sums[c][0] += 1
        sums[c][1] += k
        want.append((c, k, *sums[c]))
    assert sorted(tuple(r) for r in got) == want


def test_many_ids_end_at_a_node(spark, monkeypatch):
    monkeypatch.setattr(module, "IDS", 7)
    rows = [(1, 2, k) for k in range(500)] + [(k % 9, 3, k) for k in range(-40, 40)]
    got = ends_hashes(spark.createDataFrame(rows, "chain long, pos long, conv_id long").repartition(5))
    want = defaultdict(list)
    for chain, pos, c in rows:
        want[chain, pos].append(c)
    hashed = {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
    assert {(r["chain"], r["pos"]): r["ends_sha256"] for r in got.collect()} == hashed


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(conversation_trie(df, rebuild=True), *COLUMNS) == brute(rows, True)
