import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from strataflow.llm.bpe import Bpe, RankQueue, bpe_roundtrip, read_ranks
from strataflow.llm.packing import best_fit, improve, packed
from strataflow.llm.token_files import (
    Coder, CorruptBlock, read_token_files, scaled, write_token_files,
)

from .conftest import found

RANKS = public.path("byte_bpe_multi_50k.tiktoken")
BYTES = public.path("byte_bpe_50k.json")
WORDS = public.path("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def in_order(values):
    return sorted(values, key=lambda row: [(v is not None, v) for v in row])


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_queue_gives_the_lowest_rank():
    queue, numbers = RankQueue(50_000), random.Random(1).sample(range(50_000), 500)
    queue.push(np.array(numbers), np.arange(500))
    queue.push(np.array(numbers[:9]), np.arange(500, 509))
    got = []
    while queue:
        rank, at = queue.pop()
        got += [rank] * len(at)
    assert got == sorted(numbers + numbers[:9])


@pytest.mark.parametrize("seed", range(30))
def test_merges_like_one_by_one(seed):
    chance = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    while len(ranks) < 320:
        a, b = chance.choices([t for t in ranks if set(t) <= set(b"abc")], k=2)
        ranks.setdefault(a + b, len(ranks))
    if seed % 2:  # tokens whose parts have higher ranks than they
        names, numbers = list(ranks), list(range(256))
        chance.shuffle(late := list(range(256, 320)))
        ranks = dict(zip(names, numbers + late))
    own = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    texts = ["".join(chance.choices("abc", k=chance.randint(1, 40))) for _ in range(200)]
    ids, counts = Bpe(ranks).encode([t.encode() for t in texts])
    assert ids.tolist() == [i for t in texts for i in own.encode_ordinary(t)]
    assert counts.tolist() == [len(own.encode_ordinary(t)) for t in texts]


def roundtrip(docs):
    own = tiktoken.Encoding(
        "t", pat_str=public.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}
    )
    out = []
    for doc, text in rows(docs):
        ids = own.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out.append((doc, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    return in_order(out)


@pytest.mark.parametrize("name", ["edge_docs", "small_docs", "no_docs"])
def test_byte_bpe(name, request):
    docs = request.getfixturevalue(name)
    got = bpe_roundtrip(docs, RANKS, public.PATTERN)
    assert found(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == roundtrip(docs)


@pytest.mark.parametrize("name", ["edge_docs", "small_docs", "no_docs"])
def test_token_files(name, request):
    docs, encode = request.getfixturevalue(name), library(BYTES)
    folder = write_token_files(docs, BYTES, 0, 50_257)
    # A session of its own knows nothing but the folder.
    got = found(read_token_files(docs.sparkSession.newSession(), folder), "start", "doc_id", "n_tokens", "ids_crc32")
    want, start = [], 0
    for doc, text in sorted(rows(docs), key=lambda r: (r[0] is not None, r[0])):
        ids = encode(text) + [0]
        want.append((doc, len(ids), crc(ids)))
        start += len(ids)
    starts = [r[0] for r in got]
    assert starts == [0, *np.cumsum([r[2] for r in got]).tolist()][: len(got)]
    assert [r[1] for r in got] == [r[0] for r in want]
    assert in_order(r[1:] for r in got) == in_order(want)


def test_a_damaged_table_is_refused(small_docs):
    spark = small_docs.sparkSession
    folder = write_token_files(small_docs.limit(3), BYTES, 0, 50_257)
    row = spark.read.parquet(f"{folder}/table").first()
    broken = bytearray(row["frequencies"])
    broken[9] ^= 1
    other = f"{folder}-broken"
    spark.createDataFrame([(broken, row["crc32"])], "frequencies binary, crc32 long").write.parquet(f"{other}/table")
    spark.read.parquet(f"{folder}/blocks").write.parquet(f"{other}/blocks")
    with pytest.raises(CorruptBlock):
        read_token_files(spark, other)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000, 4097])
def test_blocks(n):
    ids = np.random.default_rng(n).zipf(1.5, n) % 300
    coder = Coder(scaled(np.bincount(ids, minlength=300)))
    block = coder.encode(ids, lanes=8, every=16)
    assert coder.decode(block).tolist() == ids.tolist()
    for k, begin in enumerate(range(0, n, 128)):
        assert coder.decode_from(block, k).tolist() == ids[begin : begin + 128].tolist()
    for at in range(0, len(block), max(1, len(block) // 50)):
        broken = bytearray(block)
        broken[at] ^= 1
        if n:
            with pytest.raises(CorruptBlock):
                coder.decode(bytes(broken))


@pytest.mark.parametrize("capacity", [4096, 64])
@pytest.mark.parametrize("name", ["edge_docs", "small_docs", "no_docs"])
def test_packing(name, capacity, request):
    docs, encode = request.getfixturevalue(name), library(WORDS)
    got = packed(docs, WORDS, 1, capacity, group=1_000_000)
    want = []
    for doc, text in rows(docs):
        ids = encode(text) + [1]
        cuts = range(0, len(ids), capacity)
        want += [
            (doc, k, s, len(ids[s : s + capacity]), crc(ids[s : s + capacity]))
            for k, s in enumerate(cuts)
        ]
    assert found(got, "doc_id", "piece", "start", "length", "ids_crc32") == in_order(want)
    bins = {}
    for row in sorted(got.collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert bins.get(row["sequence_id"], 0) == row["offset"]
        bins[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(bins.values(), default=0) <= capacity
    assert len(bins) <= -(-sum(r[3] for r in want) // capacity) * 1.03 + 1


@pytest.mark.parametrize("seed", range(20))
def test_local_search(seed):
    chance = np.random.default_rng(seed)
    lengths = chance.integers(1, 100, 60)
    worst = np.arange(60)
    before = best_fit(lengths, 100)
    assert np.bincount(before, lengths).max() <= 100
    for start in (before, worst):
        after = improve(lengths, start, 100)
        fill = np.bincount(after, lengths)
        assert fill.max() <= 100 and (fill > 0).sum() <= len(np.unique(start))
    assert (fill > 0).sum() <= len(np.unique(before)) + 2


def test_local_search_finds_an_exchange():
    lengths = np.array([6, 4, 5, 3, 2])  # 10 + 10, but one by one 6+3, 5+4, 2
    bins = improve(lengths, np.array([0, 1, 1, 0, 2]), 10)
    assert len(np.unique(bins)) == 2


def test_local_search_tries_every_source():
    # Forty sequences can give their one piece to none; the next one can empty itself.
    lengths = np.array([51] * 40 + [10] * 6 + [80])
    bins = np.r_[np.arange(40), [40] * 6, 41]
    after = improve(lengths, bins, 100)
    assert np.bincount(after, lengths).max() <= 100
    assert len(np.unique(after)) == 41


def no_exchange_left(lengths, bins, capacity):
    """No piece or pair can be given to a fuller sequence, for one of its pieces or for free room."""
    fill = np.bincount(bins, lengths)
    for source in np.flatnonzero((fill > 0) & (fill < capacity)):
        own = lengths[bins == source].tolist()
        pairs = [a + b for i, a in enumerate(own) for b in own[i + 1 :]]
        for target in np.flatnonzero((fill < capacity) & (fill >= fill[source])):
            if target == source:
                continue
            theirs, room = lengths[bins == target].tolist(), capacity - fill[target]
            if any(0 < g - t <= room for g in own for t in [0, *theirs]):
                return False
            if any(0 < g - t <= room for g in pairs for t in theirs):
                return False
    return True


@pytest.mark.parametrize("seed", range(30))
def test_local_search_ends_where_nothing_improves(seed):
    chance = np.random.default_rng(seed)
    lengths = chance.integers(1, 60 if seed % 2 else 100, 80)
    bins = improve(lengths, np.arange(80) // (1 + seed % 2), 120)
    fewest = -(-lengths.sum() // 120)
    assert np.bincount(bins, lengths).max() <= 120
    assert len(np.unique(bins)) == fewest or no_exchange_left(lengths, bins, 120)
