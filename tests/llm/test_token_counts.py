import random
import tracemalloc

import public_tokenizers as public
import pytest
from tokenizers import Tokenizer, models

from strataflow.llm import token_counts as module
from strataflow.llm.token_counts import WORD_START, Counts, Trie, token_counts, zipf_scores

from .conftest import found

PIECES = public.path("piece_bpe_32k.model")


def library(scores):
    """The same unigram model in the tokenizers library."""
    vocabulary = [("<unk>", 0.0), *scores.items()]
    vocabulary += [(f"<0x{b:02X}>", -1e9) for b in range(256)]
    return vocabulary


def plain_count(scores, word):
    """Forward pass over one pre-token, starts in ascending order."""
    low, longest = min(scores.values()) - 10, max(map(len, scores))
    best = [(0.0, 0)] + [None] * len(word)
    for start in range(len(word)):
        for end in range(start + 1, min(start + longest, len(word)) + 1):
            piece = scores.get(word[start:end])
            count = 1
            if piece is None:
                if end > start + 1:
                    continue
                piece, count = low, len(word[start].encode())
            score = best[start][0] + piece
            if best[end] is None or score > best[end][0]:
                best[end] = (score, best[start][1] + count)
    return best[-1][1]


@pytest.mark.parametrize("seed", range(10))
def test_trie_like_the_plain_pass(seed):
    chance = random.Random(seed)
    pieces = {"".join(chance.choices("abcé", k=chance.randint(1, 4))) for _ in range(40)} - {"é"}
    scores = {p: -chance.choice([1.0, 2.0, 2.5, chance.random() * 9]) for p in sorted(pieces)}
    trie = Trie(scores, most_nodes=200)
    for _ in range(400):
        word = "".join(chance.choices("abcé漢", k=chance.randint(1, 12)))
        assert trie.count(word) == plain_count(scores, word), word


def test_prefixes_are_shared():
    trie = Trie({"a": -1.0, "ab": -1.5, "b": -1.0})
    trie.count("abab")
    nodes = len(trie.best)
    assert trie.count("aba") == 2 and len(trie.best) == nodes
    assert trie.count("ababa") == 3 and len(trie.best) == nodes + 1


def test_against_the_library():
    scores = zipf_scores(PIECES)
    low = min(scores.values())
    vocabulary = [("<unk>", low - 10), *scores.items()]
    model = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    trie, chance = Trie(scores), random.Random(2)
    letters = [p for p in scores if len(p) == 1 and p.isalpha()][:60]
    for _ in range(500):
        word = WORD_START + "".join(chance.choices(letters, k=chance.randint(1, 15)))
        assert trie.count(word) == len(model.encode(word).ids)


@pytest.mark.parametrize("name", ["edge_docs", "small_docs", "no_docs"])
def test_counts(name, request):
    docs = request.getfixturevalue(name).limit(60)
    scores, known = zipf_scores(PIECES), {}
    want = []
    for row in docs.collect():
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        for word in words:
            if word not in known:
                known[word] = plain_count(scores, WORD_START + word)
        want.append((row["doc_id"], len(words), sum(known[w] for w in words)))
    got = token_counts(docs, PIECES)
    rows = found(got, "doc_id", "n_pre_tokens", "n_tokens")
    assert rows == sorted(want, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_long_pre_tokens_outside_the_trie(monkeypatch, block):
    monkeypatch.setattr(module, "LONG", 6)
    monkeypatch.setattr(module, "BLOCK", block)
    chance = random.Random(block)
    scores = {"ab": -1.0, "a": -1.5, "b": -2.0, "abab": -1.0, "é漢": -1.0, "ba": -0.5, WORD_START + "a": -0.1}
    counts = Counts(Trie(scores))
    for _ in range(300):
        word = "".join(chance.choices("abé漢", k=chance.randint(1, 40)))
        assert counts[word.encode()] == plain_count(scores, WORD_START + word), word
    assert max(map(len, counts)) <= 6


def test_a_very_long_pre_token_in_bounded_memory():
    counts = Counts(Trie(zipf_scores(PIECES)))
    word = random.Random(3).randbytes(100_000).hex().encode()
    nodes = len(counts.trie.best)
    tracemalloc.start()
    got = counts[word]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 50_000 < got < len(word) and peak < 10 << 20
    assert not counts and len(counts.trie.best) == nodes
    assert counts[word[:5000]] == counts.trie.count(WORD_START + word[:5000].decode())
