"""Token counts under a unigram model, with the forward scores kept in a trie.

A text's pre-tokens are its runs of anything but ASCII white space, each with the mark of a word's start
before it. Distinct pre-tokens go into a trie. A node holds the best score of any segmentation of
its prefix and that segmentation's number of tokens; it is computed once, from the nodes above it,
however many pre-tokens share the prefix. A pre-token's count is read off its last node. One longer
than ``LONG`` bytes shares next to nothing and stays outside: its scores are kept for the last places only.
"""

from __future__ import annotations

import codecs
import math
from array import array
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import saved, slices, texts

#: What a worker remembers before it starts anew: nodes (about 150 bytes each) and pre-tokens.
NODES = 1_200_000
PRE_TOKENS = 600_000
#: Bytes of the longest pre-token that is remembered, and of the longest that goes into the trie.
REMEMBERED = 64
LONG = 4096
#: Bytes of a longer one that are looked at at a time.
BLOCK = 1 << 16
#: How much worse than any piece an unknown character is.
UNKNOWN = 10.0
WORD_START = "▁"


def zipf_scores(path: str) -> dict[str, float]:
    """Log-probabilities of the pieces of a sentencepiece file, by Zipf's law over their order.

    The file of a merge model holds ranks, no probabilities. Control, unknown and byte pieces are left
    out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(k)
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))
    ]
    total = math.log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
    return {piece: -math.log(rank) - total for rank, piece in enumerate(pieces, 1)}


class Trie:
    """Forward scores of prefixes. An unknown character counts as its UTF-8 bytes."""

    def __init__(self, scores: Mapping[str, float], most_nodes: int = NODES):
        self.most_nodes = most_nodes
        #: All ends of pieces; what is no piece itself has no score.
        self.ends: dict[str, float] = {p[k:]: -math.inf for p in scores for k in range(1, len(p))}
        self.ends.update(scores)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN
        self.longest = max(map(len, self.ends), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.parent, self.best, self.tokens = array("q", [-1]), array("d", [0.0]), array("q", [0])

    def count(self, pre_token: str) -> int:
        """Tokens of the best segmentation; of equal ones the one whose last piece is longest."""
        if len(self.best) > self.most_nodes:
            self.clear()
        node, child = 0, self.child
        for end, letter in enumerate(pre_token, 1):
            key = node << 21 | ord(letter)
            below = child.get(key)
            if below is None:
                below = child[key] = self._add(node, pre_token, end)
            node = below
        return self.tokens[node]

    def _add(self, above: int, text: str, end: int) -> int:
        """A node for text[:end] under that of text[:end - 1]."""
        best, parent, ends = self.best, self.parent, self.ends
        letter = text[end - 1]
        alone = ends.get(letter, -math.inf)
        if alone > -math.inf:
            score, tokens = best[above] + alone, 1
        else:
            score, tokens = best[above] + self.unknown, len(letter.encode())
        last, node, start = above, parent[above], end - 2
        while node >= 0:
            # Longer pieces that end here must end like this too.
            piece = ends.get(text[start:end])
            if piece is None:
                break
            if best[node] + piece >= score:  # the longest of equal ones is looked at last
                score, last, tokens = best[node] + piece, node, 1
            node = parent[node]
            start -= 1
        parent.append(above)
        best.append(score)
        self.tokens.append(self.tokens[last] + tokens)
        return len(best) - 1

    def rolling(self, parts: Iterable[str]) -> int:
        """``count`` of the joined parts, with the scores of no more places than a piece is long."""
        ends, text, best, tokens = self.ends, "", [0.0], [0]
        for part in parts:
            begin, text = len(text), text + part
            for end in range(begin + 1, len(text) + 1):
                letter = text[end - 1]
                alone = ends.get(letter, -math.inf)
                if alone > -math.inf:
                    score, more = best[end - 1] + alone, 1
                else:
                    score, more = best[end - 1] + self.unknown, len(letter.encode())
                last = end - 1
                for start in range(end - 2, -1, -1):
                    piece = ends.get(text[start:end])
                    if piece is None:
                        break
                    if best[start] + piece >= score:
                        score, last, more = best[start] + piece, start, 1
                best.append(score)
                tokens.append(tokens[last] + more)
            cut = max(0, len(text) - self.longest)
            text, best, tokens = text[cut:], best[cut:], tokens[cut:]
        return tokens[-1]


def _letters(word: bytes) -> Iterator[str]:
    """The word's start and its letters, decoded a block at a time."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    yield WORD_START
    with memoryview(word) as view:
        for begin in range(0, len(word), BLOCK):
            yield decoder.decode(view[begin : begin + BLOCK])


class Counts(dict):
    """Tokens of pre-tokens; short ones are asked of the trie once each."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        if len(word) > LONG:
            return self.trie.rolling(_letters(word))
        if len(word) > REMEMBERED:
            return self.trie.count(WORD_START + word.decode())
        if len(self) >= PRE_TOKENS:
            self.clear()
        self[word] = found = self.trie.count(WORD_START + word.decode())
        return found


_READY: dict[str, Counts] = {}


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens of every row.

    A NULL or empty text, or one of white space, has none. Ids may be NULL or repeated, each row is
    counted for itself; an empty table gives no rows. A very long text, or pre-token, takes a few times
    its bytes. ``path`` is the piece file's place on every
    machine. No shuffle: each task counts its own texts, and the tasks of a worker share its trie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _READY:
            _READY[path] = Counts(Trie(zipf_scores(path)))
        count = _READY[path].__getitem__
        for part in slices(batches):
            words = [t.as_buffer().to_pybytes().split() for t in part.column("text")]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(map(len, words), pa.int64()),
                    pa.array((sum(map(count, own)) for own in words), pa.int64()),
                ],
                ["doc_id", "n_pre_tokens", "n_tokens"],
            )

    schema = "doc_id long, n_pre_tokens long, n_tokens long"
    return saved(texts(docs, id_column, text_column).mapInArrow(run, schema), "token-counts")
