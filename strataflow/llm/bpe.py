"""Byte-level BPE by a rank queue over linked lists.

All pre-tokens of a slice lie in one array of tokens, linked to their neighbours but never across a
pre-token's end. A bucket per merge rank holds the positions whose pair has that rank; a bitmap in
levels of 64 bits tells the lowest rank that has positions. Taking a bucket merges all its positions
at once. Entries whose pair has changed meanwhile are stale and skipped. The work is in proportion
to the bytes, whatever the length of a pre-token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strataflow.llm.common import saved, texts
from strataflow.llm.tokens import ChunkIds, Encoder, encoded, spread

SLICE = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, as written in a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class RankQueue:
    """Buckets of positions by rank, and a bitmap of three levels over the ranks in use."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        low = ranks // 64 + 1
        middle = low // 64 + 1
        self.low, self.middle, self.top = [0] * low, [0] * middle, 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        begins = [0, *cuts.tolist()]
        for rank, begin, end in zip(ranks[begins].tolist(), begins, [*begins[1:], len(ranks)]):
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = [positions[begin:end]]
                self.low[rank >> 6] |= 1 << (rank & 63)
                self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
                self.top |= 1 << (rank >> 12)
            else:
                bucket.append(positions[begin:end])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank in use, and its positions in order."""
        a = (self.top & -self.top).bit_length() - 1
        word = self.middle[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.middle[a] &= self.middle[a] - 1
            if not self.middle[a]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))

    def __bool__(self) -> bool:
        return self.top != 0


class Bpe:
    """Encodes pre-tokens by merge ranks; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        left, right, merged = (np.array(x, np.int64) for x in (left, right, merged))
        order = np.argsort(left * self.size + right)
        self.pairs, self.merged = (left * self.size + right)[order], merged[order]
        #: Tokens that can take part in a merge of a lower rank than their own: after one such
        #: merge the rest of its pre-token may have to wait.
        self.early = np.zeros(self.size, bool)
        self.early[left[left > merged]] = True
        self.early[right[right > merged]] = True

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is none."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.merged[at], -1)

    def encode(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has. A piece that is a token is it."""
        whole = [self.ranks.get(p, -1) for p in pieces]
        rest = [p for p, w in zip(pieces, whole) if w < 0]
        whole = np.array(whole, np.int64)
        counts = (whole >= 0).astype(np.int64)
        ids, lengths = self._merge(rest)
        counts[whole < 0] = lengths
        out = np.empty(int(counts.sum()), np.int64)
        owner = np.repeat(whole, counts)
        out[owner >= 0] = owner[owner >= 0]
        out[owner < 0] = ids
        return out, counts

    def _merge(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(sizes.sum())
        if not n:
            return np.empty(0, np.int64), sizes
        token = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = sizes > 0
        ends = np.cumsum(sizes)
        after[ends[filled] - 1] = -1
        before[(ends - sizes)[filled]] = -1
        alive = np.ones(n, bool)
        #: The rank that the pair at each position has now.
        now = np.full(n, -1, np.int64)
        queue = RankQueue(self.size)

        def renew(at: np.ndarray) -> None:
            now[at] = -1
            at = at[after[at] >= 0]
            ranks = self._rank(token[at], token[after[at]])
            now[at] = ranks
            found = ranks >= 0
            if found.any():
                queue.push(ranks[found], at[found])

        renew(np.arange(n))
        while queue:
            rank, at = queue.pop()
            at = at[now[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                if self.early[rank]:  # one for each piece, the leftmost
                    first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
                    if not first.all():
                        queue.push(np.full(int((~first).sum()), rank), at[~first])
                        at = at[first]
                # In a row of pairs that overlap, every second one merges.
                linked = np.r_[False, after[at[:-1]] == at[1:]]
                if linked.any():
                    index = np.arange(len(at))
                    start = np.maximum.accumulate(np.where(linked, 0, index))
                    at = at[(index - start) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            token[at] = rank
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            alive[gone] = False
            now[gone] = -1
            left = before[at]
            renew(np.unique(np.concatenate([at, left[left >= 0]])))
        return token[alive], np.bincount(owner[alive], minlength=len(pieces))


def piece_encoder(path: str, pattern: str) -> tuple[Bpe, Encoder]:
    """Encodes strings: each match of the pattern in them separately."""
    bpe, matches = Bpe(read_ranks(path)), regex.compile(pattern)

    def encode(strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: dict[str, int] = {}
        found = [
            [pieces.setdefault(p, len(pieces)) for p in matches.findall(s)] for s in strings
        ]
        ids, lengths = bpe.encode([p.encode() for p in pieces])
        numbers = np.array([p for row in found for p in row], np.int64)
        own = lengths[numbers]
        at = spread((np.cumsum(lengths) - lengths)[numbers], own)
        bounds = np.cumsum([0, *map(len, found)])
        return ids[at], np.diff(np.r_[0, np.cumsum(own)][bounds])

    return bpe, encode


_MADE: dict[tuple[str, str], tuple] = {}


def bpe_roundtrip(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each text encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A NULL or empty text has no tokens; ids may be NULL or repeated, each row stands for itself; an
    empty table gives no rows. ``path`` is the rank file's place on every machine. The pattern must
    end a match before each single space that a non-space follows, as that of byte-level BPE does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _MADE:
            bpe, encode = piece_encoder(path, pattern)
            _MADE[path, pattern] = (bpe, ChunkIds(encode), [str(i) for i in range(bpe.size)])
        bpe, chunks, decimal = _MADE[path, pattern]
        for part, ids, counts in encoded(batches, chunks, SLICE):
            ids_hash, text_hash, begin = [], [], 0
            for count in counts.tolist():
                own = ids[begin : begin + count].tolist()
                begin += count
                listed = ",".join(map(decimal.__getitem__, own))
                ids_hash.append(hashlib.sha256(listed.encode()).hexdigest())
                decoded = b"".join(map(bpe.tokens.__getitem__, own))
                text_hash.append(hashlib.sha256(decoded).hexdigest())
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(counts, pa.int64()), ids_hash, text_hash],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return saved(texts(docs, id_column, text_column).mapInArrow(run, schema), "bpe")
