"""Hashed features of texts, computed over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: An odd multiplier has an inverse modulo 2**64, so the hash of any span is a difference of sums.
BASE = 0x9E3779B97F4A7C15
#: Bytes of a long text that are looked at at a time.
PART = 1 << 20
_INVERSE = pow(BASE, -1, 1 << 64)
#: Letters and digits of ASCII in lower case, and all bytes of other characters; 0 elsewhere.
_WORD = np.array(
    [ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b * (b >= 128) for b in range(256)],
    np.uint8,
)


@lru_cache(2)
def _powers(base: int, bits: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, count: int) -> np.ndarray:
    return _powers(base, max(16, (count - 1).bit_length() if count > 1 else 0))[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal for equal spans, wherever they are."""
    return mixed((sums[end] - sums[begin]) * powers(_INVERSE, len(sums))[begin])


def runs(
    inside: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every run of ``inside`` bytes; none crosses a text's end."""
    first = np.zeros(len(inside), bool)
    first[offsets[:-1][offsets[:-1] < len(inside)]] = True
    begin, end = np.zeros((2, len(inside)), bool)
    begin[:1], end[-1:] = inside[:1], inside[-1:]
    begin[1:] = inside[1:] & (~inside[:-1] | first[1:])
    end[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    start = np.flatnonzero(begin)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return start, np.flatnonzero(end) + 1, owner


def _chains(
    own: np.ndarray, owner: np.ndarray, gram: int, skip: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of word n-grams and skip-pairs within a text, and the numbers of their last words."""
    chain = own
    for n in range(1, gram):
        chain = mixed(chain[:-1] * np.uint64(BASE) + own[n:])
        last = np.flatnonzero(owner[:-n] == owner[n:]) + n
        yield chain[last - n], last
    for gap in range(2, skip + 2):
        pair = mixed((own[:-gap] + np.uint64(gap)) * np.uint64(_INVERSE) + own[gap:])
        last = np.flatnonzero(owner[:-gap] == owner[gap:]) + gap
        yield pair[last - gap], last


def word_grams(
    data: np.ndarray,
    offsets: np.ndarray,
    gram: int,
    skip: int,
    stems: tuple[int, ...],
    bits: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and text numbers of hashed features of words in lower case.

    They are the words, their first bytes (``stems``), word n-grams up to ``gram``, and pairs of words
    that skip up to ``skip`` words between them.
    """
    lower = _WORD[data]
    begin, end, owner = runs(lower > 0, offsets)
    sums = prefix_sums(lower)
    own = span_hash(sums, begin, end)
    found, owners = [own], [owner]
    for stem in stems:
        found.append(mixed(span_hash(sums, begin, np.minimum(begin + stem, end)) + np.uint64(stem)))
        owners.append(owner)
    for hashes, last in _chains(own, owner, gram, skip):
        found.append(hashes)
        owners.append(owner[last])
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owners)


#: What separates words where case and punctuation matter.
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _word_pairs(own: np.ndarray) -> np.ndarray:
    return np.where(own[:-1] == own[1:], np.uint64(BASE), mixed(own[:-1] * np.uint64(BASE) + own[1:]))


def subword_grams(
    data: np.ndarray, offsets: np.ndarray, chars: tuple[int, ...], bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of buckets and text numbers: words, word pairs, and byte n-grams of the sizes given.

    A pair of two equal words is one feature, whatever the word.
    """
    shift = np.uint64(64 - bits)
    sums = prefix_sums(data)
    begin, end, owner = runs(~_SPACE[data], offsets)
    own = span_hash(sums, begin, end)
    yield (own >> shift).astype(np.int64), owner
    pair = _word_pairs(own)
    same = owner[:-1] == owner[1:]
    yield (pair[same] >> shift).astype(np.int64), owner[:-1][same]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    back = powers(_INVERSE, len(data))
    for n in chars:
        if len(data) >= n:
            count = len(data) - n + 1
            gram = mixed((sums[n:] - sums[:-n]) * back[:count] + np.uint64(n))
            same = owner[:count] == owner[n - 1 :]
            yield (gram[same] >> shift).astype(np.int64), owner[:count][same]


def in_parts(offsets: np.ndarray) -> bool:
    """Whether this is one long text, whose features are to be taken part by part."""
    return len(offsets) == 2 and offsets[1] - offsets[0] > PART


def _parts(data: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    for begin in range(0, len(data), PART):
        yield data[begin : begin + PART], begin + PART >= len(data)


class _Words:
    """Hashes of the words, and of their first bytes, of one text that comes in parts."""

    def __init__(self, stems: tuple[int, ...] = ()):
        self.stems = stems
        #: Of the word that the next part may go on with: its bytes so far, and a sum for each hash.
        self.length, self.sums = 0, [0] * (1 + len(stems))

    def take(self, data: np.ndarray, inside: np.ndarray, last: bool) -> list[np.ndarray]:
        """Hashes of the words that end in this part, then for each stem those of their first bytes."""
        begin, end, _ = runs(inside, np.array([0, len(data)]))
        sums = prefix_sums(data)
        back = powers(_INVERSE, len(sums))[begin]
        lengths = end - begin
        values = [(sums[end] - sums[begin]) * back]
        for stem in self.stems:
            values.append((sums[np.minimum(begin + stem, end)] - sums[begin]) * back)
        if self.length and len(begin) and begin[0] == 0:
            shift = pow(BASE, self.length, 1 << 64)
            for k, limit in enumerate((int(lengths[0]) + self.length, *self.stems)):
                more = int(sums[max(0, min(limit - self.length, int(lengths[0])))])
                values[k][0] = (self.sums[k] + more * shift) % (1 << 64)
            lengths[0] += self.length
        elif self.length:
            values = [np.r_[np.uint64(s), v] for s, v in zip(self.sums, values)]
            lengths = np.r_[self.length, lengths]
        self.length = 0
        if not last and inside[-1]:
            self.length, self.sums = int(lengths[-1]), [int(v[-1]) for v in values]
            values = [v[:-1] for v in values]
        heads = [mixed(mixed(v) + np.uint64(stem)) for stem, v in zip(self.stems, values[1:])]
        return [mixed(values[0]), *heads]


def word_gram_parts(
    data: np.ndarray, gram: int, skip: int, stems: tuple[int, ...], bits: int
) -> Iterator[np.ndarray]:
    """The buckets that ``word_grams`` gives for one text, by the part in which a feature ends."""
    words, tail = _Words(stems), np.zeros(0, np.uint64)
    for part, last in _parts(data):
        lower = _WORD[part]
        found = words.take(lower, lower > 0, last)
        own = np.concatenate([tail, found[0]])
        for hashes, at in _chains(own, np.zeros(len(own), np.int8), gram, skip):
            found.append(hashes[at >= len(tail)])
        tail = own[max(0, len(own) - max(gram - 1, skip + 1)) :]
        yield (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def subword_gram_parts(data: np.ndarray, chars: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """The buckets that ``subword_grams`` gives for one text, by the part in which a feature ends."""
    shift = np.uint64(64 - bits)
    words, tail, rest = _Words(), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    for part, last in _parts(data):
        (own,) = words.take(part, ~_SPACE[part], last)
        yield (own >> shift).astype(np.int64)
        own = np.concatenate([tail, own])
        yield (_word_pairs(own) >> shift).astype(np.int64)
        tail = own[-1:]
        both = np.concatenate([rest, part])
        sums = prefix_sums(both)
        back = powers(_INVERSE, len(both))
        for n in chars:
            first, count = max(0, len(rest) - n + 1), max(0, len(both) - n + 1)
            gram = (sums[n + first :] - sums[first:count]) * back[first:count]
            yield (mixed(gram + np.uint64(n)) >> shift).astype(np.int64)
        rest = both[max(0, len(both) - max(chars, default=1) + 1) :]
