"""Periodic runs of words, found by a sparse dynamic program over the diagonals of a text.

Diagonal q holds the matches of words with those q places before. A run of period q is a stretch of
matches of at least q words (and of 12 - q, so that runs have 12), and what comes before and after it
doesn't match. Looked at word by word, a text of one repeated word would have as many matches as pairs of
places. So lags are dealt with in levels: for lags from 2b - 1 to 4b - 2, a stretch that is long enough
holds a whole block of b words that begins at a multiple of b. Only these blocks are looked up, among
earlier blocks of equal words at such lags. There are at most about twice as many such pairs as
words, at each of the log(n) levels, whatever the text, and next to none in prose: blocks that occur once
in their text are out of all later levels.

Blocks are gone through in order. Those in a row with the same lag lengthen an active diagonal; one that the
next block doesn't go on with ends there and is emitted if it can be long enough. Its ends, less than
a block away, are found by halving. Words are compared by hashes until then, and in full in what is
emitted.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import slices, texts
from strataflow.llm.features import mixed, prefix_sums, span_hash
from strataflow.llm.tokens import spread

#: Words of the shortest run, and copies of its period.
SHORTEST, COPIES = 12, 2
#: Words of the blocks of the first level.
BLOCK = 3
#: Bytes of text, pairs of blocks and words that are looked at together.
TEXT_PART, PAIRS, WORDS_PART = 1 << 20, 1 << 20, 1 << 16
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
Run = tuple[int, int, int]


def parts(text: bytes) -> Iterator[tuple[int, int]]:
    """Ends of parts of about TEXT_PART bytes that break where words do."""
    begin = 0
    while begin < len(text):
        gap = _WHITE.search(text, begin + TEXT_PART)
        end = gap.end() if gap else len(text)
        yield begin, end
        begin = end


def word_hashes(text: bytes) -> np.ndarray:
    """A number for each word, equal for equal words."""
    found = [np.zeros(0, np.int64)]
    for begin, end in parts(text):
        words = text[begin:end].split()
        found.append(np.fromiter(map(hash, words), np.int64, len(words)))
    return np.concatenate(found)


class Words:
    """The words of a text in a new order (None: as they are), sliced from it when asked for."""

    def __init__(self, text: bytes, order: np.ndarray | None):
        self.text, self.order, self.spans = text, order, None

    def _spans(self) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for begin, end in parts(self.text):
            inside = ~_SPACE[np.frombuffer(self.text, np.uint8, end - begin, begin)]
            edge = np.flatnonzero(np.diff(np.r_[False, inside, False])) + begin
            found.append(edge.reshape(-1, 2))
        both = np.concatenate(found)
        return both[:, 0], both[:, 1]

    def at(self, places: np.ndarray) -> list[bytes]:
        self.spans = self.spans or self._spans()
        chosen = places if self.order is None else self.order[places]
        begin, end = (x[chosen].tolist() for x in self.spans)
        return [self.text[a:b] for a, b in zip(begin, end)]

    def joined_hash(self, kept: np.ndarray | None) -> str:
        """sha256 of the kept words (None: all, in the text's order), joined by a space."""
        digest, gap = hashlib.sha256(), b""
        if kept is None:
            groups = (self.text[a:b].split() for a, b in parts(self.text))
        else:
            cuts = range(0, len(kept), WORDS_PART)
            groups = (self.at(kept[a : a + WORDS_PART]) for a in cuts)
        for words in groups:
            if words:
                digest.update(gap + b" ".join(words))
                gap = b" "
        return digest.hexdigest()

    def periodic(self, run: Run) -> bool:
        start, length, period = run
        for a in range(start, start + length - period, WORDS_PART):
            places = np.arange(a, min(a + WORDS_PART, start + length - period))
            if self.at(places) != self.at(places + period):
                return False
        return True

    def diagonal(self, lag: int, count: int) -> Iterator[Run]:
        """The runs on one diagonal, by comparing all words in full."""
        begin = None
        for a in range(lag, count, WORDS_PART):
            places = np.arange(a, min(a + WORDS_PART, count))
            for i, (x, y) in enumerate(zip(self.at(places), self.at(places - lag)), a):
                if x == y:
                    begin = i if begin is None else begin
                elif begin is not None:
                    if i - begin >= needed(lag):
                        yield begin - lag, i - begin + lag, lag
                    begin = None
        if begin is not None and count - begin >= needed(lag):
            yield begin - lag, count - begin + lag, lag


def needed(lag):
    """Matches on a diagonal that make a run."""
    return np.maximum(lag * (COPIES - 1), SHORTEST - lag)


class Diagonals:
    """Active lags with the block at which their matches began; each step is one block of words."""

    def __init__(self, block: int):
        self.block, self.active, self.place = block, {}, 0
        self.emitted: list[Run] = []

    def _end(self) -> None:
        """Emit what no block goes on with, if up to a block more at both ends would suffice."""
        for lag, first in self.active.items():
            if self.place - first + 3 * self.block - 2 >= needed(lag):
                self.emitted.append((lag, first, self.place + self.block))

    def step(self, place: int, lags: list[int]) -> None:
        if place != self.place + self.block:
            self._end()
            self.active = {}
        fresh = {lag: self.active.pop(lag, place) for lag in lags}
        self._end()
        self.active, self.place = fresh, place

    def close(self) -> np.ndarray:
        """(lag, first, end) of all diagonals."""
        self._end()
        self.active = {}
        return np.array(self.emitted, np.int64).reshape(-1, 3)


def common(sums: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words from x on (or back from x) equal those from y on; at most ``most``."""
    low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
    while (low < high).any():
        half = (low + high + 1) // 2
        if back:
            same = span_hash(sums, x - half, x) == span_hash(sums, y - half, y)
        else:
            same = span_hash(sums, x, x + half) == span_hash(sums, y, y + half)
        low, high = np.where(same, half, low), np.where(same, high, half - 1)
    return low


def stretches(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(start, length, lag) of all maximal repetitions of texts whose words have these keys.

    Texts are given by offsets; no two of them have a key in common. A repetition whose smallest period
    is another one is among them too.
    """
    sums, count = prefix_sums(keys), len(keys)
    sizes = np.diff(offsets)
    begin, stop = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    found, block, at = [np.zeros((0, 3), np.int64)], BLOCK, np.arange(count)
    while True:
        least, most = (1 if block == BLOCK else 2 * block - 1), 4 * block - 2
        at = at[(at + block <= stop[at]) & (stop[at] - begin[at] >= max(SHORTEST, 2 * least))]
        if not len(at):
            return np.concatenate(found)
        code = span_hash(sums, at, at + block)
        order = np.argsort(code, kind="stable")
        first = np.r_[True, code[order[1:]] != code[order[:-1]]]
        again = ~(first & np.r_[first[1:], True])
        at = at[order[again]]
        # Equal blocks are neighbours, in order of their places; the gap keeps groups apart.
        table = np.cumsum(first)[again] * (count + most + 1) + at
        asked = np.flatnonzero((at - begin[at]) % block == 0)
        asked = asked[np.argsort(at[asked], kind="stable")]
        low = np.searchsorted(table, table[asked] - most)
        pairs = np.searchsorted(table, table[asked] - least, "right") - low
        asked, low, pairs = asked[pairs > 0], low[pairs > 0], pairs[pairs > 0]
        diagonals, upto = Diagonals(block), np.cumsum(pairs)
        full = np.searchsorted(upto, np.arange(PAIRS, upto[-1] if len(upto) else 0, PAIRS))
        cuts = np.unique(np.r_[0, full, len(asked)])
        for a, b in zip(cuts[:-1], cuts[1:]):
            places = at[asked[a:b]]
            lags = np.repeat(places, pairs[a:b]) - at[spread(low[a:b], pairs[a:b])]
            rest = iter(lags.tolist())
            for place, many in zip(places.tolist(), pairs[a:b].tolist()):
                diagonals.step(place, list(islice(rest, many)))
        lag, x, end = diagonals.close().T
        if len(lag):
            room = np.minimum(block - 1, x - lag - begin[x])
            x = x - common(sums, x, x - lag, room, back=True)
            room = np.minimum(block - 1, stop[x] - end)
            end = end + common(sums, end, end - lag, room, back=False)
            enough = end - x >= needed(lag)
            found.append(np.stack([x - lag, end - x + lag, lag], axis=1)[enough])
        # A block of twice the size occurs again only where both its halves do.
        repeated = np.zeros(count + block, bool)
        repeated[at] = True
        at = np.sort(at[repeated[at + block]])
        block *= 2


def smallest(found: list[Run]) -> list[Run]:
    """One run for each stretch, with its smallest period, by start and period."""
    least: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        least[start, length] = min(period, least.get((start, length), period))
    return sorted(((s, n, p) for (s, n), p in least.items()), key=lambda run: (run[0], run[2]))


def rearranged(doc_id: int | None, count: int) -> np.ndarray | None:
    """For one id in ten, by its hash: the places whose words a text has instead of its own.

    From one place on the text goes on with copies of what begins there.
    """
    if doc_id is None or not count:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % count
    places = np.arange(count)
    places[a:] = a + np.arange(count - a) % (1 + (count - a) // (3 + g % 8))
    return places


def described(words: Words, count: int, found: list[Run]) -> tuple:
    """n_runs and what follows it in SCHEMA."""
    if not all(words.periodic(run) for run in found):
        lags = sorted({run[2] for run in found})
        found = [run for lag in lags for run in words.diagonal(lag, count)]
    runs = smallest(found)
    listed = hashlib.sha256()
    for run in runs:
        listed.update(b"%d,%d,%d\n" % run)
    if not runs:
        kept = None if words.order is None else np.arange(count)
        return 0, None, None, None, None, listed.hexdigest(), words.joined_hash(kept)
    change = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]))
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    exponent = 1000 * length // period
    return len(runs), start, length, period, exponent, listed.hexdigest(), words.joined_hash(kept)


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rearrange: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` with its periodic runs of words; see SCHEMA.

    A run is a stretch with smallest period q of at least 12 words and 2q, which no neighbouring word
    extends. ``collapsed_sha256`` is of the text with the first q words of each run only. The longest run is
    given, of equal ones the first, then that of the smaller period; four NULLs if there is none.
    With ``rearrange`` one text in ten, by the hash of its id, is first made periodic from one place on.

    A NULL text is empty; an empty one has no runs. Repeated rows and NULL ids (never rearranged) give a row
    each; other columns play no part; an empty table gives no rows. No row meets another, so there
    is no shuffle. A long text is read in parts, with some numbers held for each of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = part.column("doc_id").to_pylist()
            texts_, keys = [], []
            for number, (doc_id, text) in enumerate(zip(ids, part.column("text"))):
                text = text.as_buffer().to_pybytes()
                own = word_hashes(text)
                places = rearranged(doc_id, len(own)) if rearrange else None
                own = own if places is None else own[places]
                texts_.append(Words(text, places))
                # Equal for equal words of one text only.
                keys.append(mixed(own.view(np.uint64) ^ mixed(np.array([number + 1], np.uint64))))
            offsets = np.cumsum([0, *map(len, keys)])
            found = stretches(np.concatenate(keys), offsets)
            found = found[np.argsort(found[:, 0], kind="stable")]
            cut = np.searchsorted(found[:, 0], offsets)
            rows = []
            for number, words in enumerate(texts_):
                own = found[cut[number] : cut[number + 1]] - [offsets[number], 0, 0]
                rows.append(described(words, len(keys[number]), [tuple(r) for r in own.tolist()]))
            names = [name.split()[0] for name in SCHEMA.split(", ")]
            types = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.record_batch([part.column("doc_id"), *columns], names)

    return texts(docs, id_column, text_column).mapInArrow(run, SCHEMA)
