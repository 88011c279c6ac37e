"""Token ids of whole texts, looked up chunk by chunk.

A text is cut where cutting can't change its tokens. Each worker keeps the ids of the chunks that it
has met, up to a bound, and hands the others to the tokenizer in batches. Cutting, looking up and
putting together are array operations over the bytes of a slice of documents.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from strataflow.llm.common import SLICE_BYTES, slices

#: Chunks that a worker remembers (about 60 bytes each); beyond it starts anew.
REMEMBERED = 1_000_000
#: Longer chunks are looked up within a slice only.
SHORT = 15

Encoder = Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]

#: Bytes that start a character which is not white space: ASCII but for spaces and controls, and
#: lead bytes but for those of the blocks that hold white space.
_OPENS = np.array(
    [33 <= b < 127 or (0xC3 <= b < 0xF5 and b not in (0xE1, 0xE2, 0xE3)) for b in range(256)]
)
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
#: After a letter, any of these starts a match of its own in the patterns of both kinds.
_MARK = np.isin(np.arange(256), list(b".,:;!?#*%&$|"))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where chunks start: texts, single spaces before a word, and marks behind a letter."""
    start = np.zeros(len(data), bool)
    start[:-1] = (data[:-1] == 32) & _OPENS[data[1:]]
    start[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    start[begins[begins < len(data)]] = True
    return np.flatnonzero(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column without NULLs, and the offset of each text and of the end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of runs that are given by start and length, run after run."""
    ends = np.cumsum(lengths)
    return np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)


class ChunkTable:
    """Open addressing over keys of two words; numbers keys in the order of insertion."""

    def __init__(self, slots: int = 1 << 16):
        self.low, self.high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.number = np.full(slots, -1, np.int64)
        self.used = 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(len(self.low) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is unknown."""
        out, slot = np.full(len(low), -1), self._slot(low, high)
        left = np.arange(len(low))
        while len(left):
            number = self.number[slot]
            same = (self.low[slot] == low[left]) & (self.high[slot] == high[left]) & (number >= 0)
            out[left[same]] = number[same]
            go = ~same & (number >= 0)
            left, slot = left[go], (slot[go] + 1) & (len(self.low) - 1)
        return out

    def add(self, low: np.ndarray, high: np.ndarray) -> None:
        """Insert keys that are new and distinct."""
        if (self.used + len(low)) * 2 > len(self.low):
            held = self.number >= 0
            order = np.argsort(self.number[held])
            low = np.concatenate([self.low[held][order], low])
            high = np.concatenate([self.high[held][order], high])
            size = len(self.low)
            while len(low) * 2 > size:
                size *= 2
            self.__init__(size)
        numbers = np.arange(self.used, self.used + len(low))
        slot, left = self._slot(low, high), np.arange(len(low))
        while len(left):
            free = self.number[slot] < 0
            _, first = np.unique(slot, return_index=True)
            wins = np.zeros(len(left), bool)
            wins[first] = True
            wins &= free
            at, who = slot[wins], left[wins]
            self.low[at], self.high[at], self.number[at] = low[who], high[who], numbers[who]
            left, slot = left[~wins], (slot[~wins] + 1) & (len(self.low) - 1)
        self.used += len(low)


class ChunkIds:
    """Ids of texts; ``encode`` maps strings to all their ids and the count of each."""

    def __init__(self, encode: Encoder, remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self.forget()

    def forget(self) -> None:
        self.table = ChunkTable()
        self.ids, self.filled = np.zeros(1 << 16, np.int32), 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _keep(self, ids: np.ndarray, lengths: np.ndarray, first: int) -> None:
        while first + len(lengths) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        ends = self.filled + np.cumsum(lengths)
        self.starts[first : first + len(lengths)] = ends - lengths
        self.lengths[first : first + len(lengths)] = lengths
        self.filled += len(ids)

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if self.table.used > self.remembered:
            self.forget()
        data, offsets = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        begin = cuts(data, offsets[:-1])
        size = np.diff(np.r_[begin, len(data)])
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[: len(data)] = data
        words = np.ndarray((len(data) + 9,), np.dtype("<u8"), padded, 0, (1,))
        short = size <= SHORT
        at, n = begin[short], size[short]
        low = words[at] & _MASKS[np.minimum(n, 8)]
        high = words[at + 8] & _MASKS[np.maximum(n - 8, 0)] | n.astype(np.uint64) << np.uint64(56)
        number = self.table.find(low, high)
        new = np.flatnonzero(number < 0)
        string = data.tobytes()
        if len(new):
            order = new[np.lexsort((low[new], high[new]))]
            distinct = np.r_[
                True, (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            ]
            one, first = order[distinct], self.table.used
            chunks = [string[a : a + k].decode() for a, k in zip(at[one].tolist(), n[one].tolist())]
            self._keep(*self.encode(chunks), first)
            self.table.add(low[one], high[one])
            number[order] = first + np.cumsum(distinct) - 1
        asked = np.empty(len(begin), np.int64)
        asked[short] = number
        kept, first = self.filled, self.table.used
        if not short.all():
            seen: dict[bytes, int] = {}
            ends = begin + size
            asked[~short] = [
                seen.setdefault(string[a:b], first + len(seen))
                for a, b in zip(begin[~short].tolist(), ends[~short].tolist())
            ]
            self._keep(*self.encode([c.decode() for c in seen]), first)
        length = self.lengths[asked]
        ends = np.cumsum(length)
        ids = self.ids[spread(self.starts[asked], length)]
        self.filled = kept
        return ids, np.diff(np.r_[0, ends][np.searchsorted(begin, offsets)])


#: Strings that lower-casing and composing leave as long as they are.
_PLAIN = re.compile(r" [\x21-\x7e\xa1-\xff][\x00-\x7f\xa1-\xff]*")
_WHITE = {code: None for code in (9, 10, 11, 12, 13, 32)}


def library_encoder(path: str) -> Encoder:
    """The tokenizers library; strings of special tokens are ordinary text.

    Chunks that start with a space and a word can't influence each other: many go to it as one
    text, and the bytes that each token stands for tell which chunk it is of.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    drops_white = tokenizer.normalizer is not None
    vocabulary = tokenizer.get_vocab()
    width = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, number in vocabulary.items():  # in byte-level vocabularies a character is a byte
        width[number] = len(token.removesuffix("</w>") if drops_white else token)

    def ids_of(strings: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def encode(chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [k for k, c in enumerate(chunks) if _PLAIN.fullmatch(c)]
        groups = [plain[a : a + 256] for a in range(0, len(plain), 256)]
        found = ids_of(["".join([chunks[k] for k in g]) for g in groups])
        counts = []
        for group, ids in zip(groups, found):
            strings = [chunks[k].translate(_WHITE) if drops_white else chunks[k] for k in group]
            ends = np.cumsum([len(x.encode()) for x in strings])
            token_ends = np.cumsum(width[ids])
            cut = np.searchsorted(token_ends, ends) + 1
            if not np.array_equal(token_ends[cut - 1], ends):
                raise ValueError(f"{path}: tokens don't stand for the bytes of the text")
            counts.append(np.diff(np.r_[0, cut]))
        rest = np.setdiff1d(np.arange(len(chunks)), plain).tolist()
        others = ids_of([chunks[k] for k in rest])
        ids = np.concatenate([np.zeros(0, np.int32), *found, *others])
        given = np.concatenate([np.zeros(0, np.int64), *counts, list(map(len, others))])
        # Back to the order of the chunks.
        lengths, starts = np.zeros((2, len(chunks)), np.int64)
        order = np.array([*plain, *rest], np.int64)
        lengths[order], starts[order] = given, np.cumsum(given) - given
        return ids[spread(starts, lengths)], lengths

    return encode


_READY: dict[tuple, ChunkIds] = {}


def chunk_ids(key: tuple, make: Callable[[], Encoder]) -> ChunkIds:
    """One memory of chunks for each worker process and tokenizer; its tasks share it."""
    if key not in _READY:
        _READY[key] = ChunkIds(make())
    return _READY[key]


def encoded(
    batches: Iterator[pa.RecordBatch], ids: ChunkIds, size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of documents, the ids of all their texts, and the count of each."""
    for part in slices(batches, "text", size):
        yield part, *ids.of(part.column("text"))
