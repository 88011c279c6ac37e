"""Documents packed into sequences of a fixed number of tokens, as few as can be.

Texts are tokenized once; what is packed are rows of a few numbers. They are dealt evenly to groups of
a bounded size, each packed in one task: best fit in descending order, then a local search that
exchanges one piece for one, two for one, or moves one, always from a less full sequence to a fuller
one, so that the sum of squared fills grows until sequences empty. A group leaves about one
sequence partly filled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import lean, saved, texts
from strataflow.llm.tokens import chunk_ids, encoded, library_encoder

#: Pieces that one task packs.
GROUP = 32_768


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence of each piece, longest first into the fullest sequence that still has room."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = used = 0
    found = np.zeros(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        fits = mask >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, chosen, used = capacity, used, used + 1
        found[k] = chosen
        if room > length:
            rooms[room - length].append(chosen)
            mask |= 1 << (room - length)
    return found


def _reach(
    sums: np.ndarray, theirs: np.ndarray, room: np.ndarray, over: np.ndarray
) -> tuple[int, int, int]:
    """The best exchange of one of ``sums`` (ascending) for one of ``theirs``: value, which sum, which of theirs.

    A sequence gains the sum less its own piece, at most its room. The growth of squared fills rises with the
    gain, so the largest sum that fits is the best for each of ``theirs``.
    """
    if not len(sums) or not len(theirs):
        return 0, -1, -1
    at = np.searchsorted(sums, theirs + room, side="right") - 1
    gain = np.where(at >= 0, sums[np.maximum(at, 0)] - theirs, 0)
    value = np.where(gain > 0, 2 * gain * (over + gain), 0)
    k = int(np.argmax(value))
    return int(value[k]), int(at[k]), k


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Local search from a packing; never more sequences than before, often fewer.

    Every underfull sequence is tried as a source, the least full first, until no source has an improving
    exchange or the sequences are as few as their tokens allow. A source that failed is only compared
    with sequences that have changed since.
    """
    lengths, bins = lengths.astype(np.int64), bins.copy()
    if not len(bins):
        return bins
    fill = np.bincount(bins, lengths).astype(np.int64)
    fewest, used = -(-int(lengths.sum()) // capacity), int((fill > 0).sum())
    changed, tried, clock = np.ones(len(fill), np.int64), np.zeros(len(fill), np.int64), 1
    moved = True
    while moved and used > fewest:
        moved = False
        sources = np.flatnonzero((fill > 0) & (fill < capacity))
        for source in sources[np.argsort(fill[sources], kind="stable")].tolist():
            while 0 < fill[source] < capacity and used > fewest:
                since = 0 if changed[source] > tried[source] else tried[source]
                usable = (changed > since) & (fill < capacity) & (fill >= fill[source])
                usable[source] = False
                targets = np.flatnonzero(usable)
                if not len(targets):
                    break
                own = np.flatnonzero(bins == source)
                own = own[np.argsort(lengths[own], kind="stable")]
                partner = np.flatnonzero(usable[bins])
                # One piece for one, or into free room.
                singles, first = np.unique(lengths[own], return_index=True)
                theirs = np.r_[lengths[partner], np.zeros(len(targets), np.int64)]
                at = np.r_[bins[partner], targets]
                room, over = capacity - fill[at], fill[at] - fill[source]
                one = _reach(singles, theirs, room, over)
                # Two for one. Of pieces of one length two are enough.
                few = own[np.r_[[True] * min(2, len(own)), lengths[own[2:]] != lengths[own[:-2]]]]
                left, right = np.triu_indices(len(few), 1)
                pairs, which = np.unique(lengths[few[left]] + lengths[few[right]], return_index=True)
                n = len(partner)
                two = _reach(pairs, theirs[:n], room[:n], over[:n])
                value, k, to = max(one, two)
                if not value:
                    break
                given = [own[first[k]]] if one >= two else [few[left[which[k]]], few[right[which[k]]]]
                target, gain = int(at[to]), int(lengths[given].sum() - theirs[to])
                bins[given] = target
                if to < n:
                    bins[partner[to]] = source
                fill[target] += gain
                fill[source] -= gain
                used -= int(fill[source] == 0)
                clock += 1
                changed[[source, target]] = clock
                moved = True
            tried[source] = clock
    return bins


def pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the ids of every text, cut at ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_ids(("library", path), lambda: library_encoder(path))
        end = np.array([end_id], "<u4").tobytes()
        for part, ids, counts in encoded(batches, chunks):
            raw = ids.astype("<u4").tobytes()
            rows: list[tuple[int, int, int, int, int]] = []
            begin = 0
            for doc, count in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                own = memoryview(raw[4 * begin : 4 * (begin + count)] + end)
                begin += count
                for k, start in enumerate(range(0, count + 1, capacity)):
                    cut = own[4 * start : 4 * (start + capacity)]
                    rows.append((doc, k, start, len(cut) // 4, zlib.crc32(cut)))
            yield pa.record_batch(
                [pa.array(column, pa.int64()) for column in zip(*rows)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(
        lean(run), "doc_id long, piece long, start long, length long, ids_crc32 long"
    )


def packed(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int = 4096,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A NULL or empty text is its end id alone. Only a text of more than ``capacity`` ids is cut. Ids
    may be NULL or repeated: each row is packed for itself. An empty table gives no rows.
    """
    cut = saved(pieces(texts(docs, id_column, text_column), path, end_id, capacity), "pieces")
    groups = max(1, -(-cut.count() // group))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins = improve(lengths, best_fit(lengths, capacity), capacity)
        order = np.argsort(bins, kind="stable")
        rows, bins, lengths = rows.iloc[order], bins[order], lengths[order]
        before = np.cumsum(lengths) - lengths
        first = np.r_[True, bins[1:] != bins[:-1]]
        offset = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(bins)]))
        return rows.assign(sequence_id=(rows["part"].to_numpy() << 32) + bins, offset=offset)[names]

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    # A running number within a partition, from a start that differs between partitions: short ones
    # would else all begin with the same groups.
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = cut.withColumn("part", F.pmod(nth + F.hash(F.spark_partition_id()), F.lit(groups)))
    return saved(
        dealt.groupBy("part")
        .applyInPandas(
            pack,
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
            "offset long",
        ),
        "packed",
    )
