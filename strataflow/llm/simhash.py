"""Near duplicates by SimHash fingerprints and multi-index hashing.

Of two fingerprints of 64 bits that differ in at most 4, either the upper halves differ in at most 2
or the lower in at most 1. So each distinct fingerprint is put into a table at every key within one
bit of each half; two upper halves that differ in 2 bits meet at the key between them. What meets
under a key is verified over all 64 bits and joined to a star, never listed as pairs.
A key with more fingerprints than one task should compare is dealt with by points: two
fingerprints are within 4 bits if and only if a point is within 2 bits of both, so links to the points
around each do, and their number is in proportion to the fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import lean, one_of_each, saved, slices, texts
from strataflow.llm.graph import components

#: Fingerprints under one key that a task compares with each other.
COMPARED = 8_192
LINKED_BITS = 4
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20
_HALF = np.uint64(0xFFFFFFFF)
_ONES = np.uint64(1) << np.arange(32, dtype=np.uint64)


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks that end where words do."""
    begin = 0
    while len(text) - begin > _BLOCK:
        gap = _WHITE.search(text, begin + _BLOCK)
        end = gap.end() if gap else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is set if it is set in more than half of the hashes of all shingles."""
    ones, total = np.zeros(64, np.int64), 0
    words: list[bytes] = []
    for block in _blocks(text):
        words += block.translate(_LOWER).split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [
            xxhash.xxh64_intdigest(joined[a : b - 1], 42)
            for a, b in zip(starts, ends[shingle - 1 :])
        ]
        ones += _ones(hashes)
        total += len(hashes)
        words = words[len(words) - shingle + 1 :]
    if not total and words:
        ones, total = _ones([xxhash.xxh64_intdigest(b" ".join(words), 42)]), 1
    return sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist())


def _ones(hashes: list[int]) -> np.ndarray:
    """How many hashes have each bit set."""
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash and fingerprint (as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in part.column("text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch(
                [part.column("doc_id"), part.column("text_hash"), pa.array(signed)],
                ["doc_id", "text_hash", "fp"],
            )

    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(lean(run), "doc_id long, text_hash long, fp long")


def table_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for every key within one bit of either half; bit 32 tells the half."""
    upper, lower = fp >> np.uint64(32), fp & _HALF
    keys = [upper, lower | np.uint64(1 << 32)]
    keys += [upper ^ bit for bit in _ONES] + [lower ^ bit | np.uint64(1 << 32) for bit in _ONES]
    return np.concatenate(keys), np.tile(fp, len(keys))


def near(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Index groups of fingerprints connected by links of at most ``bits``; only of two or more."""
    left, groups = np.arange(len(values)), []
    while len(left):
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for one in values[front[:64]]:
                reached |= np.bitwise_count(values[left] ^ one) <= bits
            front = np.concatenate([front[64:], left[reached]])
            group.append(left[reached])
            left = left[~reached]
        if len(group := np.concatenate(group)) > 1:
            groups.append(group)
    return groups


def _links(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of linked fingerprints under each of the sorted keys."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    begin, end = np.r_[0, cuts], np.r_[cuts, len(keys)]
    two = begin[end - begin == 2]
    linked = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= bits]
    u, v = [fps[linked]], [fps[linked + 1]]
    for a, b in zip(begin[end - begin > 2].tolist(), end[end - begin > 2].tolist()):
        own = np.unique(fps[a:b])
        for group in near(own, bits):
            u.append(own[group])
            v.append(np.full(len(group), own[group].min()))
    return np.concatenate(u), np.concatenate(v)


def star_links(table: DataFrame, bits: int, compared: int) -> DataFrame:
    """(busy, u, v) from sorted (key, fp): links u - v, or for a busy key v all its fingerprints u."""

    def out(u: np.ndarray, v: np.ndarray, busy: bool) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(u), busy)), *(pa.array(x.view(np.int64)) for x in (u, v))]
        return pa.record_batch(columns, ["busy", "u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros((2, 0), np.uint64)
        busy = None
        for batch in batches:
            more = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            keys, fps = (np.concatenate(x) for x in zip((keys, fps), more))
            if busy is not None:
                own = int(np.searchsorted(keys, busy, "right"))
                yield out(fps[:own], keys[:own], True)
                keys, fps = keys[own:], fps[own:]
            if not len(keys):
                continue
            # The last key may go on in the next batch.
            last = int(np.searchsorted(keys, keys[-1]))
            busy = keys[-1] if len(keys) - last > compared else None
            if last:
                yield from settle(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
            if busy is not None:
                yield out(fps, keys, True)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from settle(keys, fps)

    def settle(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        size = np.diff(np.r_[0, cuts, len(keys)])
        many = np.repeat(size > compared, size)
        if many.any():
            yield out(fps[many], keys[many], True)
            keys, fps = keys[~many], fps[~many]
        if len(keys):
            yield out(*_links(keys, fps, bits), False)

    # Sorted as unsigned numbers are: keys have 33 bits.
    sorted_rows = table.repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(lean(run), "busy boolean, u long, v long")


def point_links(busy: DataFrame) -> DataFrame:
    """(u, v): fingerprints under a busy key and all points within 2 bits that have the key's half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [a ^ b for k, a in enumerate(_ONES) for b in _ONES[k + 1 :]]
        for batch in batches:
            fps, keys = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            for fp, key in zip(fps, keys):
                in_lower, half = bool(key >> np.uint64(32)), key & _HALF
                own, other = fp & _HALF, fp >> np.uint64(32)
                own, other = (own, other) if in_lower else (other, own)
                flips = [np.zeros(1, np.uint64), _ONES]
                if own == half:
                    flips.append(np.array(pairs, np.uint64))
                around = other ^ np.concatenate(flips)
                points = (
                    around << np.uint64(32) | half if in_lower else half << np.uint64(32) | around
                )
                u = np.full(len(points), fp).view(np.int64)
                yield pa.record_batch([pa.array(u), pa.array(points.view(np.int64))], ["u", "v"])

    links = busy.select("u", "v").mapInArrow(lean(run), "u long, v long").distinct()
    # A point that one fingerprint reaches alone links nothing.
    shared = links.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v")
    return links.join(shared, "v", "left_semi").select("u", "v")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = LINKED_BITS,
    compared: int = COMPARED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, text_hash.

    Fingerprints that differ in at most ``bits`` (0 to 4) bits are linked, and the component's id is the
    smallest doc_id that can be reached. Texts without words (NULL, empty, white space) have
    fingerprint zero and are linked like others. A NULL id is larger than any other: a
    component of NULL ids only has component_id NULL. Repeated rows have equal results; an empty
    table gives no rows.
    """
    rows = linked(docs, F.col("doc_id"), shingle, bits, compared, id_column, text_column)
    return rows.select(
        "doc_id",
        hex16(F.col("fp")).alias("fingerprint"),
        F.col("least").alias("component_id"),
        "text_hash",
    )


def linked(
    docs: DataFrame,
    value: Column,
    shingle: int = 4,
    bits: int = LINKED_BITS,
    compared: int = COMPARED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, text_hash, fp of every row, and the least ``value`` (made of these) in its component."""
    if not 0 <= bits <= LINKED_BITS:
        raise ValueError(f"bits must be 0 to {LINKED_BITS}")
    rows = saved(fingerprints(texts(docs, id_column, text_column), shingle), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min(value).alias("least")), "distinct")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = table_keys(batch.column(0).to_numpy().view(np.uint64))
            columns = [pa.array(x.view(np.int64)) for x in (keys, fps)]
            yield pa.record_batch(columns, ["key", "fp"])

    table = distinct.select("fp").repartition("fp").mapInArrow(lean(expand), "key long, fp long")
    large = {"spark.sql.execution.arrow.maxRecordsPerBatch": "65536"}
    met = saved(star_links(table, bits, compared), "met", large)
    links = met.where("not busy").select("u", "v")
    busy = met.where("busy")
    if bits == LINKED_BITS:
        links = links.unionAll(point_links(busy))
    elif busy.take(1):
        raise ValueError("busy keys are settled for 4 bits only")
    roots = components(links)
    # The least value of each component, and of each fingerprint that has links.
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = member.groupBy("root").agg(F.min("least").alias("of_all"))
    settled = member.join(least, "root").select("fp", "of_all")
    own = distinct.join(settled, "fp", "left").select("fp", F.coalesce("of_all", "least").alias("least"))
    return rows.join(own, "fp").select("doc_id", "text_hash", "fp", "least")


def without_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **parameters: int
) -> DataFrame:
    """One row of each component, all columns as they are.

    It is of the smallest id, and of that the text of the smallest hash; of equal rows one stays, as
    does one of a component in which no row has an id.
    """
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    rows = linked(docs, first, id_column=id_column, text_column=text_column, **parameters)
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (
        F.col("text_hash") == F.col("least.text_hash")
    )
    keys = rows.groupBy("doc_id", F.col("text_hash").alias("text_key"), kept.alias("kept")).count()
    return one_of_each(
        docs,
        F.col(id_column).cast("long"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))),
        keys.where("not kept or count > 1"),
    )


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")
