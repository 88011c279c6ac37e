"""Token ids as compressed binary blocks: a static range asymmetric numeral system.

Format, all little-endian. A block holds the ids of whole documents and can be read alone:

    magic "RANS", u32 version, u32 table check, u32 ids, u32 lanes, u32 steps between checkpoints,
    u32 checkpoints, u32 words, u32 crc32 of the ids as u32,
    checkpoints x (u32 index of the first word, lanes x u64 states),
    words x u32

Id ``i`` belongs to lane ``i % lanes``; each lane is a coder of its own with a 64-bit state that
takes in or gives out 32-bit words. All blocks share one table of frequencies, counted over the whole
corpus and scaled to 2**SCALE. A checkpoint has what decoding needs to start at its step.
A folder of token files has a Parquet table of such blocks, with the ids and lengths of the documents in
each, and one of a single row with the frequencies; a reader needs nothing else.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import BATCH_ROWS, saved, ship, texts
from strataflow.llm.tokens import chunk_ids, encoded, library_encoder
from strataflow.session import scratch_dir, session_conf

SCALE = 20
LANES = 1024
STEPS = 128
BLOCK_IDS = 1 << 18
BLOCKS = (
    "part long, block long, first long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "payload binary"
)
_HEAD = struct.Struct("<4s9I")
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class CorruptBlock(ValueError):
    """A block whose header, table or checksum doesn't fit."""


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 for every id of the vocabulary."""
    total, room = max(1, int(counts.sum())), (1 << SCALE) - len(counts)
    if room < 0:
        raise ValueError(f"more than {1 << SCALE} ids")
    found = counts.astype(np.int64) * room // total + 1
    found[int(np.argmax(counts))] += (1 << SCALE) - int(found.sum())
    return found


class Coder:
    """Encodes and decodes blocks by one table of frequencies."""

    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.first = (np.cumsum(frequencies) - frequencies).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        self.check = zlib.crc32(frequencies.astype("<u4").tobytes())

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = STEPS) -> bytes:
        n = len(ids)
        steps = -(-n // lanes)
        state = np.full(lanes, _LOW)
        words: list[np.ndarray] = []
        points: list[tuple[int, bytes]] = []
        given = 0
        for step in range(steps - 1, -1, -1):
            own = ids[step * lanes : (step + 1) * lanes]
            f, x = self.frequency[own], state[: len(own)]
            full = x >= f << np.uint64(63 - SCALE)
            if full.any():
                words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                given += len(words[-1])
                x = np.where(full, x >> _WORD, x)
            q = x // f
            state[: len(own)] = (q << np.uint64(SCALE)) + (x - q * f) + self.first[own]
            if step % every == 0:
                points.append((given, state.astype("<u8").tobytes()))
        body = b"".join(w.tobytes() for w in reversed(words))
        points.reverse()
        rest = b"".join(struct.pack("<I", given - at) + states for at, states in points) + body
        fields = (
            b"RANS", 1, self.check, n, lanes, every, len(points), given,
            zlib.crc32(ids.astype("<u4").tobytes()),
        )
        whole = zlib.crc32(rest, zlib.crc32(_HEAD.pack(*fields, 0)))
        return _HEAD.pack(*fields, whole) + rest

    def _head(self, block: bytes) -> tuple[int, ...]:
        if len(block) < _HEAD.size:
            raise CorruptBlock("too short")
        magic, version, check, *rest = _HEAD.unpack_from(block)
        n, lanes, every, points, words, crc, _ = rest
        if magic != b"RANS" or version != 1 or check != self.check or not lanes or not every:
            raise CorruptBlock("not a block of this table")
        if len(block) != _HEAD.size + points * (4 + 8 * lanes) + 4 * words:
            raise CorruptBlock("wrong length")
        if points != -(-n // (lanes * every)):
            raise CorruptBlock("wrong number of checkpoints")
        return n, lanes, every, points, words, crc

    def decode_from(self, block: bytes, point: int) -> np.ndarray:
        """The ids from one checkpoint to the next, without those before."""
        n, lanes, every, points, words, _ = self._head(block)
        entry = _HEAD.size + point * (4 + 8 * lanes)
        (at,) = struct.unpack_from("<I", block, entry)
        state = np.frombuffer(block, "<u8", lanes, entry + 4).astype(np.uint64)
        body = np.frombuffer(block, "<u4", words, len(block) - 4 * words)
        begin = point * every * lanes
        out = np.empty(min(n - begin, every * lanes), np.int64)
        mask = np.uint64((1 << SCALE) - 1)
        for place in range(0, len(out), lanes):
            x = state[: min(lanes, len(out) - place)]
            slot = x & mask
            own = self.symbol[slot]
            out[place : place + len(x)] = own
            x = self.frequency[own] * (x >> np.uint64(SCALE)) + slot - self.first[own]
            low = x < _LOW
            taken = int(low.sum())
            if taken:
                more = body[at : at + taken]
                if len(more) < taken:
                    raise CorruptBlock("words are missing")
                x[low] = x[low] << _WORD | more
                at += taken
            state[: len(x)] = x
        return out

    def decode(self, block: bytes) -> np.ndarray:
        """All ids of a block, which is checked as a whole."""
        n, _, _, points, _, crc = self._head(block)
        *fields, whole = _HEAD.unpack_from(block)
        rest = memoryview(block)[_HEAD.size :]
        if zlib.crc32(rest, zlib.crc32(_HEAD.pack(*fields, 0))) != whole:
            raise CorruptBlock("damaged")
        parts = [self.decode_from(block, k) for k in range(points)]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if len(ids) != n or zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise CorruptBlock("wrong checksum")
        return ids


def tokenized(docs: DataFrame, path: str, end_id: int, vocabulary: int) -> DataFrame:
    """doc_id, n, ids (binary, two or four bytes each) of every text, the end id included."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_ids(("library", path), lambda: library_encoder(path))
        end = np.array([end_id], kind).tobytes()
        for part, ids, counts in encoded(batches, chunks):
            raw, size = ids.astype(kind).tobytes(), int(kind[-1])
            ends = (np.cumsum(counts) * size).tolist()
            own = [raw[a:b] + end for a, b in zip([0, *ends], ends)]
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(counts + 1, pa.int64()), pa.array(own, pa.binary())],
                ["doc_id", "n", "ids"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, ids binary")


def frequencies(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """Counts of all ids of the corpus: one row per id and task, then one per id."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for own in batch.column("ids"):
                counts += np.bincount(np.frombuffer(own.as_buffer(), kind), minlength=vocabulary)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(found), pa.array(counts[found])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n"))
    counts = np.zeros(vocabulary, np.int64)
    for token, n in rows.collect():  # at most one row per id of the vocabulary
        counts[token] = n
    return counts


def write_token_files(
    docs: DataFrame,
    path: str,
    end_id: int,
    vocabulary: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Writes the token files of ``docs`` and gives their folder, which holds all that a reader needs.

    ``blocks`` is a table in ascending order of id, ``table`` the frequencies that its blocks are coded by,
    with a checksum. Columns of blocks: part, block, first (ids before it in its part), n_ids, doc_ids, lengths, payload. Parts
    and blocks ascend with the ids of documents; NULL ids come first; repeated ids lie together. A
    NULL or empty text has the end id only. A block ends with a document, so a very long text makes
    one long block (with its checkpoints). An empty table makes no blocks.
    """
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    ids = saved(tokenized(texts(docs, id_column, text_column), path, end_id, vocabulary), "ids")
    table = scaled(frequencies(ids, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        waiting: list[tuple] = []
        held = first = block = part = 0

        def done() -> pa.RecordBatch:
            own = np.concatenate([np.frombuffer(x, kind) for _, _, x in waiting]).astype(np.int64)
            columns = {
                "part": [part], "block": [block], "first": [first], "n_ids": [len(own)],
                "doc_ids": [[d for d, _, _ in waiting]], "lengths": [[n for _, n, _ in waiting]],
                "payload": [coder.encode(own)],
            }
            return pa.RecordBatch.from_pydict(columns, schema)

        for batch in batches:
            for row in range(batch.num_rows):
                doc, n, own, part = (batch.column(k)[row].as_py() for k in range(4))
                if held and held + n > BLOCK_IDS:
                    yield done()
                    first, block, waiting, held = first + held, block + 1, [], 0
                waiting.append((doc, n, own))
                held += n
        if waiting:
            yield done()

    schema = pa.schema(
        [("part", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
         ("payload", pa.binary())]
    )
    # A repeated id is spread by its tokens' hash.
    ordered = (
        ids.withColumn("h", F.xxhash64("ids"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "n", "ids", F.spark_partition_id().cast("long").alias("part"))
    )
    blocks = ordered.mapInArrow(run, BLOCKS)
    folder = scratch_dir(docs.sparkSession, "token-files")
    with session_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        blocks.write.option("compression", "zstd").parquet(f"{folder}/blocks")
    raw = table.astype("<i8").tobytes()
    one = docs.sparkSession.createDataFrame([(raw, zlib.crc32(raw))], "frequencies binary, crc32 long")
    one.coalesce(1).write.parquet(f"{folder}/table")
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Decodes every block of a folder of token files: doc_id, start, n_tokens, ids_crc32.

    Nothing but the folder is needed. A broken table or block raises an error.
    """
    ship(spark)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    raw, crc = spark.read.parquet(f"{folder}/table").select("frequencies", "crc32").first()
    if zlib.crc32(raw) != crc:
        raise CorruptBlock("the frequency table is damaged")
    table = np.frombuffer(raw, "<i8").astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.decode(row["payload"])
                counts = np.array(row["lengths"], np.int64)
                if counts.sum() != len(ids):
                    raise CorruptBlock("lengths of documents don't fit")
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - counts, ends)]
                yield pa.record_batch(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(np.full(len(counts), row["part"])),
                        pa.array(row["first"] + ends - counts),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "part", "inner", "n_tokens", "ids_crc32"],
                )

    found = saved(
        blocks.select("part", "first", "doc_ids", "lengths", "payload").mapInArrow(
            run, "doc_id long, part long, inner long, n_tokens long, ids_crc32 long"
        ),
        "decoded",
        {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"},
    )
    # One row per part: as many as the range partitioning has partitions.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return found.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )
