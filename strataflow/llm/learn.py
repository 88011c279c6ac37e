"""Labelled samples of a bounded size, and the scoring that both text models share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import held_out, lean, saved, slices, texts
from strataflow.llm.tokens import text_bytes

#: Bytes of all texts that a model learns from, so that its memory is bounded.
TRAIN_BYTES = 128 << 20
#: Their features, as the lists of numbers that the learning task holds.
TRAIN_FEATURES = 32 << 20
#: Bytes of text whose features a task has in memory at a time, some hundred times that.
SLICE = 1 << 20


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, id_column: str, text_column: str
) -> DataFrame:
    """``label`` (0 or 1) and text of at most ``rows`` labelled documents outside the held-out fold.

    They are taken in the order of a hash of the id, as long as their texts have at most TRAIN_BYTES in
    all; one that doesn't fit is passed over. Only labels of ids in ``docs`` play a part. Those that are
    NULL or no 0 or 1 are left out; of several labels of an id the largest counts, of several texts
    that with the smallest hash.
    """
    given = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
    )
    named = texts(docs, id_column, text_column).withColumn("hash", F.xxhash64("text"))
    # Numbers only; of equal hashes the texts are held to be equal.
    known = (
        named.select("doc_id", "hash", F.octet_length("text").cast("long").alias("bytes"))
        .groupBy("doc_id")
        .agg(F.min("hash").alias("hash"), F.min_by("bytes", "hash").alias("bytes"))
    )
    first = (
        given.join(known, "doc_id")
        .where(F.col("bytes") <= TRAIN_BYTES)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Four numbers for each of at most ``rows`` rows.
    chosen, room = [], TRAIN_BYTES
    for row in first.select("doc_id", "label", "hash", "bytes").collect():
        if row["bytes"] <= room:
            room -= row["bytes"]
            chosen.append((row["doc_id"], row["label"], row["hash"]))
    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int, hash long")
    return (
        named.join(F.broadcast(chosen), ["doc_id", "hash"])
        .groupBy("doc_id")
        .agg(F.first("label").alias("label"), F.first("text").alias("text"))
    )


def bounded(features: DataFrame) -> DataFrame:
    """Rows of at most TRAIN_FEATURES features (lists ``at``) in all, in the order of a hash of doc_id."""
    # Two numbers for each row of the sample.
    sizes = features.select("doc_id", F.size("at").cast("long").alias("n"))
    if (sizes.agg(F.sum("n")).first()[0] or 0) <= TRAIN_FEATURES:
        return features
    chosen, room = [], TRAIN_FEATURES
    for row in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if row["n"] <= room:
            room -= row["n"]
            chosen.append((row["doc_id"],))
    chosen = features.sparkSession.createDataFrame(chosen, "doc_id long")
    return features.join(F.broadcast(chosen), "doc_id", "left_semi")


def scored(
    docs: DataFrame,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    threshold: float,
    purpose: str,
    id_column: str,
    text_column: str,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``score`` takes bytes and text offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            values = score(*text_bytes(part.column("text")))
            yield pa.record_batch([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    rows = texts(docs, id_column, text_column).mapInArrow(lean(run), "doc_id long, score double")
    return saved(rows, purpose).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
