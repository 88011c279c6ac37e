"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

Each coordinate has its own learning rate, and an L1 penalty leaves most weights at zero, so that
the model is a few thousand weights that go to every task. A feature counts once in a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import lean, saved, slices
from strataflow.llm.features import in_parts, word_gram_parts, word_grams
from strataflow.llm.learn import SLICE, bounded, sample, scored, sigmoid
from strataflow.llm.tokens import text_bytes


@dataclass(frozen=True)
class Ftrl:
    """``rows`` bounds the labelled texts that are learned from; ``bits`` the number of buckets."""

    rows: int = 20_000
    bits: int = 20
    gram: int = 2
    skip: int = 1
    stems: tuple[int, ...] = (4, 5)
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.5
    epochs: int = 6

    def features(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of (buckets, numbers of their texts); those of one long text by its parts."""
        if not in_parts(offsets):
            yield word_grams(data, offsets, self.gram, self.skip, self.stems, self.bits)
            return
        for bucket in word_gram_parts(data, self.gram, self.skip, self.stems, self.bits):
            yield bucket, np.zeros(len(bucket), np.int64)

    def distinct(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Text numbers and buckets in one number each, sorted."""
        pairs = np.zeros(0, np.int64)
        for bucket, owner in self.features(data, offsets):
            pairs = np.union1d(pairs, owner << self.bits | bucket)
        return pairs

    def learn(self, rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights of all buckets and the intercept, from the distinct buckets of each text."""
        z, n = np.zeros((2, 1 << self.bits))
        # Without labels a text is held to be clean.
        bias = float(np.log((labels.sum() + 1) / ((1 - labels).sum() + 10)))
        seen = 0.0

        def weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
            w = (np.sign(z) * self.l1 - z) / ((self.beta + root) / self.alpha + self.l2)
            w[np.abs(z) <= self.l1] = 0
            return w

        order = np.random.default_rng(0)
        for _ in range(self.epochs):
            for k in order.permutation(len(rows)).tolist():
                at = rows[k]
                zk, nk = z[at], n[at]
                root = np.sqrt(nk)
                w = weights(zk, root)
                g = float(sigmoid(w.sum() + bias) - labels[k])
                z[at] = zk + g - (np.sqrt(nk + g * g) - root) / self.alpha * w
                n[at] = nk + g * g
                seen += g * g
                bias -= self.alpha / (self.beta + seen**0.5) * g
        return weights(z, np.sqrt(n)), bias

    def score(
        self, weights: np.ndarray, bias: float, data: np.ndarray, offsets: np.ndarray
    ) -> np.ndarray:
        count = len(offsets) - 1
        pairs = np.zeros(0, np.int64)
        for bucket, owner in self.features(data, offsets):
            counts = weights[bucket] != 0
            pairs = np.union1d(pairs, owner[counts] << self.bits | bucket[counts])
        own = weights[pairs & ((1 << self.bits) - 1)]
        return sigmoid(np.bincount(pairs >> self.bits, own, count)[:count] + bias)


def train(
    docs: DataFrame, labels: DataFrame, label: str, model: Ftrl, id_column: str, text_column: str
) -> tuple[np.ndarray, float]:
    """The model, learned in one task from a bounded sample whose features all tasks extract."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            pairs = model.distinct(*text_bytes(part.column("text")))
            cut = np.searchsorted(pairs >> model.bits, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(cut, pa.int32()), pa.array(pairs & ((1 << model.bits) - 1), pa.int32())
            )
            yield pa.record_batch(
                [part.column("doc_id"), part.column("label"), lists], ["doc_id", "label", "at"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, given = [], []
        for batch in batches:
            rows += [x.values.to_numpy() for x in batch.column("at")]
            given += batch.column("label").to_pylist()
        weights, bias = model.learn(rows, np.array(given, np.float64))
        found = np.flatnonzero(weights)
        yield pa.record_batch(
            [pa.array(np.r_[-1, found]), pa.array(np.r_[bias, weights[found]])], ["at", "weight"]
        )

    chosen = sample(docs, labels, label, model.rows, id_column, text_column)
    schema = "doc_id long, label int, at array<int>"
    features = bounded(saved(chosen.mapInArrow(lean(extract), schema), "toxic-features"))
    # One task, over a bounded number of rows in a fixed order.
    one = features.repartition(1).sortWithinPartitions("doc_id", "at").select("label", "at")
    weights, bias = np.zeros(1 << model.bits), 0.0
    for at, weight in saved(one.mapInArrow(lean(learn), "at long, weight double"), "toxic").collect():
        if at < 0:
            bias = weight
        else:
            weights[at] = weight
    if not features.take(1):
        bias = model.learn([], np.zeros(0))[1]
    return weights, bias


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    model: Ftrl = Ftrl(),
    threshold: float = 0.5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1: toxic).

    Only texts are looked at. A NULL or empty text has the score of the intercept; a NULL id is not
    held out and not learned from; repeated rows are scored each. Without usable labels every text
    is held to be clean. An empty table gives no rows. A very long text is scored by its parts, to the
    same result.
    """
    score = scorer(train(docs, labels, label, model, id_column, text_column), model)
    return scored(docs, score, threshold, "toxicity", id_column, text_column)


def scorer(trained: tuple[np.ndarray, float], model: Ftrl) -> Callable:
    """Scores texts given by bytes and offsets; only weights that are not zero go to the tasks."""
    weights, bias = trained
    found = np.flatnonzero(weights)
    values = weights[found]

    def score(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        full = np.zeros(1 << model.bits, np.float32)
        full[found] = values
        return model.score(full, bias, data, offsets)

    return score


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    model: Ftrl = Ftrl(),
    threshold: float = 0.5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``toxicity`` doesn't predict to be toxic."""
    score = scorer(train(docs, labels, label, model, id_column, text_column), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column, SLICE):
            values = score(*text_bytes(part.column(text_column).fill_null("")))
            yield part.filter(pa.array(values < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
