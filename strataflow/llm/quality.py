"""Quality: supervised subword embeddings, averaged per text, with a softmax output.

A text is the mean of learned vectors of its words, word pairs and character n-grams, all hashed to
buckets. Learning is plain stochastic gradient descent over a bounded sample. As the output layer is
linear in the mean, scoring needs one number per bucket: its vector times the difference
of the two output rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import lean, saved, slices
from strataflow.llm.features import in_parts, subword_gram_parts, subword_grams
from strataflow.llm.learn import SLICE, bounded, sample, scored, sigmoid
from strataflow.llm.tokens import text_bytes


@dataclass(frozen=True)
class Subwords:
    """``rows`` bounds the labelled texts that are learned from; ``bits`` the number of buckets."""

    rows: int = 8_000
    bits: int = 18
    chars: tuple[int, ...] = (2, 3, 4)
    size: int = 8
    rate: float = 10.0
    epochs: int = 3

    def features(self, data: np.ndarray, offsets: np.ndarray):
        """Groups of (buckets, numbers of their texts); those of one long text by its parts."""
        if not in_parts(offsets):
            yield from subword_grams(data, offsets, self.chars, self.bits)
            return
        for bucket in subword_gram_parts(data, self.chars, self.bits):
            yield bucket, np.zeros(len(bucket), np.int64)

    def counted(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text numbers and buckets in one number each, sorted, and how often they occur."""
        if in_parts(offsets):
            total = np.zeros(1 << self.bits, np.int64)
            for bucket, _ in self.features(data, offsets):
                total += np.bincount(bucket, minlength=len(total))
            pairs = np.flatnonzero(total)
            return pairs, total[pairs]
        groups = [owner << self.bits | bucket for bucket, owner in self.features(data, offsets)]
        return np.unique(np.concatenate(groups), return_counts=True)

    def learn(
        self, rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray
    ) -> tuple[np.ndarray, float]:
        """The number of each bucket and the intercept; a row has buckets and their shares."""
        chance = np.random.default_rng(0)
        vectors = (chance.random((1 << self.bits, self.size), np.float32) - 0.5) / self.size
        output, bias = np.zeros((2, self.size), np.float32), np.zeros(2, np.float32)
        step, steps = 0, max(1, self.epochs * len(rows))
        for _ in range(self.epochs):
            for k in chance.permutation(len(rows)).tolist():
                rate = np.float32(self.rate * (1 - step / steps))
                step += 1
                at, share = rows[k]
                own = vectors[at]
                mean = share @ own
                logits = output @ mean + bias
                error = np.exp(logits - logits.max())
                error /= error.sum()
                error[int(labels[k])] -= 1
                back = error @ output
                # Smaller steps for the output layer, which every text moves.
                output -= rate * np.float32(0.1) * np.outer(error, mean)
                bias -= rate * np.float32(0.01) * error
                vectors[at] = own - np.outer(share * rate, back)
        return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])

    def score(
        self, values: np.ndarray, bias: float, data: np.ndarray, offsets: np.ndarray
    ) -> np.ndarray:
        count = len(offsets) - 1
        total, number = np.zeros(count), np.zeros(count)
        for bucket, owner in self.features(data, offsets):
            total += np.bincount(owner, values[bucket], count)[:count]
            number += np.bincount(owner, minlength=count)[:count]
        return sigmoid(total / np.maximum(number, 1) + bias)


@dataclass
class Shares(Sequence):
    """Buckets of each text and their shares, which are worked out when asked for."""

    counts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        at, n = self.counts[k]
        return at, n.astype(np.float32) / np.float32(max(1, n.sum()))


def train(
    docs: DataFrame, labels: DataFrame, label: str, model: Subwords, id_column: str, text_column: str
) -> tuple[np.ndarray, float]:
    """The model, learned in one task from a bounded sample whose features all tasks extract."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            pairs, counts = model.counted(*text_bytes(part.column("text")))
            cut = pa.array(np.searchsorted(pairs >> model.bits, np.arange(part.num_rows + 1)), "i4")
            at = pa.ListArray.from_arrays(cut, pa.array(pairs & ((1 << model.bits) - 1), pa.int32()))
            of = pa.ListArray.from_arrays(cut, pa.array(counts, pa.int32()))
            yield pa.record_batch(
                [part.column("doc_id"), part.column("label"), at, of],
                ["doc_id", "label", "at", "n"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, given = Shares(), []
        for batch in batches:
            for at, n in zip(batch.column("at"), batch.column("n")):
                rows.counts.append((at.values.to_numpy(), n.values.to_numpy()))
            given += batch.column("label").to_pylist()
        values, bias = model.learn(rows, np.array(given, np.int64))
        yield pa.record_batch(
            [pa.array([values.astype("<f4").tobytes()]), pa.array([bias])], ["values", "bias"]
        )

    chosen = sample(docs, labels, label, model.rows, id_column, text_column)
    schema = "doc_id long, label int, at array<int>, n array<int>"
    features = bounded(saved(chosen.mapInArrow(lean(extract), schema), "quality-features"))
    one = features.repartition(1).sortWithinPartitions("doc_id", "at").select("label", "at", "n")
    found = saved(one.mapInArrow(lean(learn), "values binary, bias double"), "quality").collect()
    if not found:
        return np.zeros(1 << model.bits, np.float32), 0.0
    return np.frombuffer(found[0]["values"], "<f4"), found[0]["bias"]


def quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    model: Subwords = Subwords(),
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1: good).

    Only texts are looked at. A NULL or empty text has the score of the intercept; a NULL id is not
    held out and not learned from; repeated rows are scored each. Without usable labels every score
    is 0.5. An empty table gives no rows. A very long text is scored by its parts, to the same result.
    """
    values, bias = train(docs, labels, label, model, id_column, text_column)
    score = lambda data, offsets: model.score(values, bias, data, offsets)
    return scored(docs, score, threshold, "quality-scores", id_column, text_column)
