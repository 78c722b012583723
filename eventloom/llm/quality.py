"""Quality classifier: logistic regression on hashed word n-grams, trained by following the regularised leader.

Words are runs of letters, of digits or of other signs; upper and lower case differ, and a word that
repeats the one before it counts as REPEAT. One and two words in a row are hashed to ``2**BITS`` places. A text's value at a place is ``log(1 + count)``, scaled to unit
length; a score is the logistic function of its sparse dot product with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words
from eventloom.llm.shared import prepare

BITS = 18
REPEAT = np.uint64(0x5EED)
#: Labelled rows that the model is fitted on, at most: those with the smallest hash of their id.
FITTED_ROWS = 20_000
THRESHOLD = 0.3
#: Step, its damping, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 0.2
#: Texts shown to the model, about, over 2 to 20 rounds.
SHOWN = 40_000


def features(hashed: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one text's word hashes; the first place is the constant."""
    mask = np.uint64((1 << bits) - 1)
    hashed = np.where(np.append(False, hashed[1:] == hashed[:-1])[: len(hashed)], REPEAT, hashed)
    grams = np.concatenate([hashed & mask, words.ngrams(hashed, 2) & mask]).astype(np.int64)
    grams, counts = np.unique(grams, return_counts=True)
    values = np.log1p(counts)
    if len(values):
        values = values * (4 / np.sqrt((values * values).sum()))
    return np.concatenate([[1 << bits], grams]), np.concatenate([[1.0], values])


class Leader:
    """Per-coordinate FTRL-proximal; the penalties do not touch the constant."""

    def __init__(self, bits: int = BITS):
        size = (1 << bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = at == len(self.z) - 1
        step = (BETA + np.sqrt(n)) / ALPHA + np.where(free, 0.0, L2)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(free, 0.0, L1), 0)
        return -shrunk / step

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(float(w @ values)) - label) * values
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def logistic(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(x, -30.0), 30.0)))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = []
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for a, hashed, before in words.word_slices(batch.column("text"), words.RUNS, words.CASED):
            for k in range(len(before) - 1):
                at, values = features(hashed[before[k] : before[k + 1]])
                seen.append((at.astype(np.int32), values.astype(np.float32), labels[a + k]))
    model = Leader()
    for epoch in range(min(max(SHOWN // max(len(seen), 1), 2), 20)):
        for i in np.random.default_rng(epoch).permutation(len(seen)):
            at, values, label = seen[i]
            model.learn(at.astype(np.int64), values.astype(float), label)
    weights = model.weights(np.arange(len(model.z)))
    yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f4").tobytes()]})


def learnable(labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """``_id`` and ``_label`` of at most ``rows`` rows: those chosen by ``learn`` that have one label, in the order of a hash of their id."""
    known = labels.where(learn & labels["doc_id"].isNotNull() & labels[label].isin(0, 1))
    agreed = known.groupBy(known["doc_id"].cast("long").alias("_id")).agg(
        F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_most")
    )
    return agreed.where("_label = _most").select("_id", "_label").orderBy(F.xxhash64("_id"), "_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, *, label: str, learn: Column, rows: int = FITTED_ROWS) -> np.ndarray:
    """Weights of all places and of the constant, learned from at most ``rows`` labelled documents.

    ``learn`` chooses rows of ``labels``. Rows without an id or a label of 0 or 1, and ids with both labels, are left out.
    Without any labelled document all weights are 0.
    """
    prepare(docs.sparkSession)
    chosen = F.broadcast(learnable(labels, label, learn, rows))  # bounded by the number of rows
    sample = docs.select(docs["doc_id"].cast("long").alias("_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    sample = sample.join(chosen, "_id").select("_id", "text", F.col("_label").alias("label"))
    # one model sees all rows of the bounded sample, always in the same order
    sample = sample.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", "text").select("text", "label")
    trained = sample.mapInArrow(_train, "weights binary").collect()
    if not trained:
        return np.zeros((1 << BITS) + 1)
    return np.frombuffer(trained[0]["weights"], "<f4").astype(float)


def _score(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for _, hashed, before in words.word_slices(batch.column("text"), words.RUNS, words.CASED):
                for k in range(len(before) - 1):
                    at, values = features(hashed[before[k] : before[k + 1]])
                    scores.append(logistic(float(weights[at] @ values)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every document's whole text, from the text alone.

    Null text is an empty one; it scores by the constant alone. Every row of a repeated or null
    ``doc_id`` has a row. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(_score(weights), "doc_id long, score double")
