"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (runs of letters, lower-cased), their beginnings of four to seven letters, and that at least
two, three or four different words of a text share such a beginning. The terms that go with the label (``phi`` of LEAST_PHI or more, beyond chance) are chosen on a bounded sample of
labelled rows; their document frequencies are counted over all documents. Examples are kept in blocks.
For each term and block the index holds the largest weight, so that the bound of a block is one small
product; blocks are scored in the order of their bounds until none can hold a nearer example.

A score is the neighbours' vote, each weighted by its distance, drawn towards the rate among rows
without any term; how strongly is fitted on the sample, each row without itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.quality import learnable
from eventloom.llm.shared import prepare, written

#: Labelled rows that terms are chosen on, and examples of each label in the index, at most.
FITTED_ROWS = 20_000
EXAMPLES = 2_000
#: Terms, at most: those that go with the label most closely.
TERMS = 20_000
LEAST_PHI = 0.1
#: Twice the log-likelihood ratio of term and label against chance, at least.
LEAST_RATIO = 20.0
BLOCK = 64
NEIGHBOURS = 15
#: Added to a distance before it divides the vote.
NEAR = 0.1
THRESHOLD = 0.7
EVIDENCE = 3
_PULLS = (0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0)
_REMEMBERED = 200_000

SCORES = "doc_id long, score double, evidence array<struct<doc_id: long, label: int, similarity: double>>"
_words = re.compile(r"[^\W\d_]+").findall


def beginnings(word: str) -> list[str]:
    return [word[:n] + "~" for n in (4, 5, 6, 7) if len(word) > n]


def levels(beginning: str, words: int) -> list[str]:
    """The terms of a beginning that so many different words share."""
    return [beginning] + [beginning + str(n) for n in (2, 3, 4) if words >= n]


def all_terms(text: str) -> set[str]:
    words = set(_words(text.lower()))
    shared = Counter(b for w in words for b in beginnings(w))
    return words.union(*(levels(b, n) for b, n in shared.items()))


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label hold each term, per batch; the empty term counts the texts."""
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            counts[label].update(all_terms(text) | {""})
        terms = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict(
            {
                "term": terms,
                "clean": pa.array([counts[0][t] for t in terms], pa.int64()),
                "toxic": pa.array([counts[1][t] for t in terms], pa.int64()),
            }
        )


class Vocabulary:
    """Finds the chosen terms of a text."""

    def __init__(self, terms: list[str]):
        self.place = {t: i for i, t in enumerate(terms)}
        self.begin = {t[: t.index("~") + 1] for t in terms if "~" in t}
        self.known: dict[str, tuple[int | None, tuple[str, ...]]] = {}

    def _look(self, word: str) -> tuple[int | None, tuple[str, ...]]:
        return self.place.get(word), tuple(b for b in beginnings(word) if b in self.begin)

    def __call__(self, text: str) -> dict[int, int]:
        """Term numbers and how often the text has them; a beginning counts once."""
        found: dict[int, int] = {}
        shared: dict[str, int] = {}
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for word, n in Counter(_words(text.lower())).items():
            terms = known.get(word)
            if terms is None:
                terms = known[word] = self._look(word)
            if terms[0] is not None:
                found[terms[0]] = n
            for b in terms[1]:
                shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            found.update((self.place[t], 1) for t in levels(b, n) if t in self.place)
        return found


def _frequencies(terms: list[str]):
    """Documents that hold each term, and under -1 all documents, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = Vocabulary(terms), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total.update(find(text).keys())
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())}
        )

    return run


@dataclass
class Index:
    """Unit vectors of the examples, as postings by term and block."""

    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    #: Of each term and block: where its postings begin; the largest weight among them.
    begins: np.ndarray
    largest: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    base: float = 0.0
    pull: float = 1.0

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(sorted(counts), np.int64)
        values = np.array([1 + np.log(counts[t]) for t in at.tolist()]) * self.idf[at]
        length = np.sqrt((values * values).sum())
        return at, values / length if length else values

    def nearest(self, at: np.ndarray, values: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The NEIGHBOURS examples of the largest cosine above 0, ties by their number; all but ``leave``."""
        bounds = values @ self.largest[at]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable").tolist():
            least = best[-1] if len(best) == NEIGHBOURS else 0.0
            if bounds[b] <= 0 or bounds[b] < least - 1e-9:
                break
            scores = np.zeros(BLOCK)
            for t, v in zip(at.tolist(), values.tolist(), strict=True):
                low, high = self.begins[t, b], self.begins[t, b + 1]
                if high > low:
                    scores[self.examples[low:high] - b * BLOCK] += v * self.weights[low:high]
            hit = np.flatnonzero(scores > 0)
            hit = hit[hit + b * BLOCK != leave]
            best_at, best = np.append(best_at, hit + b * BLOCK), np.append(best, scores[hit])
            order = np.lexsort((best_at, -np.round(best, 9)))[:NEIGHBOURS]
            best_at, best = best_at[order], best[order]
        return best_at, best

    def votes(self, near: np.ndarray, similarity: np.ndarray) -> tuple[float, float]:
        weight = 1 / (NEAR + 1 - np.minimum(similarity, 1))
        return float(weight @ self.labels[near]), float(weight.sum())

    def score(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        if not counts or not len(self.ids):
            return self.base, []
        near, similarity = self.nearest(*self.vector(counts))
        for_it, all_of_it = self.votes(near, similarity)
        evidence = [
            {"doc_id": int(self.ids[i]), "label": int(self.labels[i]), "similarity": float(s)}
            for i, s in zip(near[:EVIDENCE], similarity[:EVIDENCE], strict=True)
        ]
        return (for_it + self.pull * self.base) / (all_of_it + self.pull), evidence


def build(terms: list[str], idf: np.ndarray, examples: list[tuple[int, int, dict[int, int]]]) -> Index:
    """Index of (id, label, term counts); those without a term set the base rate only."""
    plain = [label for _, label, counts in examples if not counts]
    held = [x for x in examples if x[2]]
    blocks = -(-len(held) // BLOCK)
    index = Index(
        terms,
        idf,
        np.array([x[0] for x in held], np.int64),
        np.array([x[1] for x in held], np.int64),
        np.zeros((len(terms), blocks + 1), np.int64),
        np.zeros((len(terms), blocks)),
        np.zeros(0, np.int64),
        np.zeros(0),
    )
    vectors = [index.vector(counts) for _, _, counts in held]
    if held:
        term = np.concatenate([at for at, _ in vectors])
        number = np.repeat(np.arange(len(held)), [len(at) for at, _ in vectors])
        weight = np.concatenate([values for _, values in vectors])
        order = np.lexsort((number, term))
        term, index.examples, index.weights = term[order], number[order], weight[order]
        cells = term * blocks + index.examples // BLOCK
        np.maximum.at(index.largest.reshape(-1), cells, index.weights)
        edges = (np.arange(len(terms))[:, None] * blocks + np.arange(blocks + 1)[None, :]).reshape(-1)
        index.begins = np.searchsorted(cells, edges).reshape(len(terms), blocks + 1)
    index.base = (sum(plain) + 0.1) / (len(plain) + 1)
    found = [index.votes(*index.nearest(*vectors[i], leave=i)) for i in range(len(held))]
    loss = {}
    for pull in _PULLS:
        p = np.array([(a + pull * index.base) / (b + pull) for a, b in found])
        loss[pull] = -np.log(np.where(index.labels == 1, p, 1 - p) + 1e-9).mean() if held else 0.0
    index.pull = min(loss, key=loss.get)
    return index


def _counted(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Vocabulary(terms)
        for batch in batches:
            found = [find(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("label"),
                    pa.array([list(x) for x in found], pa.list_(pa.int64())),
                    pa.array([list(x.values()) for x in found], pa.list_(pa.int64())),
                ],
                ["_id", "label", "terms", "counts"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, *, label: str, learn: Column, rows: int = FITTED_ROWS) -> Index:
    """Terms, frequencies and examples for ``label``, learned from rows of ``labels`` chosen by ``learn``.

    At most ``rows`` labelled documents are read for terms, the first EXAMPLES distinct texts of each label
    become examples; frequencies cover all documents. Rows without an id or a label of 0 or 1, and ids
    with both labels, are left out. Without labelled rows every score is the base rate.
    """
    prepare(docs.sparkSession)
    chosen = F.broadcast(learnable(labels, label, learn, rows))  # bounded by the number of rows
    sample = docs.select(docs["doc_id"].cast("long").alias("_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    sample = sample.join(chosen, "_id").groupBy("text", F.col("_label").alias("label")).agg(F.min("_id").alias("_id"))
    sample = written(sample, "sample")
    counted = sample.select("text", "label").mapInArrow(_sample_terms, "term string, clean long, toxic long")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = sample.agg(F.sum(1 - F.col("label")).alias("clean"), F.sum("label").alias("toxic")).first()
    clean, toxic = totals["clean"] or 0, totals["toxic"] or 0
    terms: list[str] = []
    if clean and toxic:
        share = (F.col("clean") + F.col("toxic")) / (clean + toxic)
        gap = F.col("toxic") / toxic - F.col("clean") / clean
        phi2 = gap * gap / (share * (1 - share)) * (clean / (clean + toxic)) * (toxic / (clean + toxic))
        ratio = F.lit(0.0)
        for column, n in (("clean", clean), ("toxic", toxic)):
            k = F.col(column)
            ratio += F.when(k > 0, k * F.log(k / n / share)).otherwise(0.0)
            ratio += F.when(k < n, (n - k) * F.log((n - k) / n / (1 - share))).otherwise(0.0)
        close = counted.where((F.col("term") != "") & (share < 1))
        close = close.select("term", phi2.alias("phi2"), (2 * ratio).alias("ratio"))
        close = close.where((F.col("phi2") >= LEAST_PHI**2) & (F.col("ratio") >= LEAST_RATIO))
        terms = [r["term"] for r in close.orderBy(F.desc("phi2"), "term").limit(TERMS).collect()]
    whole = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text")).mapInArrow(
        _frequencies(terms), "term long, n long"
    )
    n = {r["term"]: r["n"] for r in whole.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    idf = np.array([np.log((1 + n.get(-1, 0)) / (1 + n.get(i, 0))) + 1 for i in range(len(terms))])
    kept = []
    for value in (0, 1):
        part = sample.where(F.col("label") == value).orderBy(F.xxhash64("_id"), "_id").limit(EXAMPLES)
        part = part.mapInArrow(_counted(terms), "_id long, label int, terms array<long>, counts array<long>")
        kept += [(r["_id"], r["label"], dict(zip(r["terms"], r["counts"], strict=True))) for r in part.collect()]
    return build(terms, idf, kept)


def _scored(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Vocabulary(index.terms)
        for batch in batches:
            scores = [index.score(find(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s for s, _ in scores], pa.float64()),
                    pa.array([e for _, e in scores], _EVIDENCE),
                ],
                ["doc_id", "score", "evidence"],
            )

    return run


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))


def score(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, score`` (0 to 1) and ``evidence``, the nearest examples, for every document's whole text.

    The text alone counts. A text without any chosen term (an empty or null one too) has the base rate and
    no evidence. Every row of a repeated or null ``doc_id`` has a row. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(_scored(index), SCORES)


def _passed(index: Index, threshold: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Vocabulary(index.terms)
        for batch in batches:
            low = [index.score(find(text or ""))[0] < threshold for text in batch.column("text").to_pylist()]
            yield batch.select(names).filter(pa.array(low, pa.bool_()))

    return run


def without_toxic(docs: DataFrame, index: Index, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, unchanged, with all their columns."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_passed(index, threshold, docs.columns), docs.schema)
