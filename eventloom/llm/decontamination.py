"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are those of :mod:`eventloom.llm.words`; a text's shingles are its runs of five words (a shorter text is
one shingle), each weighing as often as it occurs. Every item is compared with all windows of as many words as
it has (a shorter document is one window). A window without any shingle of an item is 0 similar to all and
gets no fingerprint. The others' fingerprints of 128 bits are looked up by blocks of 16 bits: two that
differ in RADIUS bits at most differ in at most three bits of some block, and the index holds all
values that near, so no item within the radius is missed. A candidate counts when its weighted shingles
(sum of minima over sum of maxima) are SIMILAR or more.

Items are collected in blocks of bounded size, and every block meets all documents in turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words
from eventloom.llm.shared import prepare, written

SIZE = 5
SIMILAR = 0.8
RADIUS = 31
#: Items and characters of items that a block of items has, about.
BLOCK_ITEMS = 1000
BLOCK_CHARS = 4_000_000

#: Windows fingerprinted at a time.
_WINDOWS = 1024

_U = np.uint64
_BLOCKS, _FLIPS = 8, 3
_MASKS = np.array([sum(1 << b for b in c) for n in range(_FLIPS + 1) for c in combinations(range(16), n)], np.uint16)
HITS = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"
pa_hits = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("start_word", pa.int64()),
        ("n_words", pa.int64()),
        ("distance", pa.int32()),
        ("similarity", pa.float64()),
    ]
)


def shingles(hashed: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Shingles of one text by the place of their first word, repeats included."""
    if 0 < len(hashed) < size:
        return words.mix(words.ngrams(hashed, len(hashed)) + _U(len(hashed)))
    return words.ngrams(hashed, size)


def signs(found: np.ndarray) -> np.ndarray:
    """128 signs of each shingle."""
    both = np.stack([words.mix(found ^ _U(0xA5A5)), words.mix(found ^ _U(0x5A5A5A))], axis=1)
    bits = np.unpackbits(np.ascontiguousarray(both).view(np.uint8).reshape(len(found), 16), axis=1)
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, 16 bytes each, of sums of signs."""
    return np.packbits(sums > 0, axis=1)


class Items:
    """Index of a block of items."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        data, offsets = words.utf8(pa.array(texts, pa.string()))
        hashed, before = words.hashes(data, offsets)
        self.ids, self.sets, lengths = [], [], []
        for k, item in enumerate(ids):
            own = hashed[before[k] : before[k + 1]]
            if len(own):
                self.ids.append(item)
                self.sets.append(shingles(own))
                lengths.append(len(own))
        self.lengths = np.array(lengths, np.int64)
        n = len(self.ids)
        self.prints = np.zeros((n, 16), np.uint8)
        for i, own in enumerate(self.sets):
            self.prints[i] = packed(signs(own).sum(axis=0)[None, :])[0]
        self.weights = [dict(zip(*(x.tolist() for x in np.unique(s, return_counts=True)), strict=True)) for s in self.sets]
        # which items hold a shingle
        every = np.concatenate([np.unique(s) for s in self.sets]) if n else np.zeros(0, _U)
        owner = np.repeat(np.arange(n), [len(w) for w in self.weights]) if n else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]
        self.some = np.zeros(1 << 20, bool)
        self.some[(self.every >> _U(44)).astype(np.int64)] = True
        self.short = sorted({int(m) for m in self.lengths if m < SIZE})
        # items by the values near each of their blocks
        self.values = self.prints.view(np.uint16).reshape(n, _BLOCKS)
        self.near: list[tuple[np.ndarray, np.ndarray]] = []
        for b in range(_BLOCKS):
            keys = (self.values[:, b, None] ^ _MASKS[None, :]).reshape(-1)
            order = np.argsort(keys, kind="stable")
            begins = np.searchsorted(keys[order], np.arange(65537))
            self.near.append((begins, (order // len(_MASKS)).astype(np.int32)))

    def known(self, found: np.ndarray) -> np.ndarray:
        """Places of shingles that some item holds."""
        at = np.flatnonzero(self.some[(found >> _U(44)).astype(np.int64)])
        if not len(at):
            return at
        there = np.minimum(np.searchsorted(self.every, found[at]), len(self.every) - 1)
        return at[self.every[there] == found[at]]

    def _within(self, prints: np.ndarray, size: int) -> list[tuple[int, int, int]]:
        """(window, item, distance) of all items of that many words within the radius."""
        values = prints.view(np.uint16).reshape(len(prints), _BLOCKS)
        pairs = []
        for b, (begins, items) in enumerate(self.near):
            low, high = begins[values[:, b]], begins[values[:, b].astype(np.int64) + 1]
            n = high - low
            window = np.repeat(np.arange(len(prints)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            item = items[place]
            right = self.lengths[item] == size
            pairs.append(window[right] * len(self.ids) + item[right])
        both = np.unique(np.concatenate(pairs))
        window, item = both // len(self.ids), both % len(self.ids)
        apart = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1, dtype=np.int64)
        near = apart <= RADIUS
        return list(zip(window[near].tolist(), item[near].tolist(), apart[near].tolist(), strict=True))

    def similarity(self, own: np.ndarray, item: int) -> float:
        """Weighted similarity of a window's shingles and an item's."""
        weights = self.weights[item]
        found, counts = np.unique(own, return_counts=True)
        common = sum(min(n, weights.get(s, 0)) for s, n in zip(found.tolist(), counts.tolist(), strict=True))
        return common / (len(own) + len(self.sets[item]) - common)

    def hits(self, hashed: np.ndarray) -> list[tuple[int | None, int, int, int, float]]:
        """(item id, first word, words, distance, similarity) of the most similar window of each item that one text holds."""
        out: dict[int, tuple[float, int, int, int]] = {}
        total = len(hashed)
        for size in [SIZE, *self.short]:
            if total < size:
                continue
            found = words.ngrams(hashed, size)
            found = found if size == SIZE else words.mix(found + _U(size))
            at = self.known(found)
            if not len(at):
                continue
            first = np.searchsorted(self.every, found[at])
            last = np.searchsorted(self.every, found[at], "right")
            seeds: dict[int, list[int]] = {}
            for place, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                for m in {int(self.lengths[i]) for i in self.owner[a:b]}:
                    if (m >= SIZE) == (size == SIZE):
                        seeds.setdefault(m, []).append(place)
            for m, places in seeds.items():
                self._windows(found, size, m, np.array(places), total, out)
        return [(self.ids[i], start, n, apart, s) for i, (s, start, n, apart) in sorted(out.items())]

    def _windows(self, found: np.ndarray, size: int, m: int, places: np.ndarray, total: int, out: dict) -> None:
        """Windows of m words that hold one of the places."""
        each = max(m - size + 1, 1)
        if total < m:
            begin, each = np.zeros(1, np.int64), len(found)
        else:
            mark = np.zeros(len(found) + 1, np.int64)
            np.add.at(mark, np.maximum(places - each + 1, 0), 1)
            np.add.at(mark, places + 1, -1)
            begin = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            begin = begin[begin <= total - m]
        # stretches of neighbouring windows, so that what lies between far passages is not fingerprinted
        edges = [0, *(np.flatnonzero(np.diff(begin) > 1) + 1).tolist(), len(begin)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            for first in range(low, high, _WINDOWS):
                self._stretch(found, begin[first : min(first + _WINDOWS, high)], each, m, total, out)

    def _stretch(self, found: np.ndarray, begin: np.ndarray, each: int, m: int, total: int, out: dict) -> None:
        """Consecutive windows of ``each`` shingles."""
        inside = found[begin[0] : begin[-1] + each]
        sums = np.zeros((len(inside) + 1, 128), np.int32)
        np.cumsum(signs(inside), axis=0, out=sums[1:])
        at = begin - begin[0]
        for window, item, apart in self._within(packed(sums[at + each] - sums[at]), m):
            start = int(begin[window])
            s = self.similarity(found[start : start + each], item)
            if s >= SIMILAR and (item not in out or (-s, start) < (-out[item][0], out[item][1])):
                out[item] = (s, start, min(m, total), apart)


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark's items, one block at a time."""
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"], F.lit("")).alias("text")
    )
    items = written(items, "items")
    size = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield Items([r["item_id"] for r in rows], [r["text"] for r in rows])


def _each(items: Items, texts: pa.Array) -> Iterator[tuple[int, list]]:
    """Rows of a batch that may hold an item, and their hits."""
    for a, hashed, before in words.word_slices(texts):
        # one look at the whole slice tells which texts share a shingle with an item
        rows: set[int] = set()
        for size in [SIZE, *items.short]:
            found = words.ngrams(hashed, size)
            found = found if size == SIZE else words.mix(found + _U(size))
            rows.update(np.searchsorted(before, items.known(found), "right").tolist())
        for k in sorted(x - 1 for x in rows):
            hits = items.hits(hashed[before[k] : before[k + 1]])
            if hits:
                yield a + k, hits


def _found(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows = [(ids[row].as_py(), *hit) for row, hits in _each(items, batch.column("text")) for hit in hits]
            columns = list(zip(*rows, strict=True)) or [[]] * len(pa_hits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, pa_hits, strict=True)], schema=pa_hits
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id, item_id, start_word, n_words, distance, similarity`` of
    the most similar window, the first of equals.

    Null or empty texts, of documents or items, hold nothing and are found nowhere. Every row of a repeated
    or null id stands for itself. Without items or documents: no rows. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    parts = [rows.mapInArrow(_found(items), HITS) for items in _blocks(benchmark)]
    if not parts:
        return docs.sparkSession.createDataFrame([], HITS)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _clean(items: Items, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[row for row, _ in _each(items, batch.column("text"))]] = False
            yield batch.select(names).filter(pa.array(keep))

    return run


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item of the benchmark, unchanged, with all their columns."""
    prepare(docs.sparkSession)
    for items in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(items, docs.columns), docs.schema)
    return docs
