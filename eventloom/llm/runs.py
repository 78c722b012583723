"""Periodic runs of words, found on a grammar: Re-Pair, runs across each rule's boundary, all derivation places.

A run is a stretch of words with smallest period q whose length is at least ``least`` and 2q, and which no
neighbouring word extends. A run lies in exactly one lowest node of the derivation tree, and crosses the boundary
between that node's two halves. So each rule is searched once, across its boundary only, and what it holds is
carried to every place where the rule is derived. A stretch that goes on beyond the rule is found again, longer,
at a rule above it; intervals of one period inside another are merged into it.

Half of a run's shortest length recurs inside the document, so only words of recurring stretches of that length
enter the grammar; the gaps between them are symbols of their own that occur once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.shared import prepare
from eventloom.llm.words import mix

LEAST = 12

RUNS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("text", pa.string()),
    ]
)
RUNS_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


def repair(symbols: list[int], fresh: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Re-Pair: what is left of the sequence, and the rules of the symbols ``fresh``, ``fresh + 1``, ...

    The most frequent pair of neighbours is replaced until none occurs twice. Among equally frequent pairs the
    oldest goes first, which keeps the grammar flat.
    """
    symbols = list(symbols)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i, pair in enumerate(zip(symbols, symbols[1:])):  # noqa: B905
        found = places.get(pair)
        if found is None:
            places[pair] = [i]
        elif pair[0] != pair[1] or found[-1] != i - 1:
            found.append(i)
    places = {pair: found for pair, found in places.items() if len(found) > 1}
    counts = {pair: len(found) for pair, found in places.items()}
    queues: dict[int, deque[tuple[int, int]]] = {}
    for pair, count in counts.items():
        queues.setdefault(count, deque()).append(pair)
    rules: list[tuple[int, int]] = []
    level = max(queues, default=0)
    while level > 1:
        queue = queues.get(level)
        if not queue:
            level -= 1
            continue
        pair = queue.popleft()
        count = counts.get(pair, 0)
        if count < level and pair[0] == pair[1] and pair in places:
            # of overlapping occurrences one was counted, whichever went
            count, end = 0, -1
            for i in places[pair]:
                if i >= end and symbols[i] == pair[0] and after[i] < n and symbols[after[i]] == pair[1]:
                    count, end = count + 1, after[i] + 1
            count = counts[pair] = min(count, level)
        if count != level:
            if 1 < count < level:
                queues.setdefault(count, deque()).append(pair)
            continue
        left, right = pair
        there, end = [], -1
        for i in places.pop(pair):
            if i >= end and symbols[i] == left and (j := after[i]) < n and symbols[j] == right:
                there.append(i)
                end = j + 1 if left == right else i
        del counts[pair]
        if len(there) < 2:
            continue
        symbol = fresh + len(rules)
        rules.append(pair)
        new: dict[tuple[int, int], list[int]] = {}
        for i in there:
            j = after[i]
            k, h = after[j], before[i]
            symbols[i], symbols[j] = symbol, -1
            after[i] = k
            if h >= 0:
                if symbols[h] == symbol:  # its pair with the right neighbour is of the old symbol
                    new[symbol, left].pop()
                    found = new.setdefault((symbol, symbol), [])
                    if not found or after[found[-1]] != h:
                        found.append(h)
                else:
                    old = (symbols[h], left)
                    if old in counts:
                        counts[old] -= 1
                    new.setdefault((symbols[h], symbol), []).append(h)
            if k < n:
                before[k] = i
                old = (right, symbols[k])
                if old in counts:
                    counts[old] -= 1
                new.setdefault((symbol, symbols[k]), []).append(i)
        for made, found in new.items():
            if len(found) > 1:
                places[made] = found
                counts[made] = min(len(found), level)
                queues.setdefault(counts[made], deque()).append(made)
    rest, i = [], 0
    while i < n:
        rest.append(symbols[i])
        i = after[i]
    return rest, rules


def _common(words: np.ndarray, i: int, j: int, room: int, step: int) -> int:
    """Length of the longest common stretch of at most ``room`` words from i and j on, forwards or backwards."""
    done, size = 0, 16
    while done < room:
        size = min(size, room - done)
        if step > 0:
            differ = words[i + done : i + done + size] != words[j + done : j + done + size]
        else:
            a, b = i - done, j - done
            differ = (words[a - size + 1 : a + 1] != words[b - size + 1 : b + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done += size
        size *= 4
    return room


def crossing(
    words: np.ndarray, grams: np.ndarray, size: int, low: int, middle: int, high: int, least: int
) -> list[tuple[int, int, int]]:
    """Maximal runs (start, end, period) of words low to high that cross ``middle``.

    Words q apart are equal at middle - 1 or at middle - q, and around it for ``least / 2`` words at least, so
    for more than half as many (``size``) on one side; ``grams`` are hashes of that many words.
    """
    periods: list[np.ndarray] = []
    last = high - size + 1
    for at in (middle - 1, middle - size):  # a partner to the right of the boundary
        if at >= low and at + 1 < last:
            periods.append(np.flatnonzero(grams[at + 1 : last] == grams[at]) + 1)
    for at in (middle, middle - size + 1):  # to the left
        if low < at < last:
            periods.append(at - low - np.flatnonzero(grams[low:at] == grams[at]))
    if not periods:
        return []
    found: dict[tuple[int, int], int] = {}
    half = (high - low) // 2
    for q in np.unique(np.concatenate(periods)).tolist():
        if q > half:
            break
        for at in (middle - 1, middle - q):
            if at < low or at + q >= high:
                continue
            if any(s <= at < e - q and q % p == 0 for (s, e), p in found.items()):
                continue
            if words[at] != words[at + q]:
                continue
            start = at + 1 - _common(words, at, at + q, at - low + 1, -1)
            end = at + q + _common(words, at, at + q, high - at - q, 1)
            if end - start >= max(least, 2 * q):
                found.setdefault((start, end), q)
    return [(s, e, q) for (s, e), q in found.items()]


def runs(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of a sequence of word ids as rows start, length, period, by start, then period."""
    n, half = len(words), (least + 1) // 2
    none = np.zeros((0, 3), np.int64)
    if n < least:
        return none
    words = np.ascontiguousarray(words, np.int64)
    mixed = mix(words.view(np.uint64) + np.uint64(1))
    size = half // 2 + 1
    grams = _grams(mixed, size)
    wide = _grams(mixed, half)
    order = np.argsort(wide, kind="stable")
    same = wide[order[1:]] == wide[order[:-1]]
    if not same.any():
        return none
    starts = np.zeros(n + 1, np.int64)
    again = np.concatenate([order[1:][same], order[:-1][same]])
    marks = np.zeros(n, bool)
    marks[again] = True
    starts[:n] += marks
    starts[half:] -= marks[: n + 1 - half]
    inside = np.cumsum(starts[:n]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    symbols: list[int] = []
    fresh = int(words.max()) + 1
    begins = []
    for a, b in edges.reshape(-1, 2).tolist():
        if b - a >= least:
            begins.append((a, len(symbols)))
            symbols += words[a:b].tolist()
            symbols.append(fresh)
            fresh += 1
    if not symbols:
        return none
    rest, rules = repair(symbols, fresh)
    return _derived(words, grams, size, rest, rules, fresh, fresh - len(begins), [a for a, _ in begins], least)


def _grams(mixed: np.ndarray, size: int) -> np.ndarray:
    n = len(mixed) - size + 1
    out = mixed[:n]
    for k in range(1, size):
        out = mix(out + np.uint64(k)) + mixed[k : k + n]
    return out


def _derived(
    words: np.ndarray,
    grams: np.ndarray,
    size: int,
    rest: list[int],
    rules: list[tuple[int, int]],
    fresh: int,
    gap: int,
    begins: list[int],
    least: int,
) -> np.ndarray:
    """Runs of all rules, carried to every place; ``gap`` to ``fresh`` are the symbols that end a stretch."""
    lengths = [1] * fresh
    for left, right in rules:
        lengths.append(lengths[left] + lengths[right])
    # what no rule covers is halved, level by level, into rules that occur once
    tops: list[tuple[int, int]] = []
    stretch: list[int] = []
    rules = list(rules)
    for symbol in rest:
        if not gap <= symbol < fresh:
            stretch.append(symbol)
            continue
        while len(stretch) > 1:
            level = []
            for i in range(0, len(stretch) - 1, 2):
                rules.append((stretch[i], stretch[i + 1]))
                lengths.append(lengths[stretch[i]] + lengths[stretch[i + 1]])
                level.append(len(lengths) - 1)
            stretch = level + stretch[len(stretch) - len(stretch) % 2 :]
        tops.append((stretch[0], begins[len(tops)]))
        stretch = []
    places: dict[int, list[np.ndarray]] = {}
    for symbol, at in tops:
        places.setdefault(symbol, []).append(np.array([at], np.int64))
    found: list[np.ndarray] = []
    for symbol in range(len(lengths) - 1, fresh - 1, -1):
        if symbol not in places or lengths[symbol] < least:
            continue
        at = np.concatenate(places.pop(symbol))
        left, right = rules[symbol - fresh]
        first, middle = int(at[0]), lengths[left]
        for s, e, q in crossing(words, grams, size, first, first + middle, first + lengths[symbol], least):
            there = at + (s - first)
            found.append(np.stack([there, np.full(len(at), e - s), np.full(len(at), q)], 1))
        if lengths[left] >= least:
            places.setdefault(left, []).append(at)
        if lengths[right] >= least:
            places.setdefault(right, []).append(at + middle)
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    ends = rows[:, 0] + rows[:, 1]
    order = np.lexsort((-ends, rows[:, 0], rows[:, 2]))
    rows, ends = rows[order], ends[order]
    # a row is part of another when an earlier one of its period reaches as far; ends never mix between periods
    group = np.cumsum(np.concatenate([[0], np.diff(rows[:, 2]) != 0])) * (len(words) + 1)
    reach = np.maximum.accumulate(ends + group)
    kept = np.concatenate([[True], ends[1:] + group[1:] > reach[:-1]])
    rows = rows[kept]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated_tail(n: int, seed: int) -> np.ndarray:
    """Which of n words stands at each place when the tail from ``seed % n`` on repeats its beginning."""
    at = np.arange(n)
    a = seed % n
    p = 1 + (n - a) // (3 + seed % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def _find(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                counts, lists, texts = [], [], []
                for text, seed in zip(part.column("text").to_pylist(), part.column("seed").to_pylist(), strict=True):
                    words = text.split()
                    if seed is not None and words:
                        words = [words[i] for i in repeated_tail(len(words), seed).tolist()]
                    known: dict[bytes, int] = {}
                    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
                    rows = runs(ids, least)
                    if len(rows):
                        cover = np.zeros(len(words) + 1, np.int64)
                        np.add.at(cover, rows[:, 0] + rows[:, 2], 1)
                        np.add.at(cover, rows[:, 0] + rows[:, 1], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                    counts.append(len(ids))
                    lists.append([{"start": s, "length": e, "period": q} for s, e, q in rows.tolist()])
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(lists, RUNS.field("runs").type),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    schema=RUNS,
                )

    return run


def periodic_runs(docs: DataFrame, *, least: int = LEAST, tail_seed: Column | None = None) -> DataFrame:
    """Every document's runs of words, and its text without their repetitions; one pass, no shuffle.

    Words are what white space (``[\\x20\\x09-\\x0D]``) parts; case counts. The result has ``doc_id, n_words,
    runs`` (start, length, period, by start, then period) and ``text``: the words that stand in no run after its
    first period, joined by one space. With ``tail_seed`` the words of a document whose seed is not null are first
    changed by `repeated_tail`. ``least`` is 4 or more.

    Null or empty text: no words, no runs, an empty text. Null or repeated ``doc_id``: every row is a document by
    itself. No documents: no rows. Other columns are ignored. A task holds 200 documents and one grammar at a time.
    """
    if least < 4:
        raise ValueError("A run needs four words at least")
    prepare(docs.sparkSession)
    seed = F.lit(None) if tail_seed is None else tail_seed
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"),
        seed.cast("long").alias("seed"),
    )
    return rows.mapInArrow(_find(least), RUNS_DDL)
