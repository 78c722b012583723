"""Packing under a mixture: deficit round-robin over one token queue per source.

Every source is a queue of tokens. A window of ``window`` tokens takes from each queue its share; what
a share lacks of a whole token stays as the queue's deficit and is paid in a later window. The deficit
of a queue after k windows is a remainder of a division, so every task can tell for its own documents
in which windows they lie, whatever the other tasks do: no state goes from task to task, and the
deficits carry over windows and partitions alike.

With ``targets`` the queues are drained at these rates until one is empty; the rest share its part from
then on (a phase). Without them the rates are the queues' sizes, and all queues end together.

The windows' tokens form one stream. Sequences are cut from it every ``length`` tokens; what is left
at its end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.shared import prepare, written

LENGTH = 2048
WINDOW = 16 * LENGTH
END = 1
MAX_QUEUES = 1024
#: Words that a Python worker remembers at most: those that came again, and those seen once.
REMEMBERED = 300_000
SEEN_ONCE = 200_000

TOKENS = "doc_id long, source string, queue string, part int, start long, n long, ids binary"
PIECES = (
    "doc_id long, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class Encoder:
    """Token ids of whole texts, word by word, remembering the words it has seen.

    White space separates tokens in this vocabulary and is dropped, so a text's ids are those of its
    runs without ASCII white space, one after the other. Full stops and commas that end a run of
    letters are tokens of their own.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: ids of words that came again, and of words that came in one batch so far
        self.known: dict[bytes, bytes] = {}
        self.once: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not remembered."""
        stopped = [w for w in words if w[-1:] in (b".", b",") and w[:-1].decode().isalpha()]
        words = words.difference(stopped).union(w[:-1] for w in stopped).union(w[-1:] for w in stopped)
        plain, other = [], []
        learnt: dict[bytes, bytes] = {}
        whole = self.tokenizer.model.tokenize
        for w in words:
            if w.isalpha():  # ASCII letters: nothing to normalise, one word of the vocabulary
                learnt[w] = array("I", [token.id for token in whole(w.decode())]).tobytes()
            else:
                (plain if (word := w.decode()).isalpha() else other).append(word)
        # a run of letters gives one word of the vocabulary: its last token, and no other, ends a word
        ids = np.zeros(0, np.uint32)
        if plain:
            joined = [" ".join(plain[i : i + 32]) for i in range(0, len(plain), 32)]
            found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.fromiter((i for e in found for i in e.ids), np.uint32)
        last = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else ids
        if len(last) == len(plain):
            first, data = 0, ids.astype("<u4").tobytes()
            for word, end in zip(plain, last.tolist(), strict=True):
                learnt[word.encode()] = data[4 * first : 4 * end]
                first = end
        else:
            other += plain
        if other:
            for word, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
                learnt[word.encode()] = np.array(e.ids, "<u4").tobytes()
        for w in stopped:
            learnt[w] = learnt[w[:-1]] + learnt[w[-1:]]
        return learnt

    def __call__(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        # bytes are split at ASCII white space and only A-Z are lower-cased, as the vocabulary's rules allow
        runs = [text.encode().lower().split() for text in batch]
        known, once = self.known, self.once
        missing = set().union(*runs).difference(known)
        again = [w for w in missing if w in once]
        for w in again:
            known[w] = once.pop(w)
        missing.difference_update(again)
        learnt = self._learn(missing) if missing else {}
        known.update(learnt)
        get = known.__getitem__
        out = [b"".join(map(get, run)) for run in runs]
        # a word stays only when it comes again, so that the many that never do push out no other
        for w in learnt:
            del known[w]
        if len(once) + len(learnt) > SEEN_ONCE:
            once.clear()
        once.update(learnt)
        if len(known) > REMEMBERED:
            known.clear()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The encoder of a vocabulary file, one per Python worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokenise(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ends = encoder(path), TaskContext.get().partitionId(), np.array([END], "<u4").tobytes()
        filled: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                queues = rows.column("queue").to_pylist()
                ids = [x + ends for x in encode(rows.column("text").to_pylist())]
                sizes = [len(x) // 4 for x in ids]
                starts = []
                for queue, size in zip(queues, sizes, strict=True):
                    starts.append(filled.get(queue, 0))
                    filled[queue] = starts[-1] + size
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("source"),
                        rows.column("queue"),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "queue", "part", "start", "n", "ids"],
                )

    return run


class Schedule:
    """Where each token of each queue stands in the packed stream."""

    def __init__(self, totals: dict[str, int], targets: dict[str, float] | None, window: int, length: int):
        self.names = sorted(totals)
        self.order = {name: i for i, name in enumerate(self.names)}
        self.window, self.length = window, length
        left = [totals[name] for name in self.names]
        done = [0] * len(left)
        self.phases: list[tuple[int, list[int], list[int], int]] = []
        at = 0
        while any(left):
            live = [i for i, x in enumerate(left) if x]
            rate = {i: (targets or {}).get(self.names[i], 0.0) if targets else float(left[i]) for i in live}
            paid = [i for i in live if rate[i] > 0]
            if not targets or not paid:  # queues without a target come last, together
                take = {i: left[i] for i in live}
            else:
                first = min(paid, key=lambda i: left[i] / rate[i])
                take = {i: min(left[i], int(left[first] * rate[i] / rate[first])) for i in paid}
                take[first] = left[first]
            given = [take.get(i, 0) for i in range(len(left))]
            self.phases.append((at, list(done), given, sum(given)))
            at += sum(given)
            done = [a + b for a, b in zip(done, given, strict=True)]
            left = [a - b for a, b in zip(left, given, strict=True)]
        self.total = at
        self.full = at // length
        self.kept: dict[tuple[int, int], tuple[int, list[int], list[int], list[int]]] = {}

    def _window(self, phase: int, k: int) -> tuple[int, list[int], list[int], list[int]]:
        """Window k of a phase: its first token's place, each queue's tokens before it and after it, and where each begins in it."""
        if (phase, k) not in self.kept:
            _, _, given, total = self.phases[phase]
            a, b = min(k * self.window, total), min((k + 1) * self.window, total)
            before = [a * x // total for x in given]
            after = [b * x // total for x in given]
            places, at = [], 0
            for x, y in zip(before, after, strict=True):
                places.append(at)
                at += y - x
            if len(self.kept) > 4096:
                self.kept.clear()
            self.kept[phase, k] = sum(before), before, after, places
        return self.kept[phase, k]

    def stretches(self, queue: str, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Tokens start to start + n of a queue as (first token, place in the stream, length)."""
        q, at, end = self.order[queue], start, start + n
        for phase, (base, done, given, total) in enumerate(self.phases):
            low, high = done[q], done[q] + given[q]
            while low <= at < min(high, end):
                x = at - low
                k = x * total // (given[q] * self.window)
                while (w := self._window(phase, k))[1][q] > x:
                    k -= 1
                while w[2][q] <= x:
                    k += 1
                    w = self._window(phase, k)
                size = min(end - at, w[2][q] - x)
                yield at, base + w[0] + w[3][q] + x - w[1][q], size
                at += size

    def sequence(self, place: int) -> tuple[int, int, int]:
        """Of a place in the stream: the sequence's number, the offset in it, and the sequence's length."""
        if place < self.full * self.length:
            return place // self.length, place % self.length, self.length
        rest, number, at = self.total - self.full * self.length, self.full, place - self.full * self.length
        while True:
            size = 1 << (rest.bit_length() - 1)
            if at < size:
                return number, at, size
            at, rest, number = at - size, rest - size, number + 1

    def pieces(self, queue: str, start: int, n: int) -> list[tuple[int, int, int, int]]:
        """A document's pieces: first token in the document, length, sequence, offset; in the document's order."""
        out: list[list[int]] = []
        for first, place, size in self.stretches(queue, start, n):
            while size:
                number, offset, whole = self.sequence(place)
                step = min(size, whole - offset)
                if out and out[-1][2] == number and out[-1][3] + out[-1][1] == offset:
                    out[-1][1] += step
                else:
                    out.append([first - start, step, number, offset])
                first, place, size = first + step, place + step, size - step
        return [tuple(x) for x in out]


def _cut(totals: dict[str, int], targets: dict[str, float] | None, window: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(totals, targets, window, length)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200).to_pydict()
                out: dict[str, list] = {name: [] for name in pa_pieces.names}
                for doc, source, queue, start, n, ids in zip(
                    rows["doc_id"], rows["source"], rows["queue"], rows["start"], rows["n"], rows["ids"], strict=True
                ):
                    for first, size, number, offset in schedule.pieces(queue, start, n):
                        values = (doc, source, first, size)
                        values += (ids[4 * first : 4 * (first + size)], n, number, offset)
                        for name, value in zip(out, values, strict=True):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=pa_pieces)

    return run


pa_pieces = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("source", pa.string()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def queue_of(source: str | None) -> str:
    """The queue of a source that has one to itself."""
    return "-" if source is None else "+" + source


def pack(
    docs: DataFrame,
    *,
    targets: dict[str | None, float] | None = None,
    length: int = LENGTH,
    window: int = WINDOW,
    tokenizer: str | None = None,
) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens; one row per piece, with its ids.

    A document's tokens are its text's ids and END. The result has ``doc_id, source, start, length, ids``
    (little-endian unsigned 32-bit), ``doc_tokens, sequence_id, offset``. Sequences have ``length``
    tokens; the last ones have powers of two, and nothing is padded. The order within a queue is that
    in which the documents are read. ``targets`` maps sources (None: the null ``source``) to rates; sources without
    one, or with a rate of 0, come last. A target that no document's source has, and a rate that is negative or not
    finite, is an error.

    Null or empty text: the piece of END alone. Null ``source``: a queue of its own. Null or repeated
    ``doc_id``: every row is a document by itself. Every source with a target has a queue of its own; where there are
    more than MAX_QUEUES sources, those without a target share that many queues by hash. No documents: no rows.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rates = {queue_of(name): float(rate) for name, rate in (targets or {}).items()}
    if wrong := [name for name, rate in rates.items() if not 0 <= rate < float("inf")]:
        raise ValueError(f"Rates must be finite and not negative: {sorted(wrong)}")
    source = docs["source"].cast("string")
    queue = F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))
    if docs.select(source).distinct().limit(MAX_QUEUES + 1).count() > MAX_QUEUES:
        shared = F.concat(F.lit("#"), F.pmod(F.xxhash64(source), F.lit(MAX_QUEUES)).cast("string"))
        queue = F.when(source.isNull() | queue.isin(list(rates)), queue).otherwise(shared)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        source.alias("source"),
        queue.alias("queue"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    tokens = written(rows.mapInArrow(_tokenise(tokenizer), TOKENS), "tokens")
    # a table of known size: Spark broadcasts it while it is small, and the ids stay where they are
    sums = written(tokens.groupBy("queue", "part").agg(F.sum("n").alias("size")), "sums")
    totals = {r["queue"]: r["size"] for r in sums.groupBy("queue").agg(F.sum("size").alias("size")).collect()}
    if totals and (unknown := rates.keys() - totals.keys()):
        raise ValueError(f"Targets without documents: {sorted(unknown)}")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("queue", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    placed = tokens.join(bases, ["queue", "part"]).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("start"), "n", "ids"
    )
    return placed.mapInArrow(_cut(totals, rates, window, length), PIECES)
