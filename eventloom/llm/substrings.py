"""Substring dedup by bucket-pointer refinement.

Positions of all texts are put into buckets by the GRAM bytes that follow; a bucket's identifier is a 64-bit hash. A
bucket of 2 GRAM bytes is named by the identifiers of a position and of the position GRAM later, one of
LENGTH = 4 GRAM bytes by two of these, 2 GRAM apart: each refinement sorts by identifiers that the last one
has updated. Positions of one final bucket start the same LENGTH bytes; all but the first of them are repeats.

Only few positions have to travel. Of the grams inside a string of LENGTH bytes the one with the smallest
hash is its anchor, so equal strings meet in the bucket of one anchor:

1. Anchors (about one in 40 bytes) are counted by bucket. Those alone in their bucket are done.
2. The others return to their texts, which send each anchor's surroundings (the strings it stands for) to
   its bucket, where they are refined.

Equal texts are handled as one, and equal anchors and surroundings within a task are combined before
they travel, so copies and common passages do not crowd one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words
from eventloom.llm.shared import given_id, prepare, texts, written

GRAM = 25
LENGTH = 4 * GRAM
#: Grams in a string of LENGTH bytes.
_SPAN = LENGTH - GRAM + 1
#: Anchors, and bytes of surroundings, combined in memory at a time.
_CHUNK = 1_000_000
_CHUNK_BYTES = 4 << 20

_U = np.uint64
_LOW = _U((1 << 32) - 1)


def buckets(data: np.ndarray) -> np.ndarray:
    """Identifier of the bucket of GRAM bytes from every position on."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, _U)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(words.CASED[data] * words._power(words._BASE, len(data)), dtype=_U, out=sums[1:])
    return words.mix((sums[GRAM:] - sums[:n]) * words._power(words._INVERSE, n))


def refined(identifiers: np.ndarray, step: int) -> np.ndarray:
    """Identifiers of buckets twice as long: those of a position and of the position ``step`` later."""
    n = len(identifiers) - step
    if n <= 0:
        return np.zeros(0, _U)
    return words.mix(identifiers[:n] * _U(0xD6E8FEB86659FD93) + identifiers[step:])


def anchors(identifiers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every anchor: its text, its position, and the first and last position of the strings it stands for.

    The anchor of a string is the leftmost of its smallest grams; the strings of one are consecutive.
    """
    none = np.zeros(0, np.int64)
    if len(identifiers) < _SPAN:
        return none, none, none, none
    least = (identifiers & ~_LOW) | np.arange(len(identifiers), dtype=_U)
    step = 1
    while 2 * step <= _SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < _SPAN:
        rest = _SPAN - step
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least & _LOW).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + LENGTH <= offsets[text + 1]
    anchor, start, text = anchor[inside], start[inside], text[inside]
    if not len(anchor):
        return none, none, none, none
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    last = np.append(new[1:], len(anchor)) - 1
    return text[new], anchor[new], start[new], start[last]


def _text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = words.utf8(column)
    for a, b in words.slices(offsets):
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that a chunk has once (``known`` false), one of each that it has more often, and all of the latter (``known`` true)."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def combined() -> pa.RecordBatch:
        bucket, text, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, text, bucket))
        bucket, text, at = bucket[order], text[order], at[order]
        new = np.append(True, bucket[1:] != bucket[:-1])
        other = new | np.append(True, (text[1:] != text[:-1]) | (at[1:] != at[:-1]))
        bucket, text, at, new = bucket[other], text[other], at[other], new[other]
        run = np.cumsum(new) - 1
        many = np.bincount(run)[run] > 1
        columns = (np.concatenate([x[new], x[many]]) for x in (words.as_long(bucket), text, at.astype(np.int32)))
        known = np.append(np.zeros(new.sum(), bool), np.ones(many.sum(), bool))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, known)], ["bucket", "class", "at", "known"])

    for batch in batches:
        classes = batch.column("class").to_numpy()
        for a, data, offsets in _text_slices(batch.column("text")):
            identifiers = buckets(data)
            text, anchor, _, _ = anchors(identifiers, offsets)
            held.append((identifiers[anchor], classes[a + text], anchor - offsets[text]))
            size += len(anchor)
            if size > _CHUNK:
                yield combined()
                held, size = [], 0
    if size:
        yield combined()


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``known, bucket, class, at``: the known ones, and those whose bucket holds another."""
    tail: pa.RecordBatch | None = None

    def chosen(rows: pa.RecordBatch) -> pa.RecordBatch:
        bucket, text, at, known = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "class", "at", "known"))
        # a bucket with a first and a last row that differ holds two anchors
        new = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        last = np.append(new[1:], len(bucket)) - 1
        two = (text[new] != text[last]) | (at[new] != at[last])
        keep = known | np.repeat(two, np.diff(np.append(new, len(bucket))))
        return rows.select(["class", "at"]).filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        if tail is not None:
            batch = pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
        bucket, known = batch.column("bucket").to_numpy(), batch.column("known").to_numpy(zero_copy_only=False)
        if known[-1]:
            cut = batch.num_rows
        else:
            cut = int(np.flatnonzero((bucket != bucket[-1]) | known)[-1]) + 1 if (bucket != bucket[-1]).any() else 0
        tail = batch.slice(cut) if cut < batch.num_rows else None
        if cut:
            yield chosen(batch.slice(0, cut))
    if tail is not None:
        yield chosen(tail)


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of each anchor that meets others, as one stretch of bytes (``n`` strings from ``start`` on).

    Of equal stretches in a chunk only the first travels; the others are repeats already (``bytes`` null).
    """
    held: list[tuple] = []
    size = 0
    names = ["bucket", "doc_id", "class", "start", "n", "bytes"]

    def combined() -> pa.RecordBatch:
        rows = sorted(set(held), key=lambda x: x[1:4])  # a repeated row is the same document
        seen: set[tuple[int, bytes]] = set()
        out = []
        for row in rows:
            key = (row[0], row[5])
            out.append((*row[:5], None) if key in seen else row)
            seen.add(key)
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        docs, classes = batch.column("doc_id").to_pylist(), batch.column("class").to_pylist()
        asked = batch.column("at")
        for a, data, offsets in _text_slices(batch.column("text")):
            identifiers = buckets(data)
            text, anchor, first, last = anchors(identifiers, offsets)
            edges = np.searchsorted(text, np.arange(len(offsets)))
            bucket = words.as_long(identifiers[anchor]).tolist()
            raw = data.tobytes()
            for k in range(len(offsets) - 1):
                low, high = edges[k], edges[k + 1]
                wanted = np.unique(asked[a + k].values.to_numpy())
                base = int(offsets[k])
                for i in (low + np.flatnonzero(np.isin(anchor[low:high] - base, wanted))).tolist():
                    f, g = int(first[i]), int(last[i])
                    held.append((bucket[i], docs[a + k], classes[a + k], f - base, g - f + 1, raw[f : g + LENGTH]))
                    size += g - f + LENGTH
            if size > _CHUNK_BYTES:
                yield combined()
                held, size = [], 0
    if held:
        yield combined()


_RUNS = pa.schema([("class", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``bucket, doc_id, class, start``: runs of strings that another string before them equals."""
    held: list[pa.RecordBatch] = []
    size, seen, previous = 0, np.zeros(0, _U), None

    def chosen(last: bool) -> pa.RecordBatch:
        nonlocal held, size, seen, previous
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held, size = [], 0
        place = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("bucket", "class", "start")])
        new = np.append(previous is None or (place[:, 0] != previous).any(), (place[:, 1:] != place[:, :-1]).any(axis=0))
        previous = place[:, -1]
        rows = rows.filter(pa.array(new))  # a repeated row is the same document
        if not rows.num_rows:
            return pa.RecordBatch.from_pydict({"class": [], "start": [], "n": []}, schema=_RUNS)
        data = rows.column("bytes")
        lengths = np.diff(np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, data.offset * 4)).astype(np.int64)
        flat = np.frombuffer(b"".join(data.to_pylist()), np.uint8)
        begin = np.cumsum(lengths) - lengths
        names = refined(refined(buckets(flat), GRAM), 2 * GRAM)
        n = rows.column("n").to_numpy().astype(np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        names = names[np.repeat(begin, n) + inner]
        order = np.argsort(names, kind="stable")
        again = np.zeros(len(names), bool)
        again[order[1:]] = names[order[1:]] == names[order[:-1]]
        if len(seen):
            again |= np.isin(names, seen)
        # strings of the last bucket may come again in the rows that follow
        bucket = rows.column("bucket").to_numpy()
        open_rows = np.repeat(bucket == bucket[-1], n)
        kept = seen if bucket[0] == bucket[-1] else np.zeros(0, _U)
        seen = np.zeros(0, _U) if last else np.unique(np.concatenate([kept, names[open_rows]]))
        start = np.repeat(rows.column("start").to_numpy(), n) + inner
        row = np.repeat(np.arange(len(n)), n)
        hit = np.flatnonzero(again)
        new = np.append(True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]]))[: len(hit)]
        first = hit[new]
        end = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        return pa.RecordBatch.from_arrays(
            [
                rows.column("class").take(pa.array(row[first])),
                pa.array(start[first].astype(np.int32)),
                pa.array((end - first + 1).astype(np.int32)),
            ],
            ["class", "start", "n"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size > _CHUNK_BYTES:
            yield chosen(False)
    if held:
        yield chosen(True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge a text's runs to removed spans, and digest what is left."""
    for batch in batches:
        spans, digests = [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for r in sorted((r["start"], r["start"] + r["n"] - 1 + LENGTH) for r in runs):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            data, at, left = text.encode(), 0, hashlib.sha256()
            for a, b in merged:
                left.update(data[at:a])
                at = b
            left.update(data[at:])
            spans.append([{"begin": a, "end": b} for a, b in merged])
            digests.append(left.hexdigest())
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), pa.array(spans, kind), pa.array(digests, pa.string())], ["class", "spans", "kept_sha256"]
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` of every document: what to remove, and the digest of the rest.

    ``spans`` are the maximal runs ``(begin, end)`` of bytes (UTF-8, end excluded) covered by strings of LENGTH
    bytes that also start earlier: in a document of a smaller ``doc_id`` or earlier in the same one. Strings are judged
    on the input. Null text is empty. A null ``doc_id`` comes before all others. Rows of one ``doc_id`` and
    text are one document; different texts of one ``doc_id`` are documents in the order of a hash of
    their text. No documents: no rows. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("class"), "text")
    base = rows.select("doc_id", "class", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    base = written(base, "texts")
    found = rows.select("class", "text").mapInArrow(_find_anchors, "bucket long, class long, at int, known boolean")
    spread = F.when(F.col("known"), F.col("class")).otherwise(F.col("bucket"))
    found = found.repartition(spread).sortWithinPartitions("known", "bucket", "class", "at")
    asked = found.mapInArrow(_meeting, "class long, at int")
    asked = asked.groupBy("class").agg(F.collect_list("at").alias("at"))
    firsts = base.groupBy("class").agg(F.min("doc_id").alias("first"))
    asked = asked.join(firsts, "class").select(F.col("first").alias("doc_id"), "class", "at")
    meeting = written(rows.join(asked, ["doc_id", "class"]), "meeting")
    around = meeting.mapInArrow(
        _surroundings, "bucket long, doc_id long, class long, start int, n int, bytes binary"
    )
    around = written(around, "around")
    sent = around.where("bytes is not null").repartition("bucket").sortWithinPartitions("bucket", "doc_id", "class", "start")
    runs = sent.mapInArrow(_repeats, "class long, start int, n int").unionByName(
        around.where("bytes is null").select("class", "start", "n")
    )
    runs = runs.groupBy("class").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    cut = meeting.select("class", "text").join(runs, "class").mapInArrow(
        _cut, "class long, spans array<struct<begin: long, end: long>>, kept_sha256 string"
    )
    out = base.join(firsts, "class").join(cut.dropDuplicates(["class"]), "class", "left")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<begin: long, end: long>>")
    return out.select(
        given_id(F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
