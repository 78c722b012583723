"""Line dedup that can be undone: sharded cuckoo filters before exact reference-count tables.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased, as two 64-bit
hashes. The index holds

* ``references``: one row per key and document that holds it,
* ``counts``: per key the number of its documents and the smallest of them; these are exact,
* ``filters``: per shard of the keys a cuckoo filter of the keys in ``counts``.

A batch of documents is counted per key before it meets the index, so a line that is everywhere is one
row of the batch. The filters sort out the keys the index has never seen; only the others are looked up in
``counts``. Deleting documents takes their references away; a key without any leaves table and filter,
so the index is what it would be if the documents had never come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import words
from eventloom.llm.shared import known_id, prepare, texts, written

#: A shorter key (in code points) is never dropped.
LEAST = 10
#: Keys of a shard, about; a shard is handled by one task.
SHARD_KEYS = 250_000

_SLOTS = 4
_U = np.uint64
REFERENCES = "h1 long, h2 long, doc_id long"
COUNTS = "shard int, h1 long, h2 long, n_docs long, first_doc long"
FILTERS = "shard int, bits binary"
_PROBED = "shard int, h1 long, h2 long, n_docs long, first_doc long, known boolean, bits binary"


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a full table is followed by one of twice the size.

    ``add`` expects keys that are not in it, ``remove`` keys that are; ``has`` errs only towards yes.
    """

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    @classmethod
    def from_bytes(cls, data: bytes | None) -> CuckooFilter:
        tables, at = [], 0
        while data and at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            table = np.frombuffer(data, "<u2", size * _SLOTS, at + 8).reshape(size, _SLOTS).copy()
            tables.append(table)
            at += 8 + 2 * size * _SLOTS
        return cls(tables)

    def to_bytes(self) -> bytes:
        return b"".join(len(t).to_bytes(8, "little") + t.astype("<u2").tobytes() for t in self.tables)

    @staticmethod
    def _places(table: np.ndarray, h1: np.ndarray, h2: np.ndarray):
        last = _U(len(table) - 1)
        mark = (h2 >> _U(48)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        one = (h1 & last).astype(np.int64)
        return mark, one, one ^ CuckooFilter._step(table, mark)

    @staticmethod
    def _step(table: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return (words.mix(mark.astype(_U)) & _U(len(table) - 1)).astype(np.int64)

    @staticmethod
    def _put(table: np.ndarray, mark: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Fill free slots, one per bucket at a time; returns which found room."""
        done, left = np.zeros(len(mark), bool), np.arange(len(mark))
        while len(left):
            _, at = np.unique(place[left], return_index=True)
            turn = left[at]
            free = table[place[turn]] == 0
            room = free.any(axis=1)
            put = turn[room]
            table[place[put], free[room].argmax(axis=1)] = mark[put]
            done[put] = True
            full = np.zeros(len(table), bool)
            full[place[turn[~room]]] = True
            left = left[~done[left] & ~full[place[left]]]
        return done

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        if not len(h1):
            return
        if not self.tables:
            self.tables.append(self._empty(len(h1)))
        random = np.random.default_rng(len(h1))
        table = self.tables[-1]
        mark, one, two = self._places(table, h1, h2)
        left = ~self._put(table, mark, one)
        left[left] = ~self._put(table, mark[left], two[left])
        mark, place = mark[left], one[left]
        for _ in range(200):
            if not len(mark):
                return
            # one of each bucket's waiting marks takes a slot; what was there moves to its other bucket
            at = np.unique(place, return_index=True)[1]
            slot = random.integers(0, _SLOTS, len(at))
            out = table[place[at], slot].copy()
            table[place[at], slot] = mark[at]
            mark[at], place[at] = out, place[at] ^ self._step(table, out)
            left = ~self._put(table, mark, place)
            mark, place = mark[left], place[left]
        # the marks left over have lost their keys, so undo is not possible: the next table takes whole keys
        self._spill(mark, place, len(table))

    def _spill(self, mark: np.ndarray, place: np.ndarray, size: int) -> None:
        """Keep left-over marks in a following table of the same geometry, where lookups find them."""
        table = np.zeros((size, _SLOTS), np.uint16)
        left = ~self._put(table, mark, place)
        self.tables.append(table)
        if left.any():
            self._spill(mark[left], place[left], size)

    @staticmethod
    def _empty(keys: int) -> np.ndarray:
        size = 1 << max(4, int(np.ceil(np.log2(keys / (_SLOTS * 0.8)))))
        return np.zeros((size, _SLOTS), np.uint16)

    def grow(self, keys: int) -> None:
        """Room for so many further keys: a table of its own once the last is too full."""
        if self.tables:
            last = self.tables[-1]
            if keys > 0.9 * last.size - np.count_nonzero(last):
                self.tables.append(self._empty(max(keys, last.size)))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h1), bool)
        for table in self.tables:
            mark, one, two = self._places(table, h1, h2)
            found |= (table[one] == mark[:, None]).any(axis=1) | (table[two] == mark[:, None]).any(axis=1)
        return found

    def remove(self, h1: np.ndarray, h2: np.ndarray) -> None:
        left = np.ones(len(h1), bool)
        for table in reversed(self.tables):
            mark, one, two = self._places(table, h1, h2)
            for place in (one, two):
                while True:  # one mark of a bucket at a time
                    turn = np.flatnonzero(left)
                    turn = turn[(table[place[turn]] == mark[turn, None]).any(axis=1)]
                    if not len(turn):
                        break
                    turn = turn[np.unique(place[turn], return_index=True)[1]]
                    slot = (table[place[turn]] == mark[turn, None]).argmax(axis=1)
                    table[place[turn], slot] = 0
                    left[turn] = False


def keys_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of texts: for each line both hashes and its key's length, and for each text the lines before it."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    docs = len(offsets) - 1
    before = np.searchsorted(breaks, offsets) + np.arange(docs + 1)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    solid = np.flatnonzero(~words._SPACE[data])
    first = np.searchsorted(solid, start)
    last = np.searchsorted(solid, end)
    some = last > first
    a = np.where(some, solid[np.minimum(first, max(len(solid) - 1, 0))] if len(solid) else 0, 0)
    b = np.where(some, solid[np.maximum(last - 1, 0)] + 1 if len(solid) else 0, 0)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = points[b] - points[a]
    out = []
    for base, inverse in ((words._BASE, words._INVERSE), (_OTHER, pow(_OTHER, -1, 1 << 64))):
        sums = np.zeros(n + 1, _U)
        np.cumsum(words._VALUE[data] * words._power(base, n) if n else data, dtype=_U, out=sums[1:])
        inverse = words._power(inverse, n + 1)
        out.append(words.mix((sums[b] - sums[a]) * inverse[a] + length.astype(_U)))
    return out[0], out[1], length, before


_OTHER = 0xC2B2AE3D27D4EB4F


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h1", "h2", "doc_id"]
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        data, offsets = words.utf8(batch.column("text"))
        for a, b in words.slices(offsets):
            h1, h2, length, before = keys_of(data, offsets[a : b + 1])
            doc = np.repeat(ids[a:b], np.diff(before))
            long = length >= LEAST
            h1, h2, doc = words.as_long(h1[long]), words.as_long(h2[long]), doc[long]
            order = np.lexsort((h2, h1, doc))
            h1, h2, doc = h1[order], h2[order], doc[order]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (doc[1:] != doc[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (h1, h2, doc)], names)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.utf8(batch.column("text"))
        drops = batch.column("_drop")
        n_lines, n_dropped, kept = [], [], []
        for a, b in words.slices(offsets):
            h1, _, length, before = keys_of(data, offsets[a : b + 1])
            h1 = words.as_long(h1)
            for k in range(b - a):
                low, high = before[k], before[k + 1]
                drop = drops[a + k]
                n_lines.append(int(high - low))
                if not drop.is_valid:
                    n_dropped.append(0)
                    kept.append(bytes(data[offsets[a + k] : offsets[a + k + 1]]))
                    continue
                out = np.isin(h1[low:high], drop.values.to_numpy(zero_copy_only=False)) & (length[low:high] >= LEAST)
                lines = bytes(data[offsets[a + k] : offsets[a + k + 1]]).split(b"\n")
                kept.append(b"\n".join([line for line, gone in zip(lines, out, strict=True) if not gone]))
                n_dropped.append(int(out.sum()))
        columns = [c for c in batch.schema.names if c not in ("text", "_drop")]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in columns),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
            ],
            [*columns, "text", "n_lines", "n_dropped"],
        )


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(_U)


def _probe(new: pa.Table, old: pa.Table) -> pa.Table:
    """Which keys of a batch the shard may know; a last row carries the filter with them added."""
    held = CuckooFilter.from_bytes(old["bits"][0].as_py() if len(old) else None)
    known = np.zeros(0, bool)
    if len(new):
        h1, h2 = _unsigned(new["h1"]), _unsigned(new["h2"])
        known = held.has(h1, h2)
        held.grow(int((~known).sum()))
        held.add(h1[~known], h2[~known])
    names = ["shard", "h1", "h2", "n_docs", "first_doc"]
    rows = new.select(names) if len(new) else new.schema.empty_table().select(names)
    rows = rows.append_column("known", pa.array(known))
    rows = rows.append_column("bits", pa.nulls(len(rows), pa.binary()))
    shard = (new if len(new) else old)["shard"][0].as_py()
    last = {name: [None] for name in rows.schema.names} | {"shard": [shard], "bits": [held.to_bytes()]}
    return pa.concat_tables([rows, pa.table(last, schema=rows.schema)])


def _forget(gone: pa.Table, old: pa.Table) -> pa.Table:
    if not len(old):
        return old.select(["shard", "bits"])
    held = CuckooFilter.from_bytes(old["bits"][0].as_py())
    if len(gone):
        held.remove(_unsigned(gone["h1"]), _unsigned(gone["h2"]))
    return pa.table({"shard": old["shard"], "bits": pa.array([held.to_bytes()], pa.binary())})


class LineIndex:
    """The lines of all documents that were inserted and not deleted since.

    A null ``doc_id`` counts as one document before all others; rows of the same ``doc_id`` are parts of
    one document. Null text is one empty line. Inserting a document again changes nothing.
    """

    def __init__(self, spark: SparkSession, shards: int | None = None):
        prepare(spark)
        self.spark, self.shards = spark, shards
        self.references = spark.createDataFrame([], REFERENCES)
        self.counts = spark.createDataFrame([], COUNTS)
        self.filters = spark.createDataFrame([], FILTERS)

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of these documents in."""
        found = texts(docs).mapInArrow(_references, REFERENCES)
        if self.shards is None:
            found = written(found, "found")
            self.shards = max(1, -(-found.count() // SHARD_KEYS))
        else:
            found = found.join(self.references, ["h1", "h2", "doc_id"], "left_anti")
        fresh = written(found.dropDuplicates(["h1", "h2", "doc_id"]), "references")
        batch = fresh.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
        batch = batch.select(self._shard(), "*")
        probed = batch.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_probe, _PROBED)
        probed = written(probed, "probed")
        rows = probed.where(F.col("bits").isNull()).drop("bits")
        known = rows.where("known")
        more = known.select("h1", "h2", F.col("n_docs").alias("more"), F.col("first_doc").alias("other"))
        raised = self.counts.join(more, ["h1", "h2"], "left").select(
            "shard",
            "h1",
            "h2",
            (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.least("first_doc", "other").alias("first_doc"),
        )
        unseen = rows.where("not known").unionByName(known.join(self.counts, ["h1", "h2"], "left_anti"))
        self.counts = written(raised.unionByName(unseen.drop("known")), "counts")
        self.references = self.references.unionByName(fresh)
        self.filters = probed.where(F.col("bits").isNotNull()).select("shard", "bits")

    def delete(self, docs: DataFrame) -> None:
        """Take the documents with these ``doc_id`` out; ids that are not in the index change nothing."""
        ids = docs.select(known_id(docs["doc_id"]).alias("doc_id")).distinct()
        gone = written(self.references.join(ids, "doc_id", "left_semi"), "gone")
        self.references = written(self.references.join(ids, "doc_id", "left_anti"), "references")
        less = gone.groupBy("h1", "h2").agg(F.count("*").alias("less"))
        # the next smallest document of the keys that have lost one
        heirs = self.references.join(less, ["h1", "h2"], "left_semi")
        heirs = heirs.groupBy("h1", "h2").agg(F.min("doc_id").alias("heir"))
        lowered = self.counts.join(less, ["h1", "h2"], "left").join(heirs, ["h1", "h2"], "left")
        lowered = lowered.select(
            "shard",
            "h1",
            "h2",
            (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs"),
            F.coalesce("heir", "first_doc").alias("first_doc"),
        )
        lowered = written(lowered, "counts")
        empty = lowered.where("n_docs = 0")
        self.counts = lowered.where("n_docs > 0")
        self.filters = written(
            empty.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_forget, FILTERS), "filters"
        )

    def clean(self, docs: DataFrame) -> DataFrame:
        """These documents (of the index) without the lines that a smaller document holds.

        All columns stay, ``text`` holds the kept lines; ``n_lines`` and ``n_dropped`` are added, in place
        of columns of these names.
        """
        repeated = self.counts.where("n_docs > 1").select("h1", "h2", "first_doc")
        drops = self.references.join(repeated, ["h1", "h2"]).where("doc_id > first_doc")
        drops = drops.groupBy("doc_id").agg(F.collect_list("h1").alias("_drop"))
        drops = drops.withColumnRenamed("doc_id", "_drop_doc")
        docs = docs.drop("n_lines", "n_dropped", "_drop", "_drop_doc")
        names = [c for c in docs.columns if c != "text"]
        joined = docs.join(drops, known_id(docs["doc_id"]) == drops["_drop_doc"], "left").select(
            *(docs[c] for c in names), F.coalesce(docs["text"], F.lit("")).alias("text"), "_drop"
        )
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
        schema = ", ".join([*fields, "text string", "n_lines long", "n_dropped long"])
        return joined.mapInArrow(_kept, schema)

    def _shard(self):
        return F.pmod("h1", F.lit(self.shards)).cast("int").alias("shard")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All documents without repeated lines: a key of LEAST code points or more that at least two documents
    hold stays in the smallest ``doc_id`` alone, with all its lines there.

    See :class:`LineIndex` for nulls and repeated rows, :meth:`LineIndex.clean` for the columns. No
    documents: no rows.
    """
    index = LineIndex(docs.sparkSession)
    index.insert(docs)
    return index.clean(docs)
