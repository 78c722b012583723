"""Counter files as a data source whose tasks share a file, each from its first whole record on."""

from __future__ import annotations

import io
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Counters of a line in their order, up to version 2 and after it; words of a time stamp.
COUNTERS = ("l0b", "l0a", "l1b", "l1a", "l2b", "l2a", "lmb", "lma")
EARLY_COUNTERS, LATE_VERSION = 6, 3
STAMP_WORDS = (4, 5)

#: Bytes of a task's share of the files.
SPLIT_BYTES = 64 << 20
_BATCH = 8192

_HEAD = "file string, split bigint"
_TIMES = ("orbit", "period", "seconds", "microsecs", "time_group")
RECORDS = (
    f"{_HEAD}, run bigint, version int, rec bigint, {', '.join(f'{t} bigint' for t in _TIMES)}, class_idx int, "
    f"{', '.join(f'{c} bigint' for c in COUNTERS)}"
)
COUNTS = f"{_HEAD}, records bigint"


class MalformedFile(ValueError):
    def __init__(self, what: str, file: str):
        super().__init__(f"malformed {what} in a counter file: {file}")


class Share(InputPartition):
    """Pieces of files that one task reads: file, first byte, byte after the last, number of the piece."""

    def __init__(self, pieces: list[tuple[str, int, int, int]]):
        super().__init__(len(pieces))
        self.pieces = pieces


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class Lines:
    """Lines of a file that count, from the first that begins at or after a byte."""

    def __init__(self, path: str, begin: int = 0):
        system, name = opened(path)
        self.source = system.open_input_file(name)
        self.at = max(begin - 1, 0)
        self.source.seek(self.at)
        self.buffer = io.BufferedReader(self.source, 1 << 20)
        if begin:
            self.at += len(self.buffer.readline())

    def __enter__(self) -> Lines:
        return self

    def __exit__(self, *_) -> None:
        self.buffer.close()

    def __iter__(self) -> Iterator[tuple[int, list[bytes]]]:
        for line in self.buffer:
            at, self.at = self.at, self.at + len(line)
            if not line.startswith(b"#") and (words := line.split()):
                yield at, words


def header_of(lines: Lines, path: str) -> tuple[int, int, list[int], int]:
    """Version, run, class numbers, and the byte after the two lines, of a file read from its beginning."""
    found = iter(lines)
    first, second = next(found, None), next(found, None)
    if first is None or second is None:
        raise MalformedFile("header", path)
    try:
        version, numbers = int(first[1][0]), [int(w) for w in second[1]]
    except ValueError:
        raise MalformedFile("header", path) from None
    if len(numbers) < 2 or numbers[1] != len(numbers) - 2 or len(first[1]) > 1:
        raise MalformedFile("number of classes", path)
    return version, numbers[0], numbers[2:], lines.at


def header(path: str) -> tuple[int, int, list[int], int]:
    with Lines(path) as lines:
        return header_of(lines, path)


def records(path: str, begin: int, end: int) -> Iterator[tuple[int, int, list[int], list[int], list[list[int]]]]:
    """Version, run, classes, time stamp and counters per class of the records that begin in a piece, each read to its end.

    The piece before reads on to the next time stamp, so a line is checked by exactly one piece.
    """
    with ExitStack() as opened_files:
        # a piece that starts with the file is read on from its header: most files are small, and opened once
        lines = opened_files.enter_context(Lines(path))
        version, run, classes, after = header_of(lines, path)
        width = len(COUNTERS) if version >= LATE_VERSION else EARLY_COUNTERS
        whole = begin > after
        if whole:
            lines = opened_files.enter_context(Lines(path, begin))
        rows = iter(lines)
        row = next(rows, None)
        while whole and row is not None and len(row[1]) not in STAMP_WORDS:
            row = next(rows, None)  # the rest of a record of an earlier piece
        while row is not None and row[0] < end:
            at, stamp = row
            if len(stamp) not in STAMP_WORDS:
                raise MalformedFile("time stamp", path)
            counts = []
            for _ in classes:
                row = next(rows, None)
                if row is None:
                    raise MalformedFile("last record", path)
                if len(row[1]) != width:
                    raise MalformedFile("counters", path)
                counts.append(row[1])
            try:
                yield version, run, classes, [int(w) for w in stamp], [[int(w) for w in line] for line in counts]
            except ValueError:
                raise MalformedFile("number", path) from None
            row = next(rows, None)
            if row is not None and len(row[1]) not in STAMP_WORDS:
                raise MalformedFile("time stamp", path)


class CounterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.counting = options.get("what") == "counts"
        if self.split_bytes < 1:
            raise ValueError("splitBytes must be positive")

    def files(self) -> list[tuple[str, int]]:
        """Files below the path with their sizes; hidden ones and those that writers leave behind do not count."""
        system, name = opened(self.path)
        prefix = self.path.removesuffix("/").removesuffix(name.rstrip("/"))
        info = system.get_file_info(name)
        found = [info]
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(name, recursive=True))
        shown = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        return sorted((prefix + f.path, f.size) for f in shown)

    def partitions(self) -> list[Share]:
        shares: list[list[tuple[str, int, int, int]]] = []
        room = 0
        for path, size in self.files():
            if size > self.split_bytes:
                pieces = range(0, size, self.split_bytes)
                shares += [[(path, a, min(a + self.split_bytes, size), i)] for i, a in enumerate(pieces)]
                room = 0
            elif not self.counting:  # a file that is one piece needs no count
                if room < size or not shares:
                    shares.append([])
                    room = self.split_bytes
                shares[-1].append((path, 0, max(size, 1), 0))
                room -= size
        return [Share(pieces) for pieces in shares] or [Share([])]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return self._counts(partition) if self.counting else self._records(partition)

    def _counts(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for path, begin, end, split in partition.pieces:
            after = header(path)[3]
            with Lines(path, max(begin, after)) as lines:
                n = 0
                for at, words in lines:
                    if at >= end:
                        break
                    n += len(words) in STAMP_WORDS
            yield pa.RecordBatch.from_pydict({"file": [path], "split": [split], "records": [n]})

    def _records(self, partition: Share) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
        schema = pa.schema([(n, types[f.split()[1]]) for n, f in zip(names, RECORDS.split(", "), strict=True)])
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else ((),) * len(names)
            arrays = [pa.array(c, schema.field(n).type) for n, c in zip(names, columns, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for path, begin, end, split in partition.pieces:
            for rec, (version, run, classes, stamp, counts) in enumerate(records(path, begin, end)):
                time = (*stamp, None)[: len(_TIMES)]
                for number, values in zip(classes, counts, strict=True):
                    values = (*values, None, None)[: len(COUNTERS)]
                    rows.append((path, split, run, version, rec, *time, number, *values))
                if len(rows) >= _BATCH:
                    yield batch()
        yield batch()


class CounterFiles(DataSource):
    """Format ``counter_files``: option ``path``, ``splitBytes`` and ``what`` (records, or counts of them per piece)."""

    @classmethod
    def name(cls) -> str:
        return "counter_files"

    def schema(self) -> str:
        return COUNTS if self.options.get("what") == "counts" else RECORDS

    def reader(self, schema) -> CounterReader:
        return CounterReader({k.lower(): v for k, v in self.options.items()})


def read_counters(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Counter files (``.cnt``) of any size, one row per (run, record, class).

    Line 1 is the version; line 2 run, number of classes and their numbers; then per record a time stamp (orbit, period,
    seconds, microseconds, perhaps a time group) and one line of counters per class. Lines that are blank or start
    with ``#`` do not count. A file larger than ``split_bytes`` is read in pieces: a piece holds the records whose
    stamp begins in it (stamps have four or five words, counters six or eight). Records are numbered by the counts of
    the pieces before, so large files are read twice. A malformed line or a cut-off record fails the job; a file
    without records has no rows.
    """
    spark.dataSource.register(CounterFiles)
    source = spark.read.format("counter_files").option("path", path).option("splitBytes", split_bytes)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = source.option("what", "counts").load()
    bases = counts.select("file", "split", F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("base"))
    found = source.option("what", "records").load().join(bases, ["file", "split"], "left")
    rec = (F.col("rec") + F.coalesce("base", F.lit(0))).cast("int")
    return found.select("run", "version", rec.alias("rec"), *_TIMES, "class_idx", *COUNTERS)
