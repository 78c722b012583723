"""Jaccard join of n-gram sets with set-relation skipping.

Every document becomes its set of distinct shingles (:mod:`eventloom.llm.words`); equal sets are one class.
Two sets can only be similar if they share one of their first shingles (the prefix), in an order all
sets agree on: common shingles last, the rest by hash. An index list holds the classes with a shingle in
their prefix.

* Skipping within lists: a list is cut into blocks by the sets' sizes; a block meets itself and the next one,
  since sets of a size further apart cannot be similar. Sets that are similar share so many lists that
  they meet before either has too few lists left; later positions are skipped.
* Skipping by answers: of every list the classes are first compared with one pivot, the most typical. Sets that are similar to
  it have their answer, the component, from the pivot; among them nothing is compared again. For the
  others, known overlaps with a common pivot bound the overlap of two sets from above. Of the pairs
  of different components that pass this, bitmaps of the sets tell most that cannot be similar; the rest are compared.

All comparisons are exact, on 64-bit shingle hashes. What is shuffled for every list is narrow: lists and classes
go by small numbers, and what belongs to a class is joined where it is needed. Whole texts go only to the sets
that they are compared with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm import words
from eventloom.llm.components import components
from eventloom.llm.shared import given_id, prepare, texts, written

SIZE = 5
PERCENT = 80
#: A shingle of this share of all documents is common; there are at most twice the mean set size over this share.
COMMON = 0.001
_COMMON_LEAST = 32
_CHUNK = 4_000_000
#: Bits that tell which documents are asked for: 8 MB.
_PLACES = 1 << 26
#: Sets compared with one set by one task, about.
SALT = 1000
#: Longer lists are cut into blocks before their sets meet.
SHORT = 256
#: Bits of a set's bitmap for each of its shingles, at least.
_SPREAD = 4

_U = np.uint64
SETS = "doc_id long, n long, name long, closed boolean, cold array<long>, hot array<long>"


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that are common in a chunk of documents, and in how many of them they are."""
    held: list[np.ndarray] = []
    docs = size = 0

    def counted() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        common = n >= max(4, COMMON * docs / 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.as_long(found[common])), pa.array(n[common].astype(np.int64))], ["h", "n"]
        )

    for batch in batches:
        for _, hashed, before in words.word_slices(batch.column("text")):
            for k in range(len(before) - 1):
                held.append(words.shingle_set(hashed[before[k] : before[k + 1]], SIZE))
                size += len(held[-1])
            docs += len(before) - 1
            if size > _CHUNK:
                yield counted()
                held, docs, size = [], 0, 0
    if size:
        yield counted()


def _name(own: np.ndarray) -> int:
    """Equal sets have the same."""
    total = words.mix(own ^ _U(0x1234567)).sum(dtype=_U)
    return int(words.mix(np.array([total + _U(len(own))]))[0].view(np.int64))


def _prefixes(common: np.ndarray):
    """Sets with their names and prefixes; of common shingles the prefix has the place in ``common``, below 0."""
    common = np.sort(common.view(_U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for a, hashed, before in words.word_slices(batch.column("text")):
                n, name, closed, cold, hot = [], [], [], [], []
                for k in range(len(before) - 1):
                    own = words.shingle_set(hashed[before[k] : before[k + 1]], SIZE)
                    n.append(len(own))
                    name.append(_name(own))
                    length = len(own) - (PERCENT * len(own) + 99) // 100 + 1 if len(own) else 0
                    if len(common) and len(own):
                        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                        often = common[at] == own
                    else:
                        at, often = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
                    first = own[~often][:length]
                    closed.append(bool((~often).sum() <= length))
                    cold.append(words.as_long(first))
                    hot.append(-1 - at[often][: length - len(first)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(name, pa.int64()),
                        pa.array(closed, pa.bool_()),
                        pa.array(cold, pa.list_(pa.int64())),
                        pa.array(hot, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "name", "closed", "cold", "hot"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``h``, those whose ``h`` is not alone, with a number of their own instead of every ``h``."""
    number = TaskContext.get().partitionId() << 33
    last = None  # the last row so far, and whether it has been given out

    def numbered(rows: pa.RecordBatch, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers), rows.column("class")], ["h", "class"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        same = h[1:] == h[:-1]
        keep = np.append(False, same) | np.append(same, False)
        if last is not None and last[0].column("h")[0].as_py() == h[0]:
            keep[0] = True
            if not last[1]:
                yield numbered(last[0], np.array([number]))
        elif last is not None:
            number += 1
        numbers = number + np.append(0, np.cumsum(~same))
        number = int(numbers[-1])
        last = batch.slice(batch.num_rows - 1), bool(keep[-1])
        yield numbered(batch.filter(pa.array(keep)), numbers[keep])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted by hub, its own first: the overlap of every other text's set with the hub's."""
    hub, key = np.zeros(0, _U), None
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        hubs, salts, classes, names = (batch.column(c).to_pylist() for c in ("hub", "salt", "class", "name"))
        for a, hashed, before in words.word_slices(batch.column("text")):
            for k in range(len(before) - 1):
                own = words.shingle_set(hashed[before[k] : before[k + 1]], SIZE)
                at, salt, other = hubs[a + k], salts[a + k], classes[a + k]
                # another text of a repeated id is another class
                if _name(own) != names[a + k]:
                    continue
                if other == at:
                    hub, key = own, (at, salt)
                    continue
                assert key == (at, salt), "a hub's own set comes first"
                there = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                out.append((at, other, int((hub[there] == own).sum())))
        columns = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["hub", "class", "overlap"])


def _bitmap(own: np.ndarray) -> bytes:
    """One bit for each shingle, in a power of two of bits."""
    bits = np.zeros(1 << max(6, (_SPREAD * len(own) - 1).bit_length()), np.uint8)
    bits[(own & _U(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' sets as bitmaps."""
    for batch in batches:
        for a, hashed, before in words.word_slices(batch.column("text")):
            sets = [words.shingle_set(hashed[before[k] : before[k + 1]], SIZE) for k in range(len(before) - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, len(sets)),
                    pa.array([_name(own) for own in sets], pa.int64()),
                    pa.array([_bitmap(own) for own in sets], pa.binary()),
                ],
                ["doc_id", "name", "bits"],
            )


def _most(n: int, bits: bytes, m: int, other: bytes) -> int:
    """The overlap that two sets of these sizes and bitmaps have at most: a bit of one alone is a shingle of its alone."""
    x, y = (np.unpackbits(np.frombuffer(b, np.uint8)) for b in (bits, other))
    size = min(len(x), len(y))
    x, y = (b.reshape(-1, size).max(axis=0) for b in (x, y))
    return min(n - int((x > y).sum()), m - int((y > x).sum()))


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that are similar as far as their bitmaps tell."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("n", "bits", "m", "hub_bits"))
        keep = [
            _most(n, bits, m, other) >= (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)
            for n, bits, m, other in zip(*columns, strict=True)
        ]
        yield batch.select(["hub", "class", "n", "m"]).filter(pa.array(keep, pa.bool_()))


def _needed(n: Column, m: Column) -> Column:
    """The overlap that two similar sets of these sizes have at least."""
    return F.floor((PERCENT * (n + m) + 99 + PERCENT) / (100 + PERCENT))


def _beyond(n: Column) -> Column:
    """Shingles of a set behind its prefix."""
    return F.floor((PERCENT * n + 99) / 100) - 1


def _of_asked(docs: DataFrame, asked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents but for most of those whose ``key`` is not in ``asked`` (``_doc``), told by one bit per hashed key.

    The bits have a fixed size, so a join must follow; it then shuffles hardly any text that nobody asks for.
    """

    def place(name: Column) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(_PLACES))

    bits = asked.select(place(F.col("_doc")).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    at = docs.withColumn("_place", place(F.col(key)))
    at = at.withColumns({"_bucket": F.bitmap_bucket_number("_place"), "_bit": F.bitmap_bit_position("_place")})
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return at.join(F.broadcast(bits), "_bucket").where(there).select(*docs.columns)


def _compared(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact overlaps of the pairs (``hub, class``)."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SALT).cast("int").alias("salts"))
    others = pairs.join(sizes, "hub").select(
        "hub", F.pmod(F.xxhash64("class"), F.col("salts")).cast("int").alias("salt"), "class"
    )
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("hub").alias("class"))
    asked = others.unionByName(hubs).join(classes.select("class", "doc_id", "name"), "class")
    asked = written(asked.withColumnRenamed("doc_id", "_doc"), "asked")
    # the same plan at every size: texts go to those who ask
    docs = _of_asked(docs, asked)
    sets = docs.join(asked.hint("merge"), docs["doc_id"] == asked["_doc"]).select("hub", "salt", "class", "name", "text")
    # rows of a repeated id and text come twice
    own = (F.col("hub") != F.col("class")).alias("other")
    sets = sets.repartition("hub", "salt").sortWithinPartitions("hub", "salt", own, "class")
    return sets.mapInArrow(_overlaps, "hub long, class long, overlap long").distinct()


def _not_ruled_out(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of the pairs (``hub, class, n, m``) those whose sets' bitmaps leave room for the overlap they need."""
    ends = pairs.select(F.col("hub").alias("class")).union(pairs.select("class")).distinct()
    asked = classes.select("class", F.col("doc_id").alias("_doc"), F.col("name").alias("_name")).join(ends, "class", "left_semi")
    asked = written(asked, "ends")
    bits = _of_asked(docs, asked).mapInArrow(_bitmaps, "doc_id long, name long, bits binary")
    # rows of a repeated id and text come once
    bits = bits.groupBy("doc_id", "name").agg(F.first("bits").alias("bits"))
    bits = bits.join(asked.hint("merge"), (F.col("doc_id") == F.col("_doc")) & (F.col("name") == F.col("_name")))
    bits = written(bits.select("class", "bits"), "bits")
    hub_bits = bits.select(F.col("class").alias("hub"), F.col("bits").alias("hub_bits"))
    both = pairs.join(hub_bits.hint("merge"), "hub").join(bits.hint("merge"), "class")
    return both.mapInArrow(_possible, "hub long, class long, n long, m long")


def _in_list(lists: DataFrame, **values: Column) -> DataFrame:
    """The rows of the lists, with aggregates over the row's list: rare shingles' lists are short, others are joined."""
    # dealt out before the aggregates' arguments are made
    short = lists.where("h >= 0").repartition("h")
    short = short.withColumns({k: v.over(Window.partitionBy("h")) for k, v in values.items()})
    long = lists.where("h < 0")
    return short.unionByName(long.join(long.groupBy("h").agg(*(v.alias(k) for k, v in values.items())), "h"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, representative`` of every document.

    Two documents are linked when their sets' similarity is PERCENT or more; ``component_id`` is the smallest ``doc_id``
    reachable by links, ``representative`` tells whether the row is the first of its component. Null text
    is empty; a text without words has an empty set and is linked with nothing. A null ``doc_id`` counts as
    one before all others. Rows of a repeated ``doc_id`` are linked like others, by their texts; their component
    is the smallest id among all of them. No documents: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs)
    often = rows.select("text").mapInArrow(_often, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    least = max(_COMMON_LEAST, COMMON / 2 * rows.count())
    common = np.array([r["h"] for r in often.where(F.col("n") >= least).select("h").collect()], np.int64)
    sets = rows.mapInArrow(_prefixes(common), SETS).withColumn("no", F.monotonically_increasing_id())
    sets = written(sets, "sets")
    filled = sets.where("n > 0")
    # a class goes by the number of one of its documents
    classes = filled.groupBy("name").agg(
        F.min("no").alias("class"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("closed").alias("closed"), F.first("hot").alias("hot")
    )
    classes = written(classes, "classes")
    narrow = classes.drop("hot")
    # the prefixes stay where they are: a bit tells most copies, the join below the others
    ones = _of_asked(filled.select("no", "cold"), classes.select(F.col("class").alias("_doc")), "no")
    cold = ones.select(F.explode("cold").alias("h"), F.col("no").alias("class")).repartition("h").sortWithinPartitions("h")
    lists = cold.mapInArrow(_shared, "h long, class long").unionByName(
        classes.select(F.explode("hot").alias("h"), "class")
    )
    of_set = Window.partitionBy("class")
    lists = lists.join(narrow.select("class", "n", "closed").hint("merge"), "class")
    lists = written(lists.withColumn("held", F.count("*").over(of_set)), "lists")

    # every class of a list against the list's pivot: the one with most of its prefix in lists, so what
    # copies were made from rather than a copy
    order = F.struct(F.col("held") / (F.col("n") - _beyond(F.col("n"))), F.xxhash64("class"))
    stars = _in_list(lists.drop("closed"), pivot=F.max_by(F.struct("class", "n"), order)).where("class <> pivot.class")
    stars = stars.groupBy(F.col("pivot.class").alias("hub"), "class").agg(
        F.count("*").alias("met"), F.first("n").alias("n"), F.first("pivot.n").alias("m")
    )
    need = _needed(F.col("n"), F.col("m")) - F.greatest(_beyond(F.col("n")), _beyond(F.col("m")))
    in_size = F.least("n", "m") * 100 >= F.greatest("n", "m") * PERCENT
    stars = stars.where(in_size & (F.col("met") * 2 >= need))
    known = written(_compared(rows, stars.select("hub", "class"), narrow), "overlaps")
    size = narrow.select(F.col("class").alias("_c"), F.col("n").alias("_n"))
    known = known.join(size, known["class"] == size["_c"]).withColumnRenamed("_n", "n").drop("_c")
    size = size.join(narrow.select(F.col("class").alias("_c"), F.col("closed").alias("hub_closed")), "_c")
    known = written(known.join(size, known["hub"] == size["_c"]).withColumnRenamed("_n", "m").drop("_c"), "known")
    similar = F.col("overlap") >= _needed(F.col("n"), F.col("m"))
    links = known.where(similar).select(F.col("hub").alias("a"), F.col("class").alias("b"))
    roots = components(links)

    # what is left: pairs of different components that no known overlap rules out
    best = known.groupBy("class").agg(F.max(F.struct("overlap", "hub", "hub_closed")).alias("best"))
    best = best.select("class", "best.hub", "best.hub_closed", F.col("best.overlap").alias("o"))
    roots = written(narrow.select("class").join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")), "roots")
    mixed = lists.select("h", "class", "held").join(roots.hint("merge"), "class")
    mixed = _in_list(mixed, x=F.min("root"), y=F.max("root"), size=F.count("*")).where("x <> y").drop("x", "y", "root")
    mixed = mixed.join(narrow.select("class", "n", "closed").hint("merge"), "class")
    placed = mixed.join(roots.hint("merge"), "class").join(best.hint("merge"), "class", "left")
    # shingles of the prefix that no other set has, if all sets concerned have their rare shingles in the prefix
    rare = F.col("n") - _beyond(F.col("n")) - F.col("held")
    placed = placed.select(
        "h",
        "class",
        "n",
        "size",
        "root",
        F.coalesce("hub", "class").alias("hub"),
        F.coalesce("o", "n").alias("o"),
        F.when(F.col("closed"), rare).otherwise(0).alias("rare"),
        (F.col("closed") & F.coalesce("hub_closed", "closed")).alias("closed"),
    )
    # a set's place in its lists, the shortest first: at most as many as its prefix has shingles
    placed = placed.withColumns(
        {"held": F.count("*").over(of_set), "at": F.row_number().over(of_set.orderBy("size", "h"))}
    )
    placed = written(placed, "placed")
    block = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / PERCENT)) + 1e-9).cast("int")
    short = placed.where(F.col("size") <= SHORT)
    blocks = placed.where(F.col("size") > SHORT).withColumn("block", block)
    near = blocks.withColumn("block", F.explode(F.array("block", F.col("block") + 1)))
    # a set's overlap with another is inside the common pivot or outside it, and what no other has is in neither
    n, m = F.col("b.n"), F.col("a.n")
    both_closed = F.col("a.closed") & F.col("b.closed")
    alone, alone1 = (F.when(both_closed, F.col(c)).otherwise(0) for c in ("b.rare", "a.rare"))
    outside = F.least(n - F.col("b.o") - alone, m - F.col("a.o") - alone1)
    bound = F.least("a.o", "b.o") + F.greatest(outside, F.lit(0))
    meet = _needed(n, m) - F.greatest(_beyond(n), _beyond(m))
    can = (
        (F.col("a.root") != F.col("b.root"))
        & ((m < n) | ((m == n) & (F.col("a.class") < F.col("b.class"))))
        & (m * 100 >= n * PERCENT)
        # two sets that share so many lists meet in one before either has too few lists left
        & (F.col("b.at") <= F.col("b.held") + 1 - meet)
        & (F.col("a.at") <= F.col("a.held") + 1 - meet)
        & ((F.col("a.hub") != F.col("b.hub")) | (bound >= _needed(n, m)))
    )
    pair = [F.col("a.class").alias("hub"), F.col("b.class").alias("class"), n.alias("n"), m.alias("m")]
    # both sides of the short lists are the same rows, dealt out once
    pairs = short.alias("a").join(short.alias("b").hint("merge"), F.col("a.h") == F.col("b.h")).where(can).select(*pair)
    met = (F.col("a.h") == F.col("b.h")) & (F.col("a.block") == F.col("b.block"))
    pairs = pairs.unionByName(near.alias("a").join(blocks.alias("b"), met).where(can).select(*pair)).distinct()
    pairs = written(pairs.join(known.select("hub", "class"), ["hub", "class"], "left_anti"), "pairs")
    pairs = written(_not_ruled_out(rows, pairs, narrow), "possible")
    more = _compared(rows, pairs.select("hub", "class"), narrow).join(pairs, ["hub", "class"])
    links = written(links.unionByName(more.where(similar).select(F.col("hub").alias("a"), F.col("class").alias("b"))), "all-links")
    roots = components(links)

    rooted = narrow.join(roots.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.select("name", "doc_id", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("name", "component_id")
    out = sets.select("doc_id", "n", "name").join(named, "name", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        given_id(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        given_id(component).alias("component_id"),
        (F.col("doc_id") == component).alias("representative"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that come first in their component, unchanged, with all their columns.

    Rows of a repeated ``doc_id`` stay together, if one of them comes first.
    """
    first = jaccard_components(docs).where("representative").select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, docs["doc_id"].cast("long").eqNullSafe(first["_first"]), "left_semi")
