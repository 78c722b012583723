"""Embedding near-dedup by sorted projection passes.

In every pass each vector gets a string of bits, the signs of as many random projections. The vectors of a
label are ordered lexicographically by these strings, and each is compared with the WINDOW that follow it.
Pairs whose cosine is the threshold or more are links; the passes' links are united to components.

Vectors at an angle of x agree in a bit with chance 1 - x/180, so a pair at cosine 0.93 (21.6 degrees) meets in
a pass with chance of about 0.88 to the power of the bits that a vector shares with the WINDOW-th after it, and
misses all passes with the rest's power. These bits grow with the label and with how much its vectors lean one way, so
they are measured in an order of all vectors first; passes and bits follow from them, for a recall of RECALL
in labels of every size. Components need fewer passes: one chain of found links suffices.

A dense group has more links than its windows show. The links of a component's members among each
other are therefore counted in blocks of the component against blocks, as sums, never as pairs.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from eventloom.llm.components import components
from eventloom.llm.shared import given_id, known_id, prepare, written

COSINE = 0.93
#: Passes and bits at least; bits that a long holds, and passes at most (beyond these a warning gives the recall).
PASSES = 20
BITS = 32
MOST_PASSES = 512
MOST_BITS = 62
#: Share of the pairs at the threshold that meet, in the mean.
RECALL = 0.99
WINDOW = 32
#: Consecutive places of an order, and members of a component, that one task handles at a time.
BLOCK = 2048
PART = 1024
SEED = 93

_planes: dict[tuple[int, int, int], np.ndarray] = {}


def planes(size: int, passes: int, bits: int) -> np.ndarray:
    """Random directions for vectors of a size, the same everywhere."""
    if (size, passes, bits) not in _planes:
        _planes[size, passes, bits] = np.random.default_rng([SEED, size]).standard_normal((size, passes * bits))
    return _planes[size, passes, bits]


def _vectors(column: pa.Array, single: bool) -> list[np.ndarray | None]:
    """Each usable vector; None for a null, a zero or one with a null or non-finite component."""
    kind, out = (np.float32 if single else np.float64), []
    for value in column:
        if not value.is_valid or not len(value.values) or value.values.null_count:
            out.append(None)
            continue
        vector = value.values.to_numpy(zero_copy_only=False).astype(kind)
        out.append(vector if np.isfinite(vector).all() and vector.any() else None)
    return out


def _bytes(single: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else (v + 0.0).tobytes() for v in _vectors(batch.column("embedding"), single)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(found, pa.binary())],
                ["vec_id", "label", "vector"],
            )

    return run


def unit(data: list[bytes], single: bool) -> np.ndarray:
    """Vectors of one size as rows of unit length, in double precision."""
    rows = np.frombuffer(b"".join(data), np.float32 if single else np.float64).reshape(len(data), -1).astype(float)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _strings(single: bool, passes: int, bits: int):
    """A row for each pass: the string as a long whose order is the string's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            codes = np.zeros((len(vectors), passes), np.int64)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = unit([vectors[i] for i in at], single)
                signs = (rows @ planes(rows.shape[1], passes, bits) > 0).reshape(len(at), passes, bits)
                codes[at] = signs @ weights
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("group"),
                    pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1)), passes).cast(pa.list_(pa.int64())),
                ],
                ["node", "group", "codes"],
            )

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a sorted partition."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                batch.column("pass"),
                batch.column("group"),
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(at, at + n)),
            ],
            ["node", "pass", "group", "part", "at"],
        )
        at += n


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, one table each; only one such run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True)):
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _shared_bits(single: bool, cosine: float):
    """How many vectors of each group share how many bits with the WINDOW-th after them, unless these are linked.

    Vectors with so many links around them are found by any pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            held = rows.slice(max(0, rows.num_rows - WINDOW)).to_batches()[0] if rows.num_rows else None
            group, code = rows["group"].to_numpy(), rows["code"].to_numpy()
            low = np.flatnonzero(group[WINDOW:] == group[:-WINDOW])
            vectors = rows["vector"].to_pylist()
            if not len(low):
                continue
            far = np.zeros(len(low), bool)
            sizes = np.array([len(vectors[i]) for i in low])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                one, two = (unit([vectors[i] for i in low[at] + k], single) for k in (0, WINDOW))
                far[at] = np.einsum("ij,ij->i", one, two) < cosine
            low = low[far]
            differ = code[low] ^ code[low + WINDOW]
            same = [MOST_BITS - int(x).bit_length() for x in differ.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[low], pa.int64()), pa.array(same, pa.int32())], ["group", "same"]
            )

    return run


def plan(shared: list[tuple[int, int, int]], cosine: float) -> tuple[int, int, float]:
    """Passes and bits from (label's size class, bits shared, vectors), and the least recall over the classes."""
    agree = 1 - np.arccos(min(1.0, max(-1.0, cosine))) / np.pi
    passes, bits, recall = PASSES, BITS, 1.0
    for one in {c for c, _, _ in shared}:
        same = np.array([s for c, s, _ in shared if c == one])
        n = np.array([k for c, _, k in shared if c == one], float)
        chance = agree ** (same + 1.0)

        def found(k: int, chance: np.ndarray = chance, n: np.ndarray = n) -> float:
            return float(1 - (n @ (1 - chance) ** k) / n.sum())

        low, high = PASSES, MOST_PASSES
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if found(middle) >= RECALL else (middle + 1, high)
        passes, recall = max(passes, low), min(recall, found(low))
        order = np.argsort(same)
        often = np.searchsorted(np.cumsum(n[order]), 0.999 * n.sum())
        bits = max(bits, min(MOST_BITS, int(same[order][min(often, len(same) - 1)]) + 4))
    return passes, bits, recall


class Union:
    """Union-find over numbers from 0."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _windows(single: bool, cosine: float):
    """Links among consecutive places, as one star for each connected part of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["block"]):
            a, b = [], []
            node, order = block["node"].to_numpy(), block["order"].to_numpy()
            vectors = block["vector"].to_pylist()
            edges = [0, *(np.flatnonzero(order[1:] != order[:-1]) + 1).tolist(), len(order)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                rows = unit(vectors[low:high], single)
                union = Union(high - low)
                for k in range(1, min(WINDOW, high - low - 1) + 1):
                    near = np.flatnonzero(np.einsum("ij,ij->i", rows[:-k], rows[k:]) >= cosine)
                    for i in near.tolist():
                        union.join(i, i + k)
                for i in range(high - low):
                    if (root := union.root(i)) != i:
                        a.append(node[low + i])
                        b.append(node[low + root])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _counts(single: bool, cosine: float):
    """Of each vector of a block, the vectors of the other block that it is linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in groups(batches, ["root", "x", "y"]):
            node, side, copies = (pair[c].to_numpy() for c in ("node", "side", "copies"))
            rows = unit(pair["vector"].to_pylist(), single)
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if pair["x"][0].as_py() == pair["y"][0].as_py():
                near = rows @ rows.T >= cosine
                np.fill_diagonal(near, False)
                found = near @ copies
            else:
                near = rows[one] @ rows[two].T >= cosine
                found = np.zeros(len(rows), np.int64)
                found[one], found[two] = near @ copies[two], copies[one] @ near
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(found.astype(np.int64))], ["node", "n"])

    return run


def _planned(classes: DataFrame, single: bool, cosine: float) -> tuple[int, int]:
    """Passes and bits for these vectors, from one order of all of them."""
    codes = classes.select("node", "group", "vector").mapInArrow(
        _strings(single, 1, MOST_BITS), "node long, group long, codes array<long>"
    )
    codes = codes.select("node", F.col("codes")[0].alias("code")).join(classes.select("node", "group", "vector"), "node")
    keys = ["group", "code", "node"]
    order = codes.repartitionByRange(*keys).sortWithinPartitions(*keys).select("group", "code", "vector")
    same = order.mapInArrow(_shared_bits(single, cosine), "group long, same int")
    same = same.groupBy("group", "same").agg(F.count("*").alias("n"))
    sizes = classes.groupBy("group").agg(F.floor(F.log2(F.count("*"))).cast("int").alias("size"))
    shared = same.join(sizes, "group").groupBy("size", "same").agg(F.sum("n").alias("n")).collect()
    passes, bits, recall = plan([(r["size"], r["same"], r["n"]) for r in shared], cosine)
    if recall < RECALL:
        warnings.warn(f"{passes} passes find about {recall:.2f} of the pairs at cosine {cosine}", stacklevel=3)
    return passes, bits


def link_vectors(embeddings: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Vectors are compared within one ``label`` and one length. Equal vectors are handled as one, and count as
    each other's links. A null label, and a vector that is null, empty, zero or holds a null or non-finite
    component, has no links and is its own component. A null ``vec_id`` counts as the smallest; rows of a
    repeated ``vec_id`` are vectors of their own under one id. No vectors: no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    element = embeddings.schema["embedding"].dataType
    single = isinstance(element, ArrayType) and isinstance(element.elementType, FloatType)
    rows = embeddings.select(
        known_id(embeddings["vec_id"]).alias("vec_id"),
        embeddings["label"].cast("string").alias("label"),
        embeddings["embedding"].alias("embedding"),
    )
    rows = rows.mapInArrow(_bytes(single), "vec_id long, label string, vector binary")
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull()
    rows = rows.select(
        "vec_id",
        F.when(usable, F.xxhash64("label", F.length("vector"))).alias("group"),
        F.when(usable, F.xxhash64("label", "vector")).alias("node"),
        F.when(usable, F.col("vector")).alias("vector"),
    )
    rows = written(rows, "vectors")
    classes = rows.where("node is not null").groupBy("node", "group", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")
    )
    classes = written(classes, "classes")

    passes, bits = _planned(classes, single, cosine)
    strings = classes.select("node", "group", "vector").mapInArrow(
        _strings(single, passes, bits), "node long, group long, codes array<long>"
    )
    strings = strings.select("node", "group", F.posexplode("codes").alias("pass", "code"))
    keys = ["pass", "group", "code", "node"]
    order = strings.repartitionByRange(*keys).sortWithinPartitions(*keys)
    order = written(order.mapInArrow(_numbered, "node long, pass int, group long, part int, at long"), "order")
    # places before each partition: a row per partition
    sizes = {r["part"]: r["n"] for r in order.groupBy("part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    place = F.col("at") + F.col("start")
    halo = (F.col("place") % BLOCK < WINDOW) & (F.col("place") >= BLOCK)
    block = F.floor(F.col("place") / BLOCK)
    placed = order.join(starts, "part").select("node", F.xxhash64("pass", "group").alias("order"), place.alias("place"))
    blocks = placed.select(
        "node", "order", "place", F.explode(F.when(halo, F.array(block - 1, block)).otherwise(F.array(block))).alias("block")
    )
    blocks = blocks.join(classes.select("node", "vector"), "node")
    blocks = blocks.repartition("block").sortWithinPartitions("block", "place")
    links = blocks.mapInArrow(_windows(single, cosine), "a long, b long")
    roots = written(components(links), "roots")

    grouped = classes.join(roots, "node")
    parts = roots.groupBy("root").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    own = grouped.join(parts, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    own = own.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    own = own.select(
        "root",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node",
        "copies",
        "vector",
    )
    pairs = own.repartition("root", "x", "y").sortWithinPartitions("root", "x", "y")
    counts = pairs.mapInArrow(_counts(single, cosine), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))

    smallest = grouped.groupBy("root").agg(F.min("vec_id").alias("component"))
    named = grouped.select("node", "root").join(smallest, "root").join(counts, "node", "left")
    named = classes.select("node", "copies", F.col("vec_id").alias("first")).join(named, "node", "left")
    named = named.select(
        "node",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component"),
    )
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id", "node").join(named, "node", "left").select(
        given_id(F.col("vec_id")).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        given_id(component).alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
