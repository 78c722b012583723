"""Hard negatives by exact integer scores, from Kronecker-packed products.

Vectors become whole numbers. The components of several candidates, made positive by a bias, are laid side by side
in fields of one wide integer; a product with one (biased) component of an anchor multiplies all of them at once,
and the sum over the components is unpacked into exact scores. Fields are as wide as the largest possible sum. As
many as fit into 53 bits share a double, whose matrix products are exact there; fields that do not fit share one
Python integer for the whole block.

Anchors and candidates are dealt into blocks of bounded size, whatever their labels' sizes. Every block of anchors
meets every block of candidates once: first inside the labels, for the positives, then over all rows, for
the negatives. Each meeting yields the few best rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.shared import given_id, known_id, prepare, written

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of a block of anchors and of candidates, on average.
ANCHORS, CANDIDATES = 1024, 2048
#: Blocks of candidates that one block of anchors is sent to together.
TOGETHER = 8
#: Bits of a double that count whole numbers exactly.
EXACT = 53
_SIDE = 1 << 62


def _fields(anchors: np.ndarray, candidates: np.ndarray) -> tuple[int, int, int]:
    """Bias of the anchors, bias of the candidates, and bits of a field."""
    a, c = int(max(-anchors.min(), 0)), int(max(-candidates.min(), 0))
    most = anchors.shape[1] * (int(anchors.max()) + a) * (int(candidates.max()) + c)
    return a, c, max(most.bit_length(), 1)


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors with all candidates, both rows of whole numbers held as doubles.

    Whole 64-bit numbers, or Python's where a score might not fit.
    """
    n, m = len(anchors), len(candidates)
    if not n or not m or not anchors.shape[1]:
        return np.zeros((n, m), np.int64)
    a, c, bits = _fields(anchors, candidates)
    fields = min(EXACT // bits, 8)
    exact = max(abs(anchors).max(), abs(candidates).max(), a, c) < 1 << EXACT - 2
    if not fields or not exact:
        return _wide(anchors, candidates, a, c, bits)
    left, right = anchors + a, candidates + c
    size = -(-m // fields)
    packed = np.zeros((size, right.shape[1]))
    for f in range(fields):  # field f holds the f-th share of the candidates
        part = right[f * size : (f + 1) * size]
        packed[: len(part)] += part * float(1 << f * bits)
    sums = (left @ packed.T).astype(np.int64)
    out = np.empty((n, fields * size), np.int64)
    for f in range(fields):
        out[:, f * size : (f + 1) * size] = sums >> f * bits & (1 << bits) - 1
    # sum (x + a)(y + c) = sum xy + a sum (y + c) + c sum x
    out = out[:, :m] - (right.sum(1) * a).astype(np.int64)[None, :]
    return out - (anchors.sum(1) * c).astype(np.int64)[:, None]


def _wide(anchors: np.ndarray, candidates: np.ndarray, a: int, c: int, bits: int) -> np.ndarray:
    """The same with one integer for each component of all candidates."""
    left = [[int(x) for x in row] for row in anchors.tolist()]
    right = [[int(y) + c for y in row] for row in candidates.tolist()]
    packed = [sum(row[d] << f * bits for f, row in enumerate(right)) for d in range(candidates.shape[1])]
    less = [a * sum(row) for row in right]
    mask = (1 << bits) - 1
    out = np.empty((len(left), len(right)), object)
    for i, row in enumerate(left):
        total = sum((x + a) * wide for x, wide in zip(row, packed, strict=True))
        shift = c * sum(row)
        for f in range(len(right)):
            out[i, f] = (total >> f * bits & mask) - less[f] - shift
    fits = np.vectorize(lambda s: abs(s) < _SIDE, otypes=[bool])(out)
    return out.astype(np.int64) if fits.all() else out


def _order(found: np.ndarray, barred: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Per row the columns by falling score, ties by column, barred ones last; and the scores in that order.

    Barred columns and scores beyond 64 bits have the lowest score.
    """
    if found.dtype == object:
        beyond = np.vectorize(lambda s: abs(s) >= _SIDE, otypes=[bool])(found)
        found = np.where(beyond, -_SIDE, found).astype(np.int64)
    if barred is not None:
        found = np.where(barred, -_SIDE, found)
    m = found.shape[1]
    free = found[found > -_SIDE]
    if free.size and max(int(free.max()), -int(free.min())) < (1 << 61) // m:
        least = int(free.min()) - 1
        keys = (-np.maximum(found, least)) * m + np.arange(m)
        keys.sort(axis=1)
        order = keys % m
        sorted_scores = -(keys // m)
        return order, np.where(sorted_scores == least, -_SIDE, sorted_scores)
    order = np.argsort(-found, axis=1, kind="stable")
    return order, np.take_along_axis(found, order, 1)


def _block(values: pa.ListScalar, dims: int) -> dict[str, np.ndarray]:
    """A block's rows as arrays, ordered by id, then row."""
    items = values.values
    out = {
        name: items.field(name).to_numpy(zero_copy_only=False) for name in ("id", "row", "label") if _has(items, name)
    }
    flat = pa.compute.list_flatten(items.field("e")).to_numpy(zero_copy_only=False)
    out["e"] = flat.reshape(len(items), dims)
    order = np.lexsort((out["row"], out["id"]))
    out = {name: column[order] for name, column in out.items()}
    if _has(items, "positives"):
        lists = items.field("positives").to_pylist()
        out["positives"] = [lists[i] for i in order.tolist()]
    return out


def _has(items: pa.StructArray, name: str) -> bool:
    return items.type.get_field_index(name) >= 0


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            dims = batch.column("dims")[i].as_py()
            yield _block(batch.column("anchors")[i], dims), _block(batch.column("candidates")[i], dims)


def _best(count: int):
    """The best candidates of each anchor in a pair of blocks of one label, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right in _meetings(batches):
            barred = left["row"][:, None] == right["row"][None, :]
            order, score = _order(scores(left["e"], right["e"]), barred)
            order, score = order[:, :count], score[:, :count]
            i, j = np.nonzero(score > -_SIDE)
            at = order[i, j]
            yield pa.RecordBatch.from_arrays(
                [left["row"][i], right["id"][at], right["row"][at], score[i, j]], ["anchor", "id", "row", "score"]
            )

    return run


def _hard(count: int, low: int, high: int):
    """The best candidates of other labels below each of an anchor's positives in a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right in _meetings(batches):
            barred = left["label"][:, None] == right["label"][None, :]
            order, score = _order(scores(left["e"], right["e"]), barred)
            rising = -score
            rows: list[tuple] = []
            for i, positives in enumerate(left["positives"]):
                for p in positives:
                    most, least = high * p["score"] // 100, -(-low * p["score"] // 100)
                    if most < least:
                        continue
                    first = int(np.searchsorted(rising[i], -most))
                    for j in range(first, min(first + count, score.shape[1])):
                        found = int(score[i, j])
                        if found < least or found == -_SIDE:
                            break
                        at = order[i, j]
                        rows.append((left["row"][i], p["number"], right["id"][at], right["row"][at], found))
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], ["anchor", "number", "id", "row", "score"]
            )

    return run


def _dealt(rows: DataFrame, blocks: Column, *keys: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows gathered into blocks by a hash of their number: ``keys, block, blocks, items``."""
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    items = F.collect_list(F.struct("id", "row", "e", *more)).alias("items")
    return dealt.groupBy(*keys, "blocks", "block").agg(items)


def _met(anchors: DataFrame, candidates: DataFrame, *keys: str) -> DataFrame:
    """Every block of anchors with every block of candidates of the same keys, in groups of blocks."""
    groups = F.ceil(F.col("blocks") / F.lit(TOGETHER)).cast("long")
    right = candidates.withColumn("group", F.pmod("block", groups))
    sizes = candidates.select(*keys, groups.alias("groups")).distinct()
    left = anchors.join(sizes, [*keys])
    left = left.select(
        *keys,
        F.col("block").alias("a"),
        F.col("items").alias("anchors"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"),
    )
    times = anchors.select(*keys, F.col("blocks").alias("times")).distinct()
    right = right.join(times, [*keys]).select(
        *keys,
        "group",
        F.col("items").alias("candidates"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("a"),
    )
    return left.join(right, [*keys, "group", "a"]).select("dims", "anchors", "candidates")


def whole(vectors: DataFrame, scale: int) -> Column:
    """Components times the scale, rounded down, as doubles; null where one is null or not finite."""
    e = vectors["embedding"].cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform(e, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return F.when(fine, floors)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels below it.

    ``anchors`` marks the rows of ``vectors`` (``vec_id, embedding, label``) to mine for. The score is the inner product of
    the components times ``scale``, rounded down; higher scores come first, ties by smaller vec_id. A negative's score lies
    between ``low`` and ``high`` hundredths of the positive's. The result has ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``, fewer rows where there are fewer.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of different
    dimensions have no score, nor has a pair whose score needs more than 62 bits. A null vec_id sorts first. Repeated
    rows are rows by themselves. No anchors or no vectors: no rows. Other columns are ignored.
    """
    prepare(vectors.sparkSession)
    label = vectors["label"] if label is None else label
    kind = vectors.select(label.alias("label")).schema["label"].dataType
    code = label.cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(label)
    rows = vectors.select(
        known_id(vectors["vec_id"]).alias("id"),
        F.when(label.isNotNull(), code).alias("label"),
        whole(vectors, scale).alias("e"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.where("label IS NOT NULL AND e IS NOT NULL").withColumn("dims", F.size("e"))
    rows = written(rows, "vectors")
    sizes = rows.groupBy("dims", "label").agg(
        F.ceil(F.count("*") / F.lit(CANDIDATES)).alias("many"),
        F.ceil(F.count_if("anchor") / F.lit(ANCHORS)).alias("few"),
    )
    sized = rows.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, ["dims", "label"])
    asked = sized.where("anchor")
    near = _met(
        _dealt(asked, F.col("few"), "dims", "label"),
        _dealt(sized.where("few > 0"), F.col("many"), "dims", "label"),
        "dims",
        "label",
    ).mapInArrow(_best(positives), "anchor long, id long, row long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    near = near.withColumn("number", F.row_number().over(best).cast("long")).where(F.col("number") <= positives)
    near = written(near, "positives")

    found = near.groupBy("anchor").agg(F.collect_list(F.struct("number", "score")).alias("positives"))
    asked = rows.where("anchor").join(found.withColumnRenamed("anchor", "row"), "row")
    sizes = rows.groupBy("dims").agg(
        F.ceil(F.count("*") / F.lit(CANDIDATES)).alias("many"),
        F.ceil(F.count_if("anchor") / F.lit(ANCHORS)).alias("few"),
    )
    below = _met(
        _dealt(asked.join(sizes, "dims"), F.col("few"), "dims", more=("label", "positives")),
        _dealt(rows.join(sizes.where("few > 0"), "dims"), F.col("many"), "dims", more=("label",)),
        "dims",
    ).mapInArrow(_hard(negatives, low, high), "anchor long, number long, id long, row long, score long")
    best = Window.partitionBy("anchor", "number").orderBy(F.desc("score"), "id", "row")
    below = below.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    pairs = near.select("anchor", "number", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    own = rows.where("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("own"))
    out = below.join(pairs, ["anchor", "number"]).join(own, "anchor")
    return out.select(
        given_id(F.col("own")).alias("anchor_id"),
        given_id(F.col("positive")).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        given_id(F.col("id")).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
