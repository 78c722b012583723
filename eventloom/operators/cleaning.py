"""Event and candidate cleaning."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import decays
from eventloom.operators.components import components
from eventloom.operators.ordered import islands, numbered
from eventloom.operators.ranges import range_join
from eventloom.session import stored

# Defaults of the pile-up test, cut without a usable beam-spot variance.
MIN_CONTRIBUTORS, MIN_Z, SIGMA_Z, SIGMA_XY, SIGMA_SPOT_Z = 5, 0.8, 3.0, 2.0, 5.0
NO_SPOT, SMALLEST_SPOT = 99999.0, 1e-4
SMALLEST_Z_VARIANCE = 1e-9
# Weighted distance below which vertices are one, unknown bunch number.
SPLIT_DISTANCE = 10.0
UNKNOWN_BUNCH = -100
#: Vertices of a stretch that one task decides; longer stretches are decided in rounds.
STRETCH = 1000
#: Vertices of stretches that are decided together with all others of the same size.
TOGETHER = 32


def is_pile_up(
    primary_z: Column, primary_var_z: Column, vertex: dict[str, Column], spot: dict[str, Column],
    min_contributors=MIN_CONTRIBUTORS, min_z: float = MIN_Z,
) -> Column:
    """Whether a further vertex is a separate interaction inside the beam spot.

    ``vertex``: x y z xx yy zz contributors; ``spot``: x y z and variances xx yy zz.
    """
    apart = F.abs(vertex["z"] - primary_z)

    def inside(axis: str, cut: Column) -> Column:
        limit = F.when(spot[axis * 2] < SMALLEST_SPOT, F.lit(NO_SPOT)).otherwise(cut)
        return F.abs(vertex[axis] - spot[axis]) < limit

    return (
        (vertex["contributors"] >= min_contributors)
        & (apart > min_z)
        & inside("z", SIGMA_SPOT_Z * F.sqrt(spot["zz"]))
        & inside("x", SIGMA_XY * F.sqrt(vertex["xx"] + spot["xx"]))
        & inside("y", SIGMA_XY * F.sqrt(vertex["yy"] + spot["yy"]))
        & (apart > SIGMA_Z * F.sqrt(primary_var_z + vertex["zz"]))
    )


def contributors_by_multiplicity(tracklets: Column) -> Column:
    """Least contributors of a pile-up vertex by number of tracklets."""
    return F.when(tracklets < 20, 3).when(tracklets < 50, 4).otherwise(5)


def pair_eta(p: decays.Vector) -> Column:
    size = decays.norm(p)
    return 0.5 * F.log((size + p[2]) / (size - p[2] + 1e-13))


def clean_pairs(
    pairs: DataFrame, cascades: DataFrame, keys: Sequence[str], hypotheses: Sequence[dict], eta_max: float, field: Column
) -> DataFrame:
    """Decay pairs that survive cleaning.

    Found online: kept if used by a cascade, else dropped beyond ``eta_max`` or outside
    the mass window of every hypothesis.  Found offline: dropped beyond ``eta_max`` if not
    used.  A pair whose legs are those of a cascade is never dropped.
    ``pairs`` has on_fly, used, pos_id, neg_id and the leg momenta pp*, np*.
    """
    pos = tuple(F.col(f"pp{a}") for a in "xyz")
    neg = tuple(F.col(f"np{a}") for a in "xyz")
    total = decays.add(pos, neg)
    pt = F.sqrt(total[0] * total[0] + total[1] * total[1])
    in_window = F.lit(False)
    for h in hypotheses:
        margin = decays.mass_margin(pt, field, h["sigmas"], h["sigma"], h["c0"], h["c1"], h["add"])
        in_window = in_window | (F.abs(decays.pair_mass(pos, neg, h["m0"], h["m1"]) - h["mass"]) < margin)
    wide = F.abs(pair_eta(total)) > eta_max
    bad = F.when(F.col("on_fly"), ~F.col("used") & (wide | ~in_window)).otherwise(wide & ~F.col("used"))
    legs = [*keys, "pos_id", "neg_id"]
    owned = cascades.select(*legs).distinct().withColumn("_owned", F.lit(True))
    return pairs.join(owned, legs, "left").where(~bad | F.coalesce("_owned", F.lit(False))).drop("_owned")


def removal_candidates(
    track_table: DataFrame, used: DataFrame, keys: Sequence[str], keep_flags: int, z_cut: float
) -> DataFrame:
    """Tracks that nothing refers to and that pass far from the vertex.

    ``track_table``: flags, dz and its variance cov_zz, x, z, tgl, vertex_z, and spared
    (heading for the second calorimeter).  Without a usable variance the distance is
    that of a straight line.
    """
    line = F.col("z") - F.col("tgl") * F.col("x") - F.col("vertex_z")
    distance = F.when(F.col("cov_zz") < SMALLEST_Z_VARIANCE, line).otherwise(F.col("dz"))
    far = (
        (F.col("flags").bitwiseAND(F.lit(keep_flags).cast("bigint")) == 0)
        & (F.abs(distance) >= z_cut)
        & ~F.col("spared")
    )
    return track_table.where(far).join(used, [*keys, "obj_id"], "left_anti").select(*keys, "obj_id")


def spare_kinks(candidates: DataFrame, kinks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates left once both legs of every kink are either kept or removed together.

    A kink with one leg kept spares the other, which may spare a further kink's leg, and
    so on until nothing changes: a group of candidates linked by kinks stays whole, spared
    if any of them has a kink with a leg that is no candidate.  (Going through the kinks only
    once, from the last, the outcome would depend on their order.)  Groups take about log2 of
    their longest chain in rounds.  A missing leg (null) is no candidate, so it spares the other.
    """
    keys = list(keys)
    ids = stored(candidates.select(*keys, "obj_id").distinct(), "candidates")
    mothers = ids.select(*keys, F.col("obj_id").alias("mother_id"), F.lit(True).alias("_mother"))
    daughters = ids.select(*keys, F.col("obj_id").alias("daughter_id"), F.lit(True).alias("_daughter"))
    legs = kinks.select(*keys, "mother_id", "daughter_id").distinct()
    known = legs.join(mothers, [*keys, "mother_id"], "left").join(daughters, [*keys, "daughter_id"], "left")
    known = stored(known.where("_mother OR _daughter"), "kinks")
    half = known.where("_mother IS NULL OR _daughter IS NULL")
    seeds = half.select(*keys, F.when(F.col("_mother"), F.col("mother_id")).otherwise(F.col("daughter_id")).alias("obj_id"))
    whole = known.where("_mother AND _daughter")
    group = components(whole.select(*keys, F.col("mother_id").alias("a"), F.col("daughter_id").alias("b")), keys)
    touched = group.join(seeds.distinct(), [*keys, "obj_id"], "left_semi").select(*keys, "root").distinct()
    spared = group.join(touched, [*keys, "root"], "left_semi").select(*keys, "obj_id")
    spared = spared.unionByName(seeds).distinct()
    return candidates.join(spared, [*keys, "obj_id"], "left_anti")


def reindexed(objects: DataFrame, keys: Sequence[str], order: str, block: Column) -> DataFrame:
    """Dense positions from 0 of the objects that are left: the old -> new map of each event."""
    ranked = numbered(objects, keys, block, [order])
    return ranked.withColumn("new_idx", F.col("rank") - 1).drop("rank")


def relabel(references: DataFrame, index: DataFrame, keys: Sequence[str], link: str, object_id: str = "obj_id") -> DataFrame:
    """Replace a link to an object by the object's new position; null if it was removed."""
    named = index.select(*keys, F.col(object_id).alias(link), F.col("new_idx").alias("_new"))
    return references.join(named, [*keys, link], "left").withColumn(link, F.col("_new")).drop("_new")


def merge_split_vertices(
    vertices: DataFrame, keys: Sequence[str], cut: float = SPLIT_DISTANCE, block_width: float = 8.0
) -> DataFrame:
    """Marks split vertices (``discarded``) and passes bunch numbers on to the larger one.

    From the largest down, a vertex claims each smaller one whose weighted distance times
    its size is below ``cut``, unless both have different known bunch numbers.  Vertices
    farther apart in z than the cut allows for any size cannot meet, so an event first
    falls apart into stretches along z.  Stretches of up to STRETCH vertices are decided in
    Python, in Arrow batches, longer ones in rounds: a vertex decides as soon as no larger
    one within reach of it, or of what it may claim, is undecided.  A covariance that cannot
    be inverted, or a negative square, makes the distance -1, which is below any cut, so an
    event with such a covariance is one stretch.  Needs obj_id, x, y, z, cov_xx, cov_xy, cov_yy, cov_zz,
    n_indices (at least 1) and bunch.
    """
    keys = list(keys)
    others = [c for c in vertices.columns if c not in (*keys, "bunch")]
    size = F.least(F.col("cov_xx") * F.col("cov_yy") - F.col("cov_xy") * F.col("cov_xy"), "cov_zz")
    widest = vertices.groupBy(*keys).agg(
        F.max("cov_zz").alias("_widest"), F.min("n_indices").alias("_least"), F.min(size).alias("_size")
    )
    df = vertices.join(widest, keys)
    reach = cut / F.col("_least") * F.sqrt(2 * F.col("_widest"))
    df = df.withColumn("_reach", F.when(F.col("_size") > 0, reach).otherwise(float("inf"))).drop("_size")
    df = islands(
        df, keys, F.floor(F.col("z") / block_width), ["z", "obj_id"], {"z": F.col("z")},
        lambda: F.col("z") - F.col("_prev_z") > F.col("_reach"), uses=["z", "_reach"], name="_stretch",
    )
    row = F.struct((-F.col("n_indices")).alias("_rank"), F.col("obj_id").alias("_id"), *others, "bunch")
    def longer(of: DataFrame, *by: str) -> DataFrame:
        return of.groupBy(*by).agg(F.count("*").alias("_vertices")).where(F.col("_vertices") > STRETCH).drop("_vertices")

    crowded = None
    if not longer(vertices, *keys).isEmpty():  # no stretch is longer than its event
        df = stored(df, "stretches")
        long = longer(df, *keys, "_stretch")
        crowded = df.join(long, [*keys, "_stretch"])
        df = df.join(long, [*keys, "_stretch"], "left_anti")
    stretches = df.groupBy(*keys, "_stretch").agg(F.sort_array(F.collect_list(row)).alias("v"))

    @F.arrow_udf("array<struct<bunch:int,discarded:boolean>>")
    def decide(found: pa.Array, bunches: pa.Array) -> pa.Array:
        return _decided(found, bunches, cut)

    numbers = F.transform("v", lambda r: F.array(*[r[c].cast("double") for c in _GEOMETRY]))
    several = stretches.where(F.size("v") > 1).withColumn(
        "d", decide(numbers, F.transform("v", lambda r: r["bunch"].cast("int")))
    )
    alone = stretches.where(F.size("v") == 1).withColumn(
        "d", F.transform("v", lambda r: F.struct(r["bunch"].cast("int").alias("bunch"), F.lit(False).alias("discarded")))
    )
    rows = several.unionByName(alone).select(*keys, F.explode(F.arrays_zip("v", "d")).alias("r"))
    decided = rows.select(*keys, *[F.col(f"r.v.{c}").alias(c) for c in others], "r.d.bunch", "r.d.discarded")
    if crowded is None:
        return decided
    return decided.unionByName(_claims_in_rounds(crowded, [*keys, "_stretch"], cut).select(decided.columns))


def _links(vertices: DataFrame, on: Sequence[str], cut: float) -> DataFrame:
    """Larger and smaller vertex (``a, b``), their weighted distance and bunch numbers, where below the cut."""
    geometry = ("x", "y", "cov_xx", "cov_xy", "cov_yy", "cov_zz", "n_indices", "bunch", "_broken")
    place = F.struct((-F.col("n_indices")).alias("rank"), "obj_id")
    size = F.least(F.col("cov_xx") * F.col("cov_yy") - F.col("cov_xy") * F.col("cov_xy"), "cov_zz")
    rows = vertices.withColumns({"_place": place, "_broken": ~F.coalesce(size > 0, F.lit(False))})

    def side(tag: str, *more: Column) -> DataFrame:
        columns = [F.col(c).alias(f"{tag}_{c}") for c in geometry]
        return rows.select(*on, F.col("_place").alias(tag), (F.col("z") * 1000).alias(f"{tag}_z"), *columns, *more)

    reach = F.when(F.col("_broken"), float("inf")).otherwise(
        1000 * cut / F.col("n_indices") * F.sqrt(F.col("cov_zz") + F.col("_widest"))
    )
    z = F.col("z") * 1000
    small = side("b", (z - reach).alias("_from"), (z + reach).alias("_to"))
    near = range_join(side("a"), small, "a_z", "_from", "_to", on=on).drop("_from", "_to")
    # a broken larger vertex reaches every smaller one
    far = F.lit(float("inf"))
    broken = side("a", (-far).alias("_from"), far.alias("_to")).where("a__broken")
    sound = side("b").where("NOT b__broken")
    near = near.where("NOT a__broken OR b__broken").unionByName(
        range_join(sound, broken, "b_z", "_from", "_to", on=on).drop("_from", "_to")
    )
    d = {c: F.col(f"a_{c}") - F.col(f"b_{c}") for c in ("x", "y")}
    dz = (F.col("a_z") - F.col("b_z")) / 1000
    xx, xy, yy, zz = (F.col(f"a_cov_{c}") + F.col(f"b_cov_{c}") for c in ("xx", "xy", "yy", "zz"))
    plane = F.try_divide(yy * d["x"] * d["x"] + xx * d["y"] * d["y"] - 2 * xy * d["x"] * d["y"], xx * yy - xy * xy)
    square = plane + F.try_divide(dz * dz, zz)
    distance = F.when(square > 0, F.sqrt(square)).otherwise(-1.0) * F.col("b_n_indices")
    below = near.where(F.col("a") < F.col("b")).withColumn("distance", distance).where(F.col("distance") < cut)
    return below.select(*on, "a", "b", "distance", F.col("a_bunch").cast("int"), F.col("b_bunch").cast("int"))


def _claims_in_rounds(vertices: DataFrame, on: list[str], cut: float) -> DataFrame:
    """The same decisions for stretches of any length: every round, all vertices that wait for no other.

    A vertex waits for the larger ones linked to it, and to those that it is linked to. Decided and claimed ones
    leave the links; the largest of those left never waits, so the rounds end.
    """
    known = F.col("b_bunch") != UNKNOWN_BUNCH
    links = stored(_links(vertices, on, cut), "links")
    rounds = []
    while not links.isEmpty():
        first = links.groupBy(*on, "b").agg(F.min("a").alias("_first"))
        claimed = first.select(*on, F.col("b").alias("a"), F.lit(True).alias("_claimed"))
        seen = links.join(first, [*on, "b"]).join(claimed, [*on, "a"], "left")
        ready = seen.groupBy(*on, "a").agg(
            F.bool_and((F.col("_first") == F.col("a")) & F.col("_claimed").isNull()).alias("_ready"),
            F.min_by("b_bunch", F.when(known, F.struct("distance", "b"))).alias("_near"),
            F.first("a_bunch").alias("_own"),
        )
        taken = F.when(F.col("_own") != UNKNOWN_BUNCH, F.col("_own")).otherwise(F.coalesce("_near", F.lit(UNKNOWN_BUNCH)))
        ready = ready.where("_ready").select(*on, "a", taken.alias("taken"))
        lost = (F.col("b_bunch") == F.col("taken")) | ~known
        decided = links.join(ready, [*on, "a"]).select(*on, "a", "b", "taken", lost.alias("lost"))
        rounds.append(stored(decided, "decided"))
        gone = rounds[-1].where("lost").select(*on, "b")
        links = links.join(rounds[-1].select(*on, "a").distinct(), [*on, "a"], "left_anti")
        links = links.join(gone, [*on, "b"], "left_anti")
        links = stored(links.join(gone.withColumnRenamed("b", "a"), [*on, "a"], "left_anti"), "links")
    place = F.struct((-F.col("n_indices")).alias("rank"), "obj_id")
    out = vertices.withColumn("_place", place)
    found = None
    for part in rounds:
        found = part if found is None else found.unionByName(part)
    if found is None:
        return out.withColumns({"bunch": F.col("bunch").cast("int"), "discarded": F.lit(False)})
    gone = found.where("lost").select(*on, F.col("b").alias("_place"), F.lit(True).alias("_gone"))
    given = found.groupBy(*on, F.col("a").alias("_place")).agg(F.first("taken").alias("_taken"))
    out = out.join(gone, [*on, "_place"], "left").join(given, [*on, "_place"], "left")
    bunch = F.coalesce("_taken", F.col("bunch").cast("int"))
    return out.withColumns({"bunch": bunch, "discarded": F.coalesce("_gone", F.lit(False))})


_GEOMETRY = ("x", "y", "z", "cov_xx", "cov_xy", "cov_yy", "cov_zz", "n_indices")


def _decided(found: pa.Array, bunches: pa.Array, cut: float) -> pa.Array:
    """Bunch number and fate of the vertices of many stretches (lists of vertices, each a list as _GEOMETRY)."""
    sizes = np.asarray(bunches.value_lengths())
    begin = np.append(0, np.cumsum(sizes))
    geometry = found.flatten().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(_GEOMETRY))
    given = bunches.flatten()
    known = given.fill_null(UNKNOWN_BUNCH).to_numpy(zero_copy_only=False)
    bunch, gone = known.astype(np.int32), np.zeros(len(known), dtype=bool)
    for n in np.unique(sizes).tolist() if not given.null_count else []:
        if n <= TOGETHER:
            at = begin[:-1][sizes == n, None] + np.arange(n)
            bunch[at], gone[at] = _claims_together(geometry[at], bunch[at], cut)
    for i in range(len(sizes)) if given.null_count else np.flatnonzero(sizes > TOGETHER):
        a, b = begin[i], begin[i + 1]
        numbers = known[a:b].tolist() if not given.null_count else given.slice(a, b - a).to_numpy(zero_copy_only=False).tolist()
        bunch[a:b], gone[a:b] = zip(*_claims(geometry[a:b], numbers, cut), strict=True)
    rows = pa.StructArray.from_arrays([pa.array(bunch, pa.int32()), pa.array(gone)], ["bunch", "discarded"])
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), rows)


def _claims_together(found: np.ndarray, bunch: np.ndarray, cut: float) -> tuple[np.ndarray, np.ndarray]:
    """What `_claims` decides, for many stretches of the same number of vertices at a time."""
    position, cov, size = found[:, :, :3], found[:, :, 3:7], found[:, :, 7]
    gone, row = np.zeros(bunch.shape, dtype=bool), np.arange(len(found))
    for i in range(found.shape[1] - 1):
        rest = slice(i + 1, None)
        d = position[:, i, None] - position[:, rest]
        xx, xy, yy, zz = np.moveaxis(cov[:, i, None] + cov[:, rest], 2, 0)
        det = xx * yy - xy**2
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (yy * d[:, :, 0] ** 2 + xx * d[:, :, 1] ** 2 - 2 * xy * d[:, :, 0] * d[:, :, 1]) / det
            square = plane + d[:, :, 2] ** 2 / zz
        distance = np.where((det != 0) & (zz != 0) & (square > 0), np.sqrt(np.abs(square)), -1.0) * size[:, rest]
        near = (distance < cut) & ~gone[:, rest] & ~gone[:, i, None]
        order = np.argsort(np.where(near, distance, np.inf), axis=1, kind="stable")
        for k in range(int(near.sum(axis=1).max(initial=0))):
            j = order[:, k]
            claims, other = near[row, j], bunch[row, i + 1 + j]
            own = np.where(claims & (bunch[:, i] == UNKNOWN_BUNCH), other, bunch[:, i])
            bunch[:, i] = own
            lost = claims & ((other == own) | (other == UNKNOWN_BUNCH))
            gone[row[lost], i + 1 + j[lost]] = True
    return bunch, gone


def _claims(found: np.ndarray, bunch: list[int], cut: float) -> list[tuple[int, bool]]:
    """Bunch number and fate of the vertices of one stretch, ordered from the largest."""
    position, cov, size = found[:, :3], found[:, 3:7], found[:, 7]
    gone = np.zeros(len(found), dtype=bool)
    for i in range(len(found)):
        rest = np.flatnonzero(~gone[i + 1 :]) + i + 1
        if gone[i] or not len(rest):
            continue
        d = position[i] - position[rest]
        xx, xy, yy, zz = (cov[i] + cov[rest]).T
        det = xx * yy - xy**2
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (yy * d[:, 0] ** 2 + xx * d[:, 1] ** 2 - 2 * xy * d[:, 0] * d[:, 1]) / det
            square = plane + d[:, 2] ** 2 / zz
        distance = np.where((det != 0) & (zz != 0) & (square > 0), np.sqrt(np.abs(square)), -1.0) * size[rest]
        for k in np.argsort(distance, kind="stable")[: int((distance < cut).sum())]:
            j = rest[k]
            if bunch[i] == UNKNOWN_BUNCH:
                bunch[i] = bunch[j]
            if bunch[j] in (bunch[i], UNKNOWN_BUNCH):
                gone[j] = True
    return [(int(b), bool(g)) for b, g in zip(bunch, gone)]


def primary_vertex(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Vertices left with ``is_primary``: the largest of bunch 0, else of unknown bunch, else none."""
    left = merged.where(~F.col("discarded"))
    rank = F.struct((F.col("bunch") == 0).alias("zero"), "n_indices", (-F.col("obj_id")).alias("id"))
    usable = (F.col("bunch") == 0) | (F.col("bunch") == UNKNOWN_BUNCH)
    best = left.groupBy(*keys).agg(F.max_by("obj_id", F.when(usable, rank)).alias("_primary"))
    joined = left.join(best, list(keys))
    return joined.withColumn("is_primary", F.col("obj_id").eqNullSafe(F.col("_primary"))).drop("_primary", "discarded")
