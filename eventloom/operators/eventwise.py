"""Per-event quantities: channel arrays, flow vectors, multiplicities, counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import status, tracks
from eventloom.functions.triggers import any_bit, free_tracklet

# Channels of side A and C, channels per ring, smallest usable sum.
CHANNELS_C, CHANNELS_A, PER_RING = (0, 32), (32, 64), 8
SMALLEST_SUM = 1e-6
RINGS = {**{ring: (ring * 8, ring * 8 + 8) for ring in range(8)}, 8: (32, 64), 9: (0, 32), 10: (0, 64)}


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def channels(values: Column, span: tuple[int, int]) -> Column:
    return F.slice(values, span[0] + 1, span[1] - span[0])


def ring_sums(values: Column) -> dict[str, Column]:
    """Side totals, fired channels per side, and the four rings of each side."""
    out = {
        "total_a": total(channels(values, CHANNELS_A)),
        "total_c": total(channels(values, CHANNELS_C)),
        "fired_a": F.size(F.filter(channels(values, CHANNELS_A), lambda v: v > 0)),
        "fired_c": F.size(F.filter(channels(values, CHANNELS_C), lambda v: v > 0)),
    }
    for ring in range(4):
        out[f"ring_a{ring}"] = total(channels(values, RINGS[ring + 4]))
        out[f"ring_c{ring}"] = total(channels(values, RINGS[ring]))
    return out


def equalised(values: Column, factors: Column) -> Column:
    """Channel multiplicities divided by their factor relative to the ring's mean factor."""
    def ring_mean(i: Column) -> Column:
        start = F.floor(i / PER_RING).cast("int") * PER_RING + 1
        return total(F.slice(factors, start, F.lit(PER_RING))) / PER_RING

    return F.transform(values, lambda v, i: v * ring_mean(i) / F.get(factors, i))


def flow_sums(values: Column, span: tuple[int, int], harmonic: int) -> tuple[Column, Column, Column]:
    """(Qx, Qy, multiplicity) over channels at azimuth pi/8 + k pi/4."""
    part = channels(values, span)
    angles = [math.pi / 8 + math.pi / 4 * (k % PER_RING) for k in range(*span)]

    def weighted(fn) -> Column:
        weights = F.array(*[F.lit(fn(harmonic * a)) for a in angles])
        return total(F.zip_with(part, weights, lambda v, w: v * w))

    return weighted(math.cos), weighted(math.sin), total(part)


def flattened(qx: Column, qy: Column, c: Column) -> tuple[Column, Column]:
    """Second-harmonic vector after recentring, twist, rescaling and flattening.

    ``c`` is a struct of mean_x, mean_y, a_plus, a_minus, lambda_plus, lambda_minus, cos8.
    """
    x, y = qx - c["mean_x"], qy - c["mean_y"]
    det = 1 - c["lambda_plus"] * c["lambda_minus"]
    u = (x - c["lambda_minus"] * y) / det / c["a_plus"]
    v = (y - c["lambda_plus"] * x) / det / c["a_minus"]
    turn = c["cos8"] * F.sin(4 * F.atan2(v, u))
    return u * F.cos(turn) - v * F.sin(turn), u * F.sin(turn) + v * F.cos(turn)


def event_plane(values: Column, ring: int, harmonic: int, correction: Column | None = None) -> Column:
    """Event-plane angle of a ring (8 side A, 9 side C, 10 all); null without signal.

    The second harmonic is corrected with the ring's constants.
    """
    qx, qy, mult = flow_sums(values, RINGS[ring], harmonic)
    if harmonic == 2:
        qx, qy = flattened(qx, qy, correction)
    return F.when(mult >= SMALLEST_SUM, F.atan2(qy, qx) / harmonic)


def event_plane_of_rings(values: Column, rings: Sequence[int], harmonic: int, corrections: Column) -> Column:
    """Event-plane angle of several rings, each corrected before they are added.

    ``corrections`` is an array of structs indexed by ring.
    """
    sum_x, sum_y, mult_all = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for ring in rings:
        qx, qy, mult = flow_sums(values, RINGS[ring], harmonic)
        if harmonic == 2:
            qx, qy = flattened(qx, qy, F.get(corrections, F.lit(ring)))
        used = mult >= SMALLEST_SUM
        sum_x = sum_x + F.when(used, qx).otherwise(0.0)
        sum_y = sum_y + F.when(used, qy).otherwise(0.0)
        mult_all = mult_all + F.when(used, mult).otherwise(0.0)
    return F.when(mult_all >= SMALLEST_SUM, F.atan2(sum_y, sum_x) / harmonic)


def multiplicities(
    tracklets: DataFrame, track_table: DataFrame, keys: Sequence[str], eta_max: float,
    use_dca_flag: bool = False, use_v0_flag: bool = False,
) -> DataFrame:
    """Three multiplicity estimators per event within ``|eta| <= eta_max``.

    Tracklets; tracks with tracklets not used by them; pure standalone tracks with
    tracklets not used by those.  Both inputs are counted before they meet.
    """
    theta_eta = -F.log(F.tan(F.col("theta") / 2))
    near = tracklets.where(F.abs(theta_eta) <= eta_max)
    one = F.lit(1)
    from_tracklets = near.select(
        *keys,
        one.alias("tracklets"),
        free_tracklet(F.col("used_by"), 0).cast("int").alias("its_tpc"),
        free_tracklet(F.col("used_by"), 1).cast("int").alias("pure"),
    )
    flags = F.col("flags")
    wanted = (F.abs(tracks.eta(F.col("tgl"))) <= eta_max) & any_bit(flags, status.ITS_IN)
    if use_dca_flag:
        wanted = wanted & ~any_bit(flags, status.MULT_SECONDARY)
    if use_v0_flag:
        wanted = wanted & ~any_bit(flags, status.MULT_IN_V0)
    alone = any_bit(flags, status.ITS_PURE_STANDALONE)
    from_tracks = track_table.where(wanted).select(
        *keys, F.lit(0).alias("tracklets"), (~alone).cast("int").alias("its_tpc"), alone.cast("int").alias("pure")
    )
    names = ("tracklets", "its_tpc", "pure")
    return from_tracklets.unionByName(from_tracks).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def layer_clusters(per_layer: Column, first: int, last: int) -> Column:
    """Clusters summed over a closed range of layers; 0 for an invalid range."""
    if first < 0 or last < first:
        return F.lit(0).cast("bigint")
    part = F.slice(per_layer, first + 1, last - first + 1)
    return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, v: acc + v)


def percentile_class(percentile: Column, quality: Column, width: int) -> Column:
    """Class number cut towards zero, -1 for an event of bad quality."""
    return F.when(quality == 0, (percentile / width).cast("int")).otherwise(-1)


def percentile(value: Column, quality: Column) -> Column:
    return F.when(quality == 0, value).otherwise(F.lit(-1.0))


def with_fallback(run: Column, old: Column, new: Column) -> Column:
    """The older estimator before run 200000, the newer one from there on."""
    return F.when(run < 200000, old).otherwise(new)


def words_on(mask: Column, bits: int = 23) -> Column:
    """Number of set bits among the lowest ``bits`` of a word."""
    return F.bit_count(mask.bitwiseAND(F.lit((1 << bits) - 1)))


def word_grid(df: DataFrame, keys: Sequence[str], mask: str, bits: int = 23) -> DataFrame:
    """One row per bit of a word: ``pad`` and whether it is ``on``."""
    pads = df.select(*keys, mask, F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("pad"))
    on = F.call_function("shiftright", F.col(mask), F.col("pad")).bitwiseAND(F.lit(1).cast("bigint")) != 0
    return pads.select(*keys, "pad", on.alias("on"))


def first_seen(df: DataFrame, keys: Sequence[str], position: str, names: Column) -> DataFrame:
    """Distinct names over ordered lists, in order of first appearance, as one text per key.

    Reduced to one row per name before anything is listed.
    """
    spread = df.select(*keys, position, F.posexplode(names).alias("_at", "name"))
    first = spread.groupBy(*keys, "name").agg(F.min(F.struct(position, "_at")).alias("_first"))
    ordered = F.sort_array(F.collect_list(F.struct("_first", "name")))
    text = F.concat_ws(" ", F.transform(ordered, lambda p: p["name"]))
    return first.groupBy(*keys).agg(text.alias("names"))
