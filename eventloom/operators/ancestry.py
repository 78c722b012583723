"""Monte-Carlo particle forests: ancestors, primaries, secondaries, pruning, ordering.

Particles are rows (event keys, idx, mother, pdg, status, process, vx, vy, vz); ``mother``
is -1 for a root and always smaller than ``idx``.  Generator particles come first: ``idx``
below the event's ``n_primary``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import blocked, numbered
from eventloom.operators.ranges import range_join
from eventloom.session import cut_lineage, stored

# Particles that do not decay within the apparatus; decay and pair-production
# process codes; ids from here on are nuclei; strange digit of a nucleus.
STABLE = (22, 11, 13, 211, 321, 310, 130, 2212, 2112, 3122, 3112, 3222, 3312, 3322, 3334, 12, 14, 16)
DECAY, PAIR_PRODUCTION = 4, 5
NUCLEUS = 1_000_000_000
LONG_LIVED_KAON, PHOTON, NEUTRAL_PION, SIGMA_ZERO, CHARGED_PION, MUON = 130, 22, 111, 3212, 211, 13
CHARM, STRANGE = 4, 3


def is_stable(pdg: Column) -> Column:
    """``pdg`` without sign."""
    return (pdg > NUCLEUS) | pdg.isin(*STABLE)


def leading_digit(pdg: Column) -> Column:
    return F.substring(F.abs(pdg).cast("string"), 1, 1).cast("int")


def quark_content(pdg: Column) -> Column:
    """Heaviest quark from a particle id: hundreds of a meson, thousands of a baryon."""
    size = F.abs(pdg)
    meson = F.floor(size / 100)
    baryon = F.floor(meson / 10)
    nested = F.when(baryon > 10, F.floor(baryon / 10)).otherwise(baryon)
    return F.when(size <= 10, size).when(meson <= 10, meson).otherwise(nested)


def first_ancestor(particles: DataFrame, keys: Sequence[str], terminal: Column, out: str = "ancestor") -> DataFrame:
    """Adds the nearest particle up the mother line, starting with itself, that is ``terminal``.

    Pointer doubling: each round a pointer jumps to its target's pointer, so a chain of
    length n takes log2(n) equi-joins.  Rows that have arrived are set aside.  Only
    the pointers travel; a root is always terminal.  Where a mother is not in the table the
    line ends and the ancestor is null.  A line that runs in a circle is an error.
    """
    keys = list(keys)
    stop = terminal | (F.col("mother") < 0)
    start = particles.select(
        *keys,
        "idx",
        F.when(stop, F.col("idx")).otherwise(F.col("mother")).alias("_to"),
        stop.alias("_there"),
    )
    # a mother that is terminal is reached in the first jump, so pointers start at rest
    pointers = cut_lineage(start)
    arrived = pointers.where("_there")
    moving = pointers.where(~F.col("_there"))
    targets = pointers
    rounds = pointers.count().bit_length() + 1
    while not moving.isEmpty():
        if not rounds:
            raise ValueError("a mother line runs in a circle")
        rounds -= 1
        jump = targets.select(*keys, F.col("idx").alias("_to"), F.col("_to").alias("_next"), F.col("_there").alias("_end"))
        moved = cut_lineage(
            moving.join(jump, [*keys, "_to"], "left").select(
                *keys, "idx", F.col("_next").alias("_to"), F.coalesce("_end", F.lit(True)).alias("_there")
            )
        )
        arrived = arrived.unionByName(moved.where("_there"))
        moving = moved.where(~F.col("_there"))
        targets = arrived.unionByName(moving)
    found = arrived.select(*keys, "idx", F.col("_to").alias(out))
    return particles.join(found, [*keys, "idx"], "left")


def roots(particles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the generator particle a particle finally descends from (itself for a root)."""
    return first_ancestor(particles, keys, F.lit(False), "root")


def _facts(particles: DataFrame, keys: Sequence[str], link: str, prefix: str, *columns: str) -> DataFrame:
    return particles.select(
        *keys, F.col("idx").alias(link), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )


def physical_primaries(particles: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``is_primary``, and the mother's ``m_pdg``.

    Generator particles count if stable, not decayed (a long-lived kaon may be), not from
    such a kaon, and, for a photon, not continued by a photon.  Transported ones count if
    stable and from a generator sigma-zero or neutral pion, or from a heavy-flavour
    particle whose generator ancestor is one.  Needs ``first_daughter`` (or -1).
    """
    keys = list(keys)
    df = particles.join(events.select(*keys, "n_primary"), keys)
    df = first_ancestor(df, keys, F.col("idx") < F.col("n_primary"), "generated")
    df = df.join(_facts(particles, keys, "mother", "m_", "pdg"), [*keys, "mother"], "left")
    df = df.join(_facts(particles, keys, "generated", "g_", "pdg"), [*keys, "generated"], "left")
    df = df.join(_facts(particles, keys, "first_daughter", "d_", "pdg"), [*keys, "first_daughter"], "left")

    size = F.abs("pdg")
    by_generator = F.col("idx") < F.col("n_primary")
    decayed = (F.col("status") > 1) & ~(by_generator & (size == LONG_LIVED_KAON))
    from_kaon = F.coalesce(F.abs("m_pdg") == LONG_LIVED_KAON, F.lit(False))
    continued = (size == PHOTON) & F.coalesce(F.col("d_pdg") == PHOTON, F.lit(False))
    mother_generated = F.col("mother") < F.col("n_primary")
    electromagnetic = F.abs("m_pdg").isin(SIGMA_ZERO, NEUTRAL_PION) & mother_generated
    heavy = (leading_digit(F.col("m_pdg")) >= CHARM) & (
        mother_generated | (leading_digit(F.col("g_pdg")) >= CHARM)
    )
    transported = F.coalesce(electromagnetic | heavy, F.lit(False))
    verdict = ~decayed & is_stable(size) & F.when(by_generator, ~from_kaon & ~continued).otherwise(transported)
    return df.withColumn("is_primary", verdict).drop("generated", "g_pdg", "d_pdg")


def from_weak_decay(df: DataFrame) -> Column:
    """Secondary from the decay of a strange particle, a pion, a muon or a hypernucleus."""
    size = F.abs("m_pdg")
    hyper = (size > NUCLEUS) & (F.expr("m_pdg div 10000000") % 10 != 0)
    source = (leading_digit(F.col("m_pdg")) == STRANGE) | size.isin(CHARGED_PION, MUON) | hyper
    return F.coalesce(
        ~F.col("is_primary") & (F.col("mother") >= 0) & (F.col("process") == DECAY) & source, F.lit(False)
    )


def from_material(df: DataFrame) -> Column:
    """Neither a physical primary nor from a weak decay, but with a mother."""
    return ~F.col("is_primary") & ~from_weak_decay(df) & (F.col("mother") >= 0)


def generator_ranges(generators: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Index range of each generator's particles, counted down from the last one.

    The first generator (``pos`` 0) takes all that is left.  An event has a handful.
    """
    keys = list(keys)
    df = generators.join(events.select(*keys, "n_primary"), keys)
    df = blocked(
        df.withColumn("_back", -F.col("pos")), keys, F.lit(0), ["_back"], running={"_taken": F.col("n_produced").cast("bigint")}
    )
    last = F.col("n_primary") - F.col("_taken") + F.col("n_produced") - 1
    first = F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.greatest(F.col("n_primary") - F.col("_taken"), F.lit(0)))
    return df.select(
        *keys, F.col("pos").alias("generator"), "name", first.cast("bigint").alias("_lo"), last.cast("bigint").alias("_hi")
    )


def generators_of(
    particles: DataFrame, generators: DataFrame, events: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Adds the generator of every particle: that of its root, which all descendants inherit."""
    keys = list(keys)
    ranges = generator_ranges(generators, events, keys)
    rooted = roots(particles, keys)
    return range_join(rooted, ranges, "root", "_lo", "_hi", on=keys, width=64, unmatched=[*keys, "idx"]).drop("_lo", "_hi")


def with_family(particles: DataFrame, flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the flagged particles and all their ancestors, as far as they are in the table.

    By doubling: a round adds what the marked particles point to and lets every pointer jump to
    its target's pointer, so that a line of n generations takes log2(n) rounds.  A mother that is not in the
    table ends the line.  A line that runs in a circle is an error.
    """
    keys = list(keys)
    seeds = flagged.select(*keys, "idx").distinct().withColumn("_in", F.lit(True))
    lines = particles.select(*keys, "idx", F.when(F.col("mother") >= 0, F.col("mother")).alias("_to"))
    lines = stored(lines.join(seeds, [*keys, "idx"], "left").withColumn("_in", F.coalesce("_in", F.lit(False))), "lines")
    rounds = lines.count().bit_length() + 1
    while not lines.where("_in AND _to IS NOT NULL").isEmpty():
        if not rounds:
            raise ValueError("a mother line runs in a circle")
        rounds -= 1
        reached = lines.where("_in").select(*keys, F.col("_to").alias("idx"), F.lit(True).alias("_reached")).distinct()
        jump = lines.where("_to IS NOT NULL").select(*keys, F.col("idx").alias("_to"), F.col("_to").alias("_next"))
        lines = lines.join(jump, [*keys, "_to"], "left").join(reached, [*keys, "idx"], "left")
        marked = F.col("_in") | F.coalesce("_reached", F.lit(False))
        lines = stored(lines.select(*keys, "idx", F.col("_next").alias("_to"), marked.alias("_in")), "lines")
    return lines.where("_in").select(*keys, "idx")


def pruned(
    particles: DataFrame, events: DataFrame, flagged: DataFrame, keys: Sequence[str], r_max: float, z_max: float
) -> DataFrame:
    """The kept particles with dense numbers ``new_idx``, mothers and daughter ranges remapped.

    Generator particles stay.  Of the others: flagged ones with their family; first
    generation inside the (r, z) range, from heavy flavour, or from pair production; and
    chains of decays down from the generator.  A kept particle of a dropped mother
    stops the job.
    """
    keys = list(keys)
    df = particles.join(events.select(*keys, "n_primary"), keys)
    generated = F.col("idx") < F.col("n_primary")
    # up the line past decays: where it ends tells if the chain comes from the generator
    df = first_ancestor(df, keys, generated | (F.col("process") != DECAY), "chain_end")
    df = df.join(_facts(particles, keys, "mother", "m_", "pdg"), [*keys, "mother"], "left")
    family = with_family(particles, flagged, keys).withColumn("_flagged", F.lit(True))
    df = df.join(family, [*keys, "idx"], "left")
    first_generation = (F.col("mother") >= 0) & (F.col("mother") < F.col("n_primary"))
    inside = (F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")) < r_max) & (F.abs("vz") < z_max)
    physics = first_generation & (
        inside | (quark_content(F.col("m_pdg")) >= CHARM) | (F.col("process") == PAIR_PRODUCTION)
    )
    chain = (F.col("process") == DECAY) & (F.col("mother") >= 0) & (F.col("chain_end") < F.col("n_primary"))
    keep = generated | F.coalesce("_flagged", F.lit(False)) | F.coalesce(physics, F.lit(False)) | chain
    kept = df.where(keep).select(*particles.columns, "n_primary")
    kept = numbered(kept, keys, F.floor(F.col("idx") / 65536), ["idx"]).withColumn("new_idx", F.col("rank") - 1).drop("rank")
    return _remapped(kept, keys)


def _remapped(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mothers and daughter ranges in the numbers ``new_idx``."""
    keys = list(keys)
    renamed = kept.select(*keys, F.col("idx").alias("mother"), F.col("new_idx").alias("new_mother"))
    df = kept.join(renamed, [*keys, "mother"], "left")
    lost = (F.col("mother") >= 0) & F.col("new_mother").isNull()
    mother = F.when(lost, F.raise_error(F.lit("a particle is kept whose mother is not"))).otherwise(
        F.coalesce("new_mother", F.lit(-1).cast("bigint"))
    )
    df = df.withColumn("new_mother", mother.cast("bigint"))
    spans = (
        df.where("new_mother >= 0")
        .groupBy(*keys, F.col("new_mother").alias("new_idx"))
        .agg(F.min("new_idx").alias("new_first"), F.max("new_idx").alias("new_last"))
    )
    none = F.lit(-1).cast("bigint")
    return df.join(spans, [*keys, "new_idx"], "left").withColumns(
        {"new_first": F.coalesce("new_first", none), "new_last": F.coalesce("new_last", none)}
    )


def children_together(particles: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Renumbers transported particles so that every mother's daughters are contiguous.

    Mothers are served in their old order, daughters keep theirs; generator particles
    keep their numbers.
    """
    keys = list(keys)
    df = particles.join(events.select(*keys, "n_primary"), keys)
    fixed = F.col("idx") < F.col("n_primary")
    # generator particles first, by number; then by mother, then by number
    df = df.withColumns(
        {
            "_group": F.when(fixed, F.lit(-1).cast("bigint")).otherwise(F.col("mother")),
        }
    )
    ranked = numbered(df, keys, F.floor(F.col("_group") / 16384), ["_group", "idx"])
    ranked = ranked.withColumn("new_idx", F.col("rank") - 1).drop("rank", "_group")
    return _remapped(ranked, keys)


def track_references(
    references: Sequence[tuple[str, DataFrame]], particles: DataFrame, events: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Detector references in the order of the particle entries.

    Secondaries come first, those of the last primary before those of the first, then the
    primaries; every particle is an entry, also without any reference (``n_refs`` 0, one
    row with a null detector).  One row per reference, so no entry grows without bound.
    Needs particles with ``root_primary``, the primary they were transported from.
    """
    keys = list(keys)
    stacked = None
    for number, (name, df) in enumerate(references):
        tagged = df.withColumns({"detector": F.lit(name), "_place": F.lit(number)})
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    counts = stacked.groupBy(*keys, F.col("label").alias("idx")).agg(F.count("*").alias("n_refs"))
    secondary = F.col("idx") >= F.col("n_primary")
    entries = (
        particles.join(events.select(*keys, "n_primary"), keys)
        .withColumns({"_late": (~secondary).cast("int"), "_order": F.when(secondary, -F.col("root_primary")).otherwise(F.lit(0))})
        .select(*keys, "idx", "_late", "_order")
    )
    entries = blocked(
        entries,
        keys,
        F.struct(F.col("_late"), F.floor(F.col("_order") / 1024), F.when(F.col("_late") == 1, F.floor(F.col("idx") / 65536))),
        ["_late", "_order", "idx"],
        running={"entry": F.lit(1).cast("bigint")},
    ).select(*keys, "idx", (F.col("entry") - 1).alias("entry"))
    counted = entries.join(counts, [*keys, "idx"], "left").withColumn("n_refs", F.coalesce("n_refs", F.lit(0).cast("bigint")))
    listed = stacked.withColumnRenamed("label", "idx").drop("_place")
    return counted.join(listed, [*keys, "idx"], "left")
