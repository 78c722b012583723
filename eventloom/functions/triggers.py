"""Trigger masks, names and expressions as Column expressions.

Trigger classes are numbered 0-99 and stored in two words of 50 bits; trigger
inputs are numbered 0-59: 24 of level 0, 24 of level 1 and 12 of level 2.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Detector names by bit of the readout pattern, and the bit of the last one.
DETECTORS = (
    "ITSSPD ITSSDD ITSSSD TPC TRD TOF HMPID PHOS CPV PMD MUONTRK MUONTRG FMD T0 VZERO ZDC ACORDE"
    " TRG EMCAL DAQ_TEST EMPTY AD MFT FIT HLT"
).split()
HLT_BIT = 30
DETECTOR_BITS = {name: (HLT_BIT if name == "HLT" else bit) for bit, name in enumerate(DETECTORS)}

# Cluster words not used by tracks of type 0 and 1.
FREE_MASKS = (0x0000FFFF0000FFFF, -0x0000FFFF00010000)


def any_bit(flags: Column, mask: int) -> Column:
    """True if any bit of the mask is set (also the sign bit)."""
    return flags.bitwiseAND(F.lit(mask).cast("bigint")) != 0


def bit_at(word: Column, bit: Column) -> Column:
    """True if the numbered bit of the word is set; the number may be a column."""
    return F.call_function("shiftright", word, bit.cast("int")).bitwiseAND(F.lit(1).cast("bigint")) != 0


def class_bit(mask: Column, mask_next: Column, bit: Column) -> Column:
    low = bit_at(mask, F.least(bit, F.lit(49)))
    high = bit_at(mask_next, F.greatest(bit - 50, F.lit(0)))
    return F.when(bit < 50, low).otherwise(high)


def input_bit(l0: Column, l1: Column, l2: Column, idx: Column) -> Column:
    word = F.when(idx < 24, l0).when(idx < 48, l1).otherwise(l2)
    return bit_at(word, F.when(idx < 24, idx).when(idx < 48, idx - 24).otherwise(idx - 48))


def name_lists(names: DataFrame, on: Sequence[str], index: str, name: str = "name", out: str = "defined") -> DataFrame:
    """One row per configuration with its names in index order.

    A configuration has at most 100 classes or 60 inputs, so the list is small and
    events need one equi-join and no regrouping to see all their names.
    """
    pair = F.struct(F.col(index).alias("i"), F.col(name).alias("name"))
    return names.groupBy(*on).agg(F.sort_array(F.collect_list(pair)).alias(out))


def active_names(defined: Column) -> Column:
    return F.transform(defined, lambda d: d["name"])


def fired_classes(mask: Column, mask_next: Column, defined: Column) -> Column:
    return active_names(F.filter(defined, lambda d: class_bit(mask, mask_next, d["i"])))


def fired_inputs(l0: Column, l1: Column, l2: Column, defined: Column) -> Column:
    return active_names(F.filter(defined, lambda d: input_bit(l0, l1, l2, d["i"])))


_NAME = re.compile(r"(?<![\w-])[A-Za-z_][\w-]*")


def expression(text: str, fired: str, defined: str) -> Column:
    """A boolean expression over names (``&&``, ``||``, ``!``, parentheses).

    ``fired`` and ``defined`` name array columns of names.  The text becomes a Spark
    SQL expression, which Spark parses.  An empty or malformed expression, or one
    with a name that the event's configuration does not define, passes.
    """
    names = sorted(set(_NAME.findall(text)))
    if not names:
        return F.lit(True)
    body = _NAME.sub(lambda m: f"array_contains({fired}, '{m.group()}')", text)
    for sign, word in (("&&", "&"), ("||", "|"), ("&", " AND "), ("|", " OR "), ("!", " NOT ")):
        body = body.replace(sign, word)
    known = " AND ".join(f"array_contains({defined}, '{n}')" for n in names)
    lists = f"VALUES (array(''), array('')) AS t({fired}, {defined})"
    try:
        SparkSession.active().sql(f"SELECT NOT ({body}) FROM {lists}")  # analysed, not run
    except (ParseException, AnalysisException):
        return F.lit(True)
    return F.when(F.expr(known), F.expr(body)).otherwise(F.lit(True))


def conjunction(tokens: Column, fired: Column) -> Column:
    """All tokens hold: the name fired, or with a leading ``!`` did not."""

    def holds(token: Column) -> Column:
        negated = token.startswith("!")
        return F.array_contains(fired, F.regexp_replace(token, "^!", "")) != negated

    return F.forall(tokens, holds)


def tokens(logic: Column) -> Column:
    """Names of a trigger function, each with its ``!`` if it has one."""
    return F.filter(F.split(F.regexp_replace(logic, r"[()&|\t]+", " "), " +"), lambda t: t != "")


def function_active(functions: DataFrame, inputs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Adds ``is_active``: every input a function names is known and active."""
    named = functions.select(
        *on, "function", F.explode(tokens(F.regexp_replace("logic", "!", ""))).alias("name")
    )
    state = (
        named.join(inputs.select(*on, "name", "active"), [*on, "name"], "left")
        .groupBy(*on, "function")
        .agg(F.bool_and(F.coalesce("active", F.lit(False))).alias("is_active"))
    )
    return functions.join(state, [*on, "function"])


def cluster_of(class_name: Column) -> Column:
    """The readout cluster: the fourth ``-`` separated piece of a class name, lower case."""
    return F.lower(F.get(F.split(class_name, "-"), F.lit(3)))


def hlt_fired(option: Column, description: Column, name: str) -> Column:
    """Decision taken, and the first occurrence of ``name`` is followed by a blank."""
    at = F.instr(description, name)
    return F.coalesce(
        (F.substring(option, 1, 1) == "1")
        & (at > 0)
        & (F.call_function("substr", description, at + len(name), F.lit(1)) == " "),
        F.lit(False),
    )


def raw_event_selected(
    *,
    event_type: tuple[Column, int] | None = None,
    pattern: Column | None = None,
    detectors: Sequence[str] = (),
    without_detectors: Sequence[str] = (),
    masks: Sequence[tuple[Column, int]] = (),
    veto: tuple[Column, Sequence[str]] | None = None,
    trigger: Column | None = None,
    downscale: tuple[Column, int] | None = None,
) -> Column:
    """Conjunction of the raw-event conditions that are given.

    Type; all ``detectors`` and none of ``without_detectors`` in the pattern; an
    overlap with any of the class masks; no vetoed class among the fired names; a
    trigger expression; and every n-th event.
    """
    passed = F.lit(True)
    if event_type:
        passed = passed & (event_type[0] == event_type[1])
    if detectors:
        wanted = detector_pattern(detectors)
        passed = passed & (pattern.bitwiseAND(F.lit(wanted)) == wanted)
    if without_detectors:
        passed = passed & ~any_bit(pattern, detector_pattern(without_detectors))
    if masks:
        overlap = F.lit(False)
        for word, mask in masks:
            overlap = overlap | any_bit(word, mask)
        passed = passed & overlap
    if veto:
        passed = passed & ~F.arrays_overlap(veto[0], F.array(*[F.lit(n) for n in veto[1]]))
    if trigger is not None:
        passed = passed & trigger
    if downscale:
        passed = passed & (downscale[0] % downscale[1] == 0)
    return passed


def alias_expression(aliases: Mapping[str, Sequence[str]], text: str) -> str:
    """Replace each alias in a trigger expression by the OR of its classes."""
    return _NAME.sub(
        lambda m: f"({' || '.join(aliases[m.group()])})" if m.group() in aliases else m.group(), text
    )


def detector_pattern(names: Sequence[str]) -> int:
    return sum(1 << DETECTOR_BITS[n] for n in set(names))


def detector_names(pattern: Column) -> Column:
    """Names of the detectors in a pattern word, in bit order."""
    pairs = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(n).alias("name")) for n, b in DETECTOR_BITS.items()])
    return F.transform(F.filter(pairs, lambda p: bit_at(pattern, p["bit"])), lambda p: p["name"])


def equipment(equipment_id: Column) -> tuple[Column, Column]:
    """(detector number, index within the detector) of an equipment id; null if out of range."""
    detector, index = F.shiftright(equipment_id, 8), equipment_id.bitwiseAND(F.lit(255))
    valid = (equipment_id >= 0) & ((detector < len(DETECTORS) - 1) | (detector == HLT_BIT))
    return F.when(valid, detector), F.when(valid, index)


def free_tracklet(used_by: Column, kind: int) -> Column:
    """Clusters of the tracklet not used by any track of the type."""
    return used_by.bitwiseAND(F.lit(FREE_MASKS[kind]).cast("bigint")) == 0


def in_class(value: Column, lower: float, upper: float, quality: Column | None = None) -> Column:
    """``lower <= value < upper``, and the quality is 0 where one is given."""
    inside = (value >= lower) & (value < upper)
    return inside if quality is None else inside & (quality == 0)


def clamped(value: Column, largest: float) -> tuple[Column, Column]:
    """(value or 0 if its size is above the limit, whether it was)."""
    above = F.abs(value) > largest
    return F.when(above, F.lit(0.0)).otherwise(value), above
