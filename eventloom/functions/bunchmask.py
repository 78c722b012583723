"""Bunch-mask notation.

``25L 25(2H2LH 3(23HL))``: a number repeats the letter or group after it, groups nest,
``H`` masks a bunch crossing and ``L`` leaves it open.  A mask has 3564 crossings.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CROSSINGS = 3564
_INNERMOST = re.compile(r"(\d*)\(([HL]*)\)")
_REPEATED = re.compile(r"(\d+)([HL])")


def expand(text: str) -> str:
    """The notation written out as one letter per crossing; ValueError if it is not one mask.

    Innermost groups are written out first until no group is left.
    """
    def repeated(found: re.Match) -> str:
        times = int(found.group(1) or 1)
        if times * len(found.group(2)) > CROSSINGS:
            raise ValueError(f"more than {CROSSINGS} crossings in {text!r}")
        return found.group(2) * times

    body = re.sub(r"\s+", "", text).upper()
    while True:
        written = _INNERMOST.sub(repeated, _REPEATED.sub(repeated, body))
        if written == body:
            break
        body = written
    if set(body) - set("HL") or len(body) != CROSSINGS:
        raise ValueError(f"not a mask of {CROSSINGS} crossings: {text!r}")
    return body


def unmasked(text: Column) -> Column:
    """Numbers of the open crossings, null for a text that is not a mask."""

    @F.arrow_udf("array<int>")
    def decode(texts: pa.Array) -> pa.Array:
        # one flat array of numbers with the places of the masks in it; Python never holds a number by itself
        found, ends, known = [np.zeros(0, np.int32)], [0], []
        for text in texts:
            try:
                letters = np.frombuffer(expand(text.as_py()).encode(), dtype="S1") if text.is_valid else None
            except ValueError:
                letters = None
            known.append(letters is not None)
            if letters is not None:
                found.append(np.flatnonzero(letters == b"L").astype(np.int32))
            ends.append(ends[-1] + (len(found[-1]) if known[-1] else 0))
        malformed = pa.array(~np.array(known, bool))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)), mask=malformed)

    # marked so that a filter on the result does not decode a second time
    return decode.asNondeterministic()(text)
