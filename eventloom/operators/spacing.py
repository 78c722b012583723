"""Thinning a series to records at least a gap apart.

Which record is kept depends on the last one kept before it, all the way back.  To run
this block by block, each block first reports where it would end for every place it
could be entered at (only records within one gap of its start qualify); these few
rows are composed per key; then each block is thinned from its known entry.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.ordered import blocked


def _walk(times: np.ndarray, at: int, gap: int) -> list[int]:
    """Indices kept when the record ``at`` is."""
    kept = []
    while at < len(times):
        kept.append(at)
        at = int(np.searchsorted(times, times[at] + gap))
    return kept


def spaced(df: DataFrame, keys: Sequence[str], time: str, tie: str, gap: int, block_width: int) -> DataFrame:
    """Rows kept when going through each key in order of (``time``, ``tie``).

    The first row is kept, then always the first one at least ``gap`` later.  ``time`` is a
    whole number and ``block_width`` a multiple of ``gap`` in its unit.  A group handed to
    Python is one block of one key.
    """
    keys = list(keys)
    blocks = df.withColumn("_block", F.floor(F.col(time) / block_width))
    key_fields = [blocks.schema[k] for k in keys]
    entry_schema = T.StructType(
        [*key_fields, T.StructField("_block", T.LongType()), T.StructField("enter", T.LongType()),
         T.StructField("leave", T.LongType())]
    )

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(pdf[time].to_numpy())
        start = int(pdf["_block"].iloc[0]) * block_width
        # the block is entered no later than at its first record a gap into it
        places = np.unique(np.searchsorted(times, np.append(times[times < start + gap], start + gap)))
        rows = [(times[p], times[_walk(times, int(p), gap)[-1]] + gap) for p in places if p < len(times)]
        out = pd.DataFrame(rows, columns=["enter", "leave"])
        for name in (*keys, "_block"):
            out[name] = pdf[name].iloc[0]
        return out[[*keys, "_block", "enter", "leave"]]

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        threshold = np.iinfo(np.int64).min
        found = []
        for block, part in pdf.sort_values(["_block", "enter"]).groupby("_block", sort=True):
            usable = part[part["enter"] >= threshold]
            if len(usable):
                found.append((block, int(usable["enter"].iloc[0])))
                threshold = int(usable["leave"].iloc[0])
        out = pd.DataFrame(found, columns=["_block", "enter"])
        for name in keys:
            out[name] = pdf[name].iloc[0]
        return out[[*keys, "_block", "enter"]]

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values([time, tie]).reset_index(drop=True)
        times = ordered[time].to_numpy()
        kept = _walk(times, int(np.searchsorted(times, int(ordered["enter"].iloc[0]))), gap)
        return ordered.loc[kept, names]

    grouped = [*keys, "_block"]
    slim = blocks.select(*grouped, time)
    entries = slim.groupBy(*grouped).applyInPandas(exits, entry_schema)
    chosen = entries.groupBy(*keys).applyInPandas(compose, T.StructType(entry_schema.fields[:-1]))
    names = list(df.columns)
    return blocks.join(chosen, grouped).groupBy(*grouped).applyInPandas(thin, df.schema)


def delivered_luminosity(
    df: DataFrame, keys: Sequence[str], scale: float, block_width: int, gap: int = 30
) -> DataFrame:
    """Luminosity from the growth of a delivered integral (columns ``t`` seconds, ``rec``, ``integral``).

    Records near zero are dropped, the rest thinned to 30 seconds apart; a point lies
    in the middle between two kept records.
    """
    useful = df.where(F.abs("integral") >= 1e-9).withColumn("sec", F.floor("t").cast("bigint"))
    kept = spaced(useful, keys, "sec", "rec", gap, block_width)
    linked = blocked(
        kept, keys, F.floor(F.col("sec") / block_width), ["sec", "rec"],
        lag={"_sec": F.col("sec"), "_integral": F.col("integral")},
    )
    elapsed = F.col("sec") - F.col("_sec")
    return linked.where(F.col("_sec").isNotNull()).select(
        *keys,
        "rec",
        (F.col("_sec") + elapsed / 2).alias("time"),
        ((F.col("integral") - F.col("_integral")) / elapsed * 1e6 * scale).alias("lumi"),
    )


def instantaneous_luminosity(value: Column, scale: float) -> Column:
    return value * 1e3 * scale
