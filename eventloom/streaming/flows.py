"""Structured Streaming over event files and counter records."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventloom.operators.counters import OVERFLOW_DROP, RANGE
from eventloom.operators.histograms import bin_of
from eventloom.session import work_path
from eventloom.sources.nested import RECORD_DDL, TABLES

# tables that need nothing but the record they come from
STATELESS = tuple(n for n in TABLES if n != "TIMEFRAME")


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Event records of the files that arrive in a folder."""
    reader = spark.readStream.schema(RECORD_DDL).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def file_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1000) -> DataFrame:
    """Rows of the Parquet files of a name pattern that arrive in a folder."""
    schema = spark.read.option("pathGlobFilter", name).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def flattened(events: DataFrame, name: str) -> DataFrame:
    """A flat table of a stream of records; the same plan as in batch."""
    if name not in STATELESS:
        raise ValueError(f"{name} is not made record by record; choose from {STATELESS}")
    return TABLES[name](events)


def append_to_folder(stream: DataFrame, folder: str) -> None:
    """Run a stateless stream over all input there is, appending to a folder of Parquet files."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", work_path(stream.sparkSession, "progress"))
        .option("path", folder)
        .option("compression", "zstd")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batches_to_folder(stream: DataFrame, folder: str, mode: str, progress: str | None = None) -> None:
    """Run a stream over all input there is, each batch into its own sub-folder ``batch=n``.

    A batch that is repeated after a failure replaces its folder. With the folder ``progress`` of an earlier run
    the stream goes on where that run stopped, with its state.
    """
    def store(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", progress or work_path(stream.sparkSession, "progress"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def live_histogram(stream: DataFrame, x: Column, n: int, lo: float, hi: float) -> DataFrame:
    """Counts per bin so far, for complete output."""
    bins = stream.select(bin_of(x, n, lo, hi).alias("bin")).where("bin IS NOT NULL")
    return bins.groupBy("bin").agg(F.count("*").alias("content"))


def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """What the last batch of a complete stream wrote."""
    rows = spark.read.parquet(folder)
    last = rows.agg(F.max("batch").alias("batch"))
    return rows.join(last, "batch").drop("batch")


#: Spark's watermark begins at the epoch; event times are moved this far beyond it, so that none is late at once.
ORIGIN_MS = 100 * 365 * 86_400_000
#: Before every time.
FIRST = -(1 << 62)


def _waiting(stream: DataFrame, milliseconds: Column, delay_ms: int) -> DataFrame:
    """The rows with their event time and its watermark; rows without a time are left out."""
    rows = stream.withColumn("_at", F.timestamp_millis((milliseconds + ORIGIN_MS).cast("bigint"))).where("_at IS NOT NULL")
    return rows.withWatermark("_at", f"{delay_ms} milliseconds")


def _line(state: GroupState, latest_ms: int, delay_ms: int) -> int:
    """Rows at or before this many milliseconds are late from now on; ``latest_ms`` is the key's latest.

    Spark itself drops by the watermark one batch behind, so the keys keep their line in the state and drop by it.
    """
    return max(state.getCurrentWatermarkMs() - ORIGIN_MS, latest_ms - delay_ms)


RATE_STATE = "revision bigint, line bigint, overflows bigint, rec array<bigint>, time array<double>, count array<bigint>"
RATES = "run bigint, rec bigint, total bigint, rate double, revision bigint"


def live_rates(stream: DataFrame, delay: float = 0.0) -> DataFrame:
    """Corrected counter and rate of every record (run, rec, time in seconds, count), in update mode.

    A record counts as late when it is ``delay`` seconds or more behind the latest of all, as of the batch before;
    late records are dropped. One that comes out of order, but not late, is put in its place, and it
    and the run's later records are given again with a higher ``revision``; `settled` takes the last. The state of
    a run is its records within the delay, the one before them, and the overflows up to that one. Records without a
    time or a count are left out.
    """
    delay_ms = round(delay * 1000)

    def step(key, frames, state):
        new = pd.concat(list(frames))
        revision, line, overflows, rec, time, count = state.get if state.exists else (0, FIRST, 0, [], [], [])
        new = new[np.floor(new["time"] * 1000) > line]
        if new.empty:
            return
        rec = np.concatenate([np.array(rec, np.int64), new["rec"].fillna(-1).to_numpy(np.int64)])
        time = np.concatenate([np.array(time, float), new["time"].to_numpy(float)])
        count = np.concatenate([np.array(count, np.int64), new["count"].to_numpy(np.int64)])
        order = np.lexsort((rec, time))
        first = int(np.flatnonzero(order >= len(order) - len(new))[0])
        rec, time, count = rec[order], time[order], count[order]
        wrapped = np.zeros(len(rec), bool)
        wrapped[1:] = (count[1:] < count[:-1]) & (count[:-1] - count[1:] > OVERFLOW_DROP)
        so_far = overflows + np.cumsum(wrapped)
        total = count + so_far * RANGE
        rate = np.full(len(rec), np.nan)
        elapsed = np.diff(time)
        np.divide(np.diff(total), elapsed, out=rate[1:], where=elapsed > 0)
        places = np.floor(time * 1000)
        line = _line(state, int(places[-1]), delay_ms)
        base = max(int(np.searchsorted(places, line, "right")) - 1, 0)
        columns = (rec[base:].tolist(), time[base:].tolist(), count[base:].tolist())
        state.update((revision + 1, line, int(so_far[base]), *columns))
        rows = pd.DataFrame({"rec": rec[first:], "total": total[first:], "rate": rate[first:]})
        rows.insert(0, "run", pd.array([None if pd.isna(key[0]) else key[0]] * len(rows), "Int64"))
        rows["rec"] = rows["rec"].astype("Int64").mask(rows["rec"] < 0)
        rows["rate"] = rows["rate"].astype(object).where(rows["rate"].notna(), None)
        yield rows.assign(revision=revision + 1)

    rows = _waiting(stream, F.floor(F.col("time") * 1000), delay_ms).where("count IS NOT NULL")
    rows = rows.select("run", "rec", "time", "count", "_at")
    return rows.groupBy("run").applyInPandasWithState(step, RATES, RATE_STATE, "update", GroupStateTimeout.EventTimeTimeout)


SAME = ["event_number", "ddl_id", "code"]
LOG_STATE = "revision bigint, line bigint, island bigint, n bigint, seq array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in SAME)
LOG = "file_id bigint, island bigint, event_number bigint, ddl_id bigint, code int, n bigint, revision bigint"


#: Rows of a frame that a step gives out.
_ROWS = 100_000


def _numbers(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers (0 where missing), and which are missing."""
    null = values.isna().to_numpy()
    return (values.fillna(0) if null.any() else values).to_numpy(np.int64), null


def live_error_log(stream: DataFrame, delay: int = 0) -> DataFrame:
    """Runs of equal messages (file_id, seq, event_number, ddl_id, code) with their counts so far, in update mode.

    A message is late when its ``seq`` is ``delay`` or more behind the greatest, as of the batch before. One that comes
    out of order, but not late, is put in its place; its run and the file's later ones are given again with a higher
    ``revision``. The state of a file is its messages within the delay, and the run that the last message before
    them is part of, with its number and count. Messages without a ``seq`` are left out.
    """

    def step(key, frames, state):
        revision, line, island, settled_n, *kept = state.get if state.exists else (0, FIRST, 1, 0, [], [], [], [])
        # frame by frame into plain numbers: a file's messages of one batch may be many
        held = [[_numbers(pd.Series(k, dtype="Int64"))] for k in kept]
        old = len(kept[0])
        for frame in frames:
            frame = frame[frame["seq"] > line]
            for part, c in zip(held, ("seq", *SAME), strict=True):
                part.append(_numbers(frame[c]))
        seq = np.concatenate([v for v, _ in held[0]])
        n = len(seq)
        if n == old:
            return
        order = np.argsort(seq, kind="stable")
        first = int(np.flatnonzero(order >= old)[0])
        seq = seq[order]
        same = []
        starts = np.zeros(n, bool)
        for part in held[1:]:
            value = np.concatenate([v for v, _ in part])[order]
            null = np.concatenate([m for _, m in part])[order]
            part.clear()
            starts[1:] |= (value[1:] != value[:-1]) | (null[1:] != null[:-1])
            same.append((value, null))
        begin = np.append(0, np.flatnonzero(starts))

        def run_of(row: int) -> int:
            return int(np.searchsorted(begin, row, "right")) - 1

        earlier = max(settled_n, 1) - 1  # of messages settled before, the first row stands for all of its run
        counts = np.diff(np.append(begin, n))
        counts[0] += earlier
        line = _line(state, int(seq[-1]), delay)
        base = int(np.searchsorted(seq, line, "right")) - 1
        settled_n = base + 1 - int(begin[run_of(base)]) + (earlier if run_of(base) == 0 else 0) if base >= 0 else 0
        base = max(base, 0)
        columns = [[None if m else int(v) for v, m in zip(value[base:], null[base:])] for value, null in same]
        state.update((revision + 1, line, island + run_of(base), settled_n, seq[base:].tolist(), *columns))
        for k in range(run_of(first), len(begin), _ROWS):
            at = begin[k : k + _ROWS]
            rows = pd.DataFrame({"island": island + np.arange(k, k + len(at))})
            for c, (value, null) in zip(SAME, same, strict=True):
                rows[c] = pd.arrays.IntegerArray(value[at], null[at])
            rows.insert(0, "file_id", pd.array([None if pd.isna(key[0]) else key[0]] * len(rows), "Int64"))
            yield rows.assign(code=rows["code"].astype("Int32"), n=counts[k : k + len(at)], revision=revision + 1)

    rows = _waiting(stream, F.col("seq"), delay).select("file_id", "seq", *SAME, "_at")
    return rows.groupBy("file_id").applyInPandasWithState(step, LOG, LOG_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def settled(updates: DataFrame, keys: Sequence[str], grows: str) -> DataFrame:
    """The last state of rows that were updated with a growing value."""
    others = [c for c in updates.columns if c not in keys]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*others), grows).alias("_row")).select(*keys, "_row.*")
