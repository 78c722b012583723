"""Streams over the files of a folder, run over all that is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import histograms
from eventloom.plans.domain import expressions
from eventloom.plans import aggregations, sources  # noqa: F401  (their SQL is checked here too)
from eventloom.plans.registry import ORACLES, query, r6
from eventloom.plans.sources import written_events
from eventloom.plans.timeseries import CORRECTED_SQL
from eventloom.session import work_path
from eventloom.sources import nested
from eventloom.streaming import flows

C = F.col


def _record_stream(spark, sf, name):
    """The event records that a flat table is made of, as a stream of files."""
    return flows.event_stream(spark, written_events(spark, sf, nested.kinds_of(name)))


def _table_stream(spark, sf, name):
    """A derived table over a stream of its base table's files."""
    source, columns = expressions(name)
    return flows.file_stream(spark, sf, f"{source}.parquet").selectExpr(*columns)


@query("s01_stream_flatten")
def stream_flatten(spark, sf):
    folder = work_path(spark, "flat")
    flows.append_to_folder(flows.flattened(_record_stream(spark, sf, "TRACKPAR"), "TRACKPAR"), folder)
    return spark.read.parquet(folder)


@query("s02_live_histogram")
def live_histogram(spark, sf):
    folder = work_path(spark, "live")
    cells = flows.flattened(_record_stream(spark, sf, "CALO"), "CALO")
    live = flows.live_histogram(cells, C("fAmplitude").cast("double"), 100, 0.0, 0.7)
    flows.batches_to_folder(live, folder, "complete")
    return histograms.filled(flows.latest_batch(spark, folder), 100)


@query(
    "s03_live_rates",
    f"""WITH {CORRECTED_SQL}, d AS (SELECT run, rec, c0_total AS total, c0_total - c0_before AS g, us / 1e6 - lag(us / 1e6) OVER (PARTITION BY run ORDER BY us, rec) AS dt FROM cc)
       SELECT run, rec, total, CASE WHEN dt > 0 THEN r6(g / dt) END AS rate FROM d""",
    ("counters",),
)
def live_rates(spark, sf):
    folder = work_path(spark, "rates")
    records = _table_stream(spark, sf, "counters").select(
        "run", "rec", (C("us") / F.lit(1e6)).alias("time"), C("c0").alias("count")
    )
    flows.batches_to_folder(flows.live_rates(records), folder, "update")
    found = flows.settled(spark.read.parquet(folder), ["run", "rec"], "revision")
    return found.select("run", "rec", "total", r6(C("rate")).alias("rate"))


@query("s04_live_error_log", ORACLES.get("e19_run_length_error_log"))
def live_error_log(spark, sf):
    folder = work_path(spark, "errors")
    log = _table_stream(spark, sf, "error_log").withColumn("code", C("code").cast("int"))
    flows.batches_to_folder(flows.live_error_log(log), folder, "update")
    found = flows.settled(spark.read.parquet(folder), ["file_id", "island"], "revision")
    return found.select("file_id", "island", *flows.SAME, "n")


ORACLES["s01_stream_flatten"] = ORACLES["a04_flatten_tracks"]
ORACLES["s02_live_histogram"] = (
    ORACLES["e01_histogram_amplitude"].replace("(amplitude ", "(amplitude::FLOAT::DOUBLE ")
    .replace("WHERE amplitude >= 0 AND amplitude <= 0.7", "WHERE amplitude::FLOAT::DOUBLE >= 0 AND amplitude::FLOAT::DOUBLE <= 0.7")
)
