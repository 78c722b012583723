"""Text sources: slow-control files, resource logs and disk usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.counterfiles import read_counters  # noqa: F401  (one of the text sources)

# Fixed values
SLOW_CONTROL_FIXED = 4
SLOW_CONTROL_TYPES = ("i", "b", "f", "s")
BLOCK_END = "END_OF_BLOCK"

WATCH = (
    "hname string, sname string, id0 int, id1 int, id2 int, id3 int, first double, stampSec double,"
    " stampOldSec double, memVirtual double, memVirtualOld double, memResident double, memResidentOld double"
)


def _words(line: Column) -> Column:
    return F.split(F.trim(line), r"[ \t]+")


def read_slow_control(
    spark: SparkSession, path: str, start: float = 0.0, end: float = 0.0, alias: str | None = None
) -> DataFrame:
    """Slow-control files, one row per entry: name, type, ts, and its values.

    A line holds index, name, type and elements per entry (``f:2``), number of entries, and
    for each entry its values and its time, separated by tabs.  Shorter lines (block
    markers among them) are skipped, as are entries outside [start, end] when both are
    given.  Types are whole number, truth value, float and text; another fails the job.
    ``numbers`` holds the values of the first three, ``texts`` those of the last.
    """
    lines = spark.read.text(path, recursiveFileLookup=True)
    df = lines.where(~F.col("value").contains(BLOCK_END)).select(F.split("value", "\t").alias("t"))
    df = df.where(F.size("t") >= SLOW_CONTROL_FIXED)
    kind = F.split(F.col("t")[2], ":")
    df = df.where(F.size(kind) >= 2).select(
        F.col("t")[1].alias("name"),
        kind[0].alias("type"),
        kind[1].cast("int").alias("n"),
        F.col("t")[3].cast("int").alias("entries"),
        "t",
    )
    if alias is not None:
        df = df.where(F.col("name") == alias)
    known = F.col("type").isin(*SLOW_CONTROL_TYPES)
    df = df.withColumn("type", F.when(known, F.col("type")).otherwise(F.raise_error(F.concat(F.lit("unknown type "), "type"))))
    step = F.col("n") + 1
    starts = F.when(F.col("entries") > 0, F.transform(F.sequence(F.lit(0), F.col("entries") - 1), lambda i: i * step + 5))
    df = df.withColumn("_at", F.explode(starts)).select(
        "name",
        "type",
        F.element_at("t", F.col("_at") + F.col("n")).cast("double").alias("ts"),
        F.slice("t", F.col("_at"), F.col("n")).alias("texts"),
    )
    if start and end:
        df = df.where(F.col("ts").between(start, end))
    text = F.col("type") == "s"
    numbers = F.transform("texts", lambda v: v.cast("double"))
    truths = F.transform("texts", lambda v: (v.cast("double") != 0).cast("double"))
    value = F.when(text, F.lit(None)).when(F.col("type") == "b", truths).otherwise(numbers)
    return df.select("name", "type", "ts", value.alias("numbers"), F.when(text, F.col("texts")).alias("texts"))


def read_resource_log(spark: SparkSession, path: str) -> DataFrame:
    """Resource stamps (tab separated, with a header) with elapsed time and memory growth."""
    df = spark.read.schema(WATCH).option("sep", "\t").option("header", "true").csv(path)
    return df.withColumns(
        {
            "deltaT": F.col("stampSec") - F.col("stampOldSec"),
            "T": F.col("stampSec") - F.col("first"),
            "deltaVM": F.col("memVirtual") - F.col("memVirtualOld"),
            "VM": F.col("memVirtual"),
            "deltaRM": F.col("memResident") - F.col("memResidentOld"),
            "RM": F.col("memResident"),
        }
    )


def read_disk_usage(spark: SparkSession, path: str) -> DataFrame:
    """Sizes of folders (kilobytes and name per line), largest first."""
    df = spark.read.schema("size double, dir string").option("sep", " ").csv(path)
    pieces = F.split("dir", "/")
    units = {f"size{u}": F.col("size") / 1024 ** (i + 1) for i, u in enumerate(("MB", "GB", "TB", "PB"))}
    described = df.withColumns({"depth": F.size(pieces) - 1, "basename": F.element_at(pieces, -1), **units})
    return described.orderBy(F.desc("size"), "dir")
