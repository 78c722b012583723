"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the rows need another exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the JVM does not compile methods beyond 8000 bytes; stages that long run better
    # operator by operator, in many small generated functions
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings the operators are written for to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def applied(spark: SparkSession) -> SparkSession:
    """Set those settings that a running session may still change."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without that setting (a unit test) gets a folder of its own: on a cluster
    the executors would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all of {master} shares")
        folder = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows outlive the executors that made them."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
