"""What the operators share: the written tables between steps, document identifiers, Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import work_path

#: Stands for a missing document id inside an operator; it sorts before every other.
NO_ID = -(1 << 63)

#: Rows of an Arrow batch, so that a batch of long texts still fits a Python worker.
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Settings of the session that the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def known_id(column: Column) -> Column:
    """The id as a long, NO_ID where it is null."""
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def given_id(column: Column) -> Column:
    """The id as it was given: null for NO_ID."""
    return F.when(column != NO_ID, column)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (never null), ``text`` (null: empty) and the columns asked for; all others are left out."""
    return docs.select(
        known_id(docs["doc_id"]).alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        *(docs[c] for c in more),
    )
