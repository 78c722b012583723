"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontamination, jaccard, lines, packing, toxicity
from eventloom.llm.queries import remainder, table
from eventloom.llm.shared import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not make toxic."""
    labels = table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels, label="toxic", learn=remainder(labels["doc_id"], 3) != 1)
    return toxicity.without_toxic(docs, index)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line that several hold only in the first of them; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of similar ones."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces in packed sequences, with the digest of each piece's ids."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Nearest neighbours, groups and tokens are beyond SQL; the tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
