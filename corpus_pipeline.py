"""From documents to packed training sequences: each stage works on all that the one before it kept.

Every stage but the last returns the columns of ``documents``. Its result is written as Parquet
to the shared folder and read again by the next one.

Defined results: rows without an id stay rows of their own, and stand after all ids where the smallest one counts; a null text
is handled as an empty one and stays null; repeated rows are near duplicates of each other, so one of them stays; columns of any
name go through all stages but the last; a table without documents gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourgrid.llm import decontaminate, jaccard, linededup, packing, quality
from hourgrid.llm.common import bound_batches, table
from hourgrid.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents that are there."""
    bound_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(spark, model, docs.text) >= quality.ACCEPT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller id holds; a document that loses all lines stays, empty."""
    bound_batches(spark)
    return linededup.drop_lines(docs, chars_col="n_chars")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    bound_batches(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule leaves alone, whole."""
    bound_batches(spark)
    return docs.filter(~decontaminate.contaminated_column(table(spark, sf_dir, "benchmark"), docs.text))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences."""
    bound_batches(spark)
    return packing.pack_texts(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The classifier's weights cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
