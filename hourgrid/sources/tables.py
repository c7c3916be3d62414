"""Parquet tables by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    return read_table(spark, path) is not None


def read_files(spark: SparkSession, *paths: str, glob: str | None = None) -> DataFrame:
    """Several parquet files, or those of a folder whose names match ``glob``."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.parquet(*paths)


def load_tables(
    spark: SparkSession, base: str, names: Iterable[str] = ("lmp", "mtrf", "mtlf"), suffix: str = ""
) -> dict[str, DataFrame]:
    """Register parquet tables as temporary views; nothing is copied."""
    tables = {}
    for name in names:
        tables[name] = spark.read.parquet(f"{table_path(base, name)}{suffix}")
        tables[name].createOrReplaceTempView(name)
    return tables
