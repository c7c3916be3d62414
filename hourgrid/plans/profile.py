"""Data-quality profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.operators.quantile import level_columns, quantiles_of_counts, value_counts
from hourgrid.session import materialize

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def numeric_profile(df: DataFrame, columns: list[str] | None = None, decimals: int | None = None) -> DataFrame:
    """One row per numeric column: counts, min, max, mean and exact quartiles."""
    return _profile(_long(df, columns), ["column_name"], decimals)


def _long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")


def _profile(long: DataFrame, keys: list[str], decimals: int | None) -> DataFrame:
    """Everything follows from how often each value occurs, so the columns are read once
    for the counts and the rest works on distinct values."""
    counts = materialize(value_counts(long, keys, "value"), "value-counts")
    c, v = F.col("_c"), F.col("_v")
    known = F.sum(F.when(v.isNotNull(), c))
    if decimals is None:
        total = F.sum(v * c)
    else:
        total = F.sum(F.round(v * 10**decimals).cast("bigint") * c) / float(10**decimals)
    basics = counts.groupBy(*keys).agg(
        F.sum(c).alias("row_count"), F.coalesce(F.sum(F.when(v.isNull(), c)), F.lit(0)).alias("missing_count"),
        F.min(v).alias("min"), F.max(v).alias("max"), (total / known).alias("avg"),
    )
    rows = quantiles_of_counts(counts, keys, list(QUARTILES.values()))
    return basics.join(level_columns(rows, keys, QUARTILES), keys, "left")


def time_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per time column: counts and range."""
    kinds = (T.TimestampNTZType, T.TimestampType, T.DateType)
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, kinds)]
    long = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )
    return long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.min("value").alias("min_time"), F.max("value").alias("max_time"),
    )


def table_profile(tables: dict[str, DataFrame], decimals: int | None = None) -> DataFrame:
    """Numeric profiles of several tables in one frame, computed in one pass over each."""
    long = None
    for name, df in tables.items():
        part = _long(df).withColumn("table_name", F.lit(name))
        long = part if long is None else long.unionByName(part)
    return _profile(long, ["table_name", "column_name"], decimals)
