"""Ranking of rows by one or two objectives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid.operators.quantile import slice_edges, with_slice
from hourgrid.session import materialize


def or_infinity(c: str | Column) -> Column:
    """Missing or NaN objective values become +infinity."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    infinity = F.lit(float("inf"))
    return F.coalesce(F.nanvl(c, infinity), infinity)


def weighted_score(first: str, second: str, weight: float) -> Column:
    return F.col(first) + F.lit(weight) * F.col(second)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` values of each key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return picked.select(*keys, "row.*").select(*df.columns)


def top_rows(df: DataFrame, score: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n best rows; equal scores are ordered by ``ties``."""
    return df.orderBy(F.col(score).asc_nulls_last(), *ties).limit(n)


def best_row(df: DataFrame, score: str | Column, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the least score, found without sorting."""
    score = F.col(score) if isinstance(score, str) else score
    picked = df.where(score.isNotNull()).agg(F.min_by(F.struct(*df.columns), F.struct(score, *ties)).alias("row"))
    return picked.where(F.col("row").isNotNull()).select("row.*")


def pareto_front(df: DataFrame, first: str, second: str, slices: int | None = None) -> DataFrame:
    """Rows no other row dominates; both objectives are minimised, equal pairs stay together.

    Only the least ``second`` at each ``first`` can be on the front. Those pairs, written once, are
    cut into slices of distinct ``first`` values; the best ``second`` of all earlier slices comes from
    a table with one row per slice, the rest from a running minimum within the slice.
    """
    least = df.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(
        F.col(first).cast("double").alias("_x")
    ).agg(F.min(second).alias("_y"))
    least = materialize(least, "least")
    cut = with_slice(least, "_x", slice_edges(least, "_x", slices))
    earlier = Window.partitionBy(F.lit(1)).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    best = cut.groupBy("_i").agg(F.min("_y").alias("_m")).select(
        F.col("_i").alias("_j"), F.min("_m").over(earlier).alias("_outside")
    )
    inside = Window.partitionBy("_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    front = (
        cut.join(best, F.col("_i") == F.col("_j"))
        .withColumn("_inside", F.min("_y").over(inside))
        .where(F.coalesce(F.col("_y") < F.least("_outside", "_inside"), F.lit(True)))
    )
    on_front = (df[first] == front["_x"]) & (df[second] == front["_y"])
    return df.join(front.select("_x", "_y"), on_front, "left_semi")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows of each key; each task drops later rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)
