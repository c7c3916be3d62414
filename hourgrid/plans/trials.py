"""Trial tables of a parameter search with two objectives."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.operators.quantile import small_group_quantiles
from hourgrid.operators.ranking import first_per_key, or_infinity, top_rows, weighted_score
from hourgrid.plans.evaluate import coverage_error, mae
from hourgrid.sources.tables import read_table

ID, TIME, TARGET = params.ID, params.TIME, params.TARGET


def objectives(trials: DataFrame, first: str = "value_0", second: str = "value_1") -> DataFrame:
    """Missing objective values count as infinitely bad."""
    return trials.withColumns({first: or_infinity(first), second: or_infinity(second)})


def best_trials(
    trials: DataFrame, n: int = params.TOP_TRIALS, weight: float = params.CI_WEIGHT, keys: Sequence[str] = ("params",),
    number: str = "number", first: str = "value_0", second: str = "value_1",
) -> DataFrame:
    """The n best trials by first + weight * second; equal parameters keep the first trial."""
    scored = first_per_key(trials, keys, [number]).withColumn("total_value", weighted_score(first, second, weight))
    return top_rows(scored, "total_value", n, [number])


def parameter_grid(spark: SparkSession, **choices: Sequence) -> DataFrame:
    """Every combination of the given choices, one row per trial, with a JSON text of it."""
    names = list(choices)
    rows = [(i, *combo) for i, combo in enumerate(itertools.product(*choices.values()))]
    grid = spark.createDataFrame(rows, ["number", *names])
    return grid.withColumn("params", F.to_json(F.struct(*names)))


def score_trials(
    train: DataFrame, test: DataFrame, grid: DataFrame, ids: Sequence[str] = (ID,), time: str = TIME, value: str = TARGET,
) -> DataFrame:
    """The trials of ``grid`` with value_0 (MAE) and value_1 (coverage error) on the test range, means over series.

    A trial forecasts the value ``season_hours`` earlier, with quantiles of its training residuals; with ``window_hours`` (null: no
    bound) only those of the last so many training hours count. Trials are rows: each series meets its shifted copies by time once
    a season, then the trials of that season, so the plan is the same for any number of trials. A group is a series and a trial.
    The grid comes from the caller and is as small as that. A trial without any row has null values. Of
    repeated (series, time) rows one counts, a training row before a test row.
    """
    keys = list(ids)
    named = grid.select(
        F.col("number").cast("long").alias("number"), F.col("season_hours").cast("int").alias("season"),
        (F.col("window_hours") if "window_hours" in grid.columns else F.lit(None)).cast("int").alias("window"),
    )
    seasons = named.agg(F.collect_set("season")).scalar()
    end = train.agg(F.max(time)).scalar()

    rows = lambda df, fits: df.select(*keys, F.col(time), F.col(value).cast("double").alias("y"), F.lit(fits).alias("fits"))
    known = rows(train, True).unionByName(rows(test, False)).groupBy(*keys, time).agg(F.max(F.struct("fits", "y")).alias("row"))
    now = known.select(*keys, time, "row.y", "row.fits")
    past = known.withColumn("season", F.explode(seasons)).select(
        *keys, (F.col(time) + tu.hours(F.col("season"))).alias(time), "season", F.col("row.y").alias("base"), F.col("row.fits").alias("base_fits")
    )
    met = now.join(past, [*keys, time]).join(named, "season")
    recent = F.col("window").isNull() | (F.col(time) > end - tu.hours(F.col("window")))
    residual = F.when(F.col("fits") & F.col("base_fits") & recent, F.col("y") - F.col("base"))
    own = Window.partitionBy(*keys, "number")
    fitted = met.select(*keys, "number", "fits", "y", "base", residual.alias("residual")).withColumn(
        "rq", small_group_quantiles("residual", params.REPORT_QUANTILES).over(own)
    )
    low, mid, high = (F.col("base") + F.col("rq")[i] for i in range(3))
    per_series = fitted.where(~F.col("fits") & F.col("rq").isNotNull()).groupBy(*keys, "number").agg(
        mae("y", mid).alias("v0"), coverage_error("y", low, high).alias("v1")
    )
    scored = per_series.groupBy("number").agg(F.avg("v0").alias("value_0"), F.avg("v1").alias("value_1"))
    return grid.join(scored, "number", "left").select(*grid.columns, "value_0", "value_1")


def score_seasons(
    train: DataFrame, test: DataFrame, seasons: Sequence[int], ids: Sequence[str] = (ID,), time: str = TIME, value: str = TARGET
) -> DataFrame:
    """Rows (season_hours, value_0, value_1) of trials that differ in their season alone."""
    grid = parameter_grid(train.sparkSession, season_hours=list(seasons))
    return score_trials(train, test, grid, ids, time, value).select(F.col("season_hours").cast("int").alias("season_hours"), "value_0", "value_1")


def search(train: DataFrame, test: DataFrame, grid: DataFrame, path: str, **options) -> DataFrame:
    """Score the trials of ``grid`` that the trial table at ``path`` lacks, append them and return the table's trials of the grid.

    Trials are told apart by ``params``. All new ones are committed by one append, so a search that died is simply repeated, and
    one that is extended pays for its new trials only.
    """
    spark = train.sparkSession
    stored = read_table(spark, path)
    missing = grid if stored is None else grid.join(stored.select("params"), "params", "left_anti").select(*grid.columns)
    if not missing.isEmpty():
        append_trials(objectives(score_trials(train, test, missing, **options)), path)
    return spark.read.parquet(path).join(grid.select("params"), "params", "left_semi")


def append_trials(trials: DataFrame, path: str) -> None:
    """Keep a durable copy of the trial table as trials finish."""
    trials.write.mode("append").parquet(path)
