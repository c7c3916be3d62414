"""Display frames, display tables and selector lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import display_round

COVARIATES = ["MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW", "Ratio", "load_net_re"]
TABLE_COLUMNS = [
    "node", "time", "LMP_HOURLY", "mean_fcast", "q10", "q50", "q90",
    "MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW", "Ratio",
]


def display_frame(summary: DataFrame, covariates: DataFrame, prices: DataFrame) -> DataFrame:
    """All covariate hours of each node with its forecast and actual price where known."""
    keys = ["node", "time"]
    return (
        summary.select(*keys, "mean_fcast", "q10", "q50", "q90")
        .join(covariates, keys, "right")
        .join(prices.select(*keys, "LMP_HOURLY"), keys, "left")
    )


def display_window(display: DataFrame, lookback_hours: int = params.DISPLAY_LOOKBACK_HOURS) -> DataFrame:
    """Rows from ``lookback`` before a node's first forecast through its last one."""
    seen = F.when(F.col("mean_fcast").isNotNull(), F.col("time"))
    bounds = display.groupBy("node").agg(
        (F.min(seen) - tu.hours(lookback_hours)).alias("_lo"), F.max(seen).alias("_hi")
    )
    return display.join(bounds, "node").where(F.col("time").between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def display_table(display: DataFrame, places: int = 2) -> DataFrame:
    """The eleven report columns, rounded half-even."""
    keys = TABLE_COLUMNS[:2]
    return display.select(*keys, *[display_round(c, places).alias(c) for c in TABLE_COLUMNS[2:]])


def price_nodes(prices: DataFrame, node: str = params.ID) -> DataFrame:
    return prices.select(node).distinct().orderBy(node)


def available_hours(prices: DataFrame, time: str = params.TIME) -> DataFrame:
    """Two-digit hour labels of every date: up to the last hour of data on the newest
    date, all 24 on earlier dates."""
    newest = prices.agg(F.max(time)).scalar()
    by_date = prices.groupBy(F.to_date(time).alias("date")).agg(F.max(time).alias("_last")).withColumn("_newest", newest)
    last_hour = F.when(F.to_date("_newest") == F.col("date"), F.hour("_newest")).otherwise(23)
    return by_date.select("date", F.explode(F.sequence(F.lit(0), last_hour)).alias("_h")).select(
        "date", F.lpad(F.col("_h").cast("string"), 2, "0").alias("hour")
    )


def date_bounds(prices: DataFrame, node: str = params.ID, time: str = params.TIME, days: int = params.FORECASTABLE_DAYS) -> DataFrame:
    """Dates a forecast may start on, per node: the newest date and 60 days before it,
    not before the node's first date."""
    span = prices.groupBy(node).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    return span.select(
        node, F.greatest(F.to_date("_lo"), F.to_date(F.col("_hi") - tu.days(days))).alias("min_date"),
        F.to_date("_hi").alias("max_date"),
    )
