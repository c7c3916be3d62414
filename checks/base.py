"""Test tables in the roles of market tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import mean_of, sum_of

CUTOFF = "2024-01-03 00:00:00"
START = "2024-01-01 00:00:00"
DECIMALS = 2                      # event values and line prices have two decimals
LOCAL = {"decimals": DECIMALS, "measure": "double"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def half_away(c: Column, places: int) -> Column:
    """Round half away from zero, as the SQL side does."""
    scale = float(10**places)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles, so that equal results compare equal in both engines."""
    return df.select(
        *[
            half_away(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


# --- adapters ------------------------------------------------------------------

def intervals(spark, sf_dir, node: str = "event_type") -> DataFrame:
    """Events as interval prices: one row per event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "event_type", "ts", "value",
        tu.hour_ending("ts").alias("he"), tu.fixed_offset(tu.hour_ending("ts")).alias("timestamp_mst"),
        F.col(node).cast("string").alias("node"),
    )


def lmp(spark, sf_dir, node: str = "event_type") -> DataFrame:
    return intervals(spark, sf_dir, node).select(
        F.col("node").alias("Settlement_Location_Name"), F.col("timestamp_mst").alias("timestamp_mst_HE"),
        F.col("value").alias("LMP"),
    )


def mtlf(spark, sf_dir) -> DataFrame:
    """One load row per hour and event type, so that an hour has several rows to average."""
    return intervals(spark, sf_dir).groupBy("timestamp_mst", "event_type").agg(
        sum_of("value", DECIMALS).alias("MTLF"), F.count(F.lit(1)).cast("double").alias("Averaged_Actual")
    )


def mtrf(spark, sf_dir) -> DataFrame:
    i = intervals(spark, sf_dir)
    pick = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    return i.select("timestamp_mst", pick("click").alias("Wind_Forecast_MW"), pick("view").alias("Solar_Forecast_MW"))


def gen_cap(spark, sf_dir) -> DataFrame:
    """Hourly sums by event type in the role of generation by fuel."""
    i = intervals(spark, sf_dir)
    total = lambda *kinds: F.coalesce(
        sum_of(F.when(F.col("event_type").isin(*kinds), F.col("value")), DECIMALS), F.lit(0.0)
    )
    return i.groupBy("timestamp_mst").agg(
        total("click").alias("Coal_Market"), total("view").alias("Coal_Self"), total("purchase").alias("Hydro"),
        total("error").alias("Natural_Gas"), total("signup").alias("Nuclear"),
        total("click", "view").alias("Solar"), total("error", "signup").alias("Wind"),
    )


def hourly_price(spark, sf_dir) -> DataFrame:
    """Mean value per event type and hour."""
    return intervals(spark, sf_dir).groupBy(
        F.col("event_type").alias("unique_id"), "timestamp_mst"
    ).agg(mean_of("value", DECIMALS).alias("LMP"))


def daily_price(spark, sf_dir) -> DataFrame:
    """Line items as a long daily panel: node = return flag, one step per ship date."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("unique_id"), F.col("l_shipdate").alias("timestamp_mst")).agg(
        mean_of("l_extendedprice", DECIMALS).alias("LMP"), mean_of("l_quantity", DECIMALS).alias("MTLF")
    )


# --- the same in SQL -------------------------------------------------------------

def he(c: str) -> str:
    return f"CASE WHEN date_trunc('hour', {c}) = {c} THEN {c} ELSE date_trunc('hour', {c}) + INTERVAL 1 HOUR END"


def ceil5(c: str) -> str:
    low = f"time_bucket(INTERVAL 5 MINUTE, {c})"
    return f"CASE WHEN {low} = {c} THEN {c} ELSE {low} + INTERVAL 5 MINUTE END"


def total(x: str) -> str:
    return f"CAST(sum(CAST(round(({x}) * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)"


def mean(x: str) -> str:
    return f"{total(x)} / count({x})"


IV = f"iv AS (SELECT event_id, user_id, event_type, ts, value, {he('ts')} AS he, ({he('ts')}) - INTERVAL 7 HOUR AS timestamp_mst FROM events)"
PRICE = f"price AS (SELECT event_type AS unique_id, timestamp_mst, {mean('value')} AS LMP FROM iv GROUP BY ALL)"
LOAD = (
    f"mtlf AS (SELECT timestamp_mst, event_type, {total('value')} AS MTLF, CAST(count(*) AS DOUBLE) AS Averaged_Actual FROM iv GROUP BY ALL), "
    f"load AS (SELECT timestamp_mst, {mean('MTLF')} AS MTLF, {mean('Averaged_Actual')} AS Averaged_Actual FROM mtlf GROUP BY ALL)"
)
RENEWABLE = (
    "mtrf AS (SELECT timestamp_mst, CASE WHEN event_type = 'click' THEN value END AS w, CASE WHEN event_type = 'view' THEN value END AS s FROM iv), "
    f"renewable AS (SELECT timestamp_mst, {mean('w')} AS Wind_Forecast_MW, {mean('s')} AS Solar_Forecast_MW FROM mtrf GROUP BY ALL)"
)


def rolling_sql(name: str, window: str) -> str:
    out = []
    for i in (2, 3, 4, 5, 6):
        terms = " + ".join([f"lag({name}, {k}) OVER {window}" for k in range(i, 0, -1)] + [name])
        out.append(f"{terms} AS {name}_rolling_{i}")
    return ", ".join(out)


HOURS = f"""{LOAD}, {RENEWABLE},
hours AS (SELECT timestamp_mst, MTLF, Averaged_Actual, Wind_Forecast_MW, Solar_Forecast_MW FROM load LEFT JOIN renewable USING (timestamp_mst)
          WHERE timestamp_mst >= TIMESTAMP '{CUTOFF}'),
h1 AS (SELECT *, (Wind_Forecast_MW + Solar_Forecast_MW) / NULLIF(MTLF, 0) AS re_ratio,
       CASE WHEN abs(MTLF - Wind_Forecast_MW - Solar_Forecast_MW) < 1 THEN CAST(1 AS DOUBLE) ELSE MTLF - Wind_Forecast_MW - Solar_Forecast_MW END AS load_net_re FROM hours),
h2 AS (SELECT *, re_ratio - lag(re_ratio) OVER w AS re_diff, MTLF - lag(MTLF) OVER w AS mtlf_diff,
       Wind_Forecast_MW - lag(Wind_Forecast_MW) OVER w AS wind_diff, Solar_Forecast_MW - lag(Solar_Forecast_MW) OVER w AS solar_diff,
       load_net_re - lag(load_net_re) OVER w AS load_net_re_diff FROM h1 WINDOW w AS (ORDER BY timestamp_mst)),
hf AS (SELECT *, {rolling_sql('load_net_re_diff', 'w')} FROM h2 WINDOW w AS (ORDER BY timestamp_mst))"""

HOUR_COLS = ["MTLF", "Averaged_Actual", "Wind_Forecast_MW", "Solar_Forecast_MW", "re_ratio", "re_diff", "mtlf_diff", "wind_diff",
             "solar_diff", "load_net_re", "load_net_re_diff"] + [f"load_net_re_diff_rolling_{i}" for i in (2, 3, 4, 5, 6)]


def panel_sql(node: str = "event_type") -> str:
    return f"""{IV}, {HOURS},
price AS (SELECT CAST({node} AS VARCHAR) AS unique_id, timestamp_mst, {mean('value')} AS LMP FROM iv GROUP BY ALL),
grid AS (SELECT n.unique_id, h.timestamp_mst FROM (SELECT DISTINCT CAST({node} AS VARCHAR) AS unique_id FROM events) n CROSS JOIN hours h),
p1 AS (SELECT unique_id, timestamp_mst, LMP FROM grid LEFT JOIN price USING (unique_id, timestamp_mst)),
p2 AS (SELECT *, LMP - lag(LMP) OVER w AS lmp_diff FROM p1 WINDOW w AS (PARTITION BY unique_id ORDER BY timestamp_mst)),
p3 AS (SELECT *, {rolling_sql('lmp_diff', 'w')} FROM p2 WINDOW w AS (PARTITION BY unique_id ORDER BY timestamp_mst)),
panel AS (SELECT p3.*, hf.* EXCLUDE (timestamp_mst), LMP / NULLIF(load_net_re, 0) AS lmp_load_net_re FROM p3 JOIN hf USING (timestamp_mst))"""


PANEL_COLS = ["LMP", "lmp_diff"] + [f"lmp_diff_rolling_{i}" for i in (2, 3, 4, 5, 6)] + HOUR_COLS + ["lmp_load_net_re"]


def r6(*cols: str, places: int = 6) -> str:
    """Rounded columns for a SELECT list."""
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


def dense_sql(source: str, cols: list[str], step: str = "1 HOUR", out: str = "dense", grid_only: bool = False) -> str:
    """Gap filling and linear interpolation of ``source(unique_id, timestamp_mst, cols)``."""
    grid = f"""bounds_{out} AS (SELECT unique_id, min(timestamp_mst) AS lo, max(timestamp_mst) AS hi FROM {source} GROUP BY ALL),
grid_{out} AS (SELECT g.unique_id, g.timestamp_mst, {', '.join('s.' + c for c in cols)} FROM
  (SELECT unique_id, unnest(generate_series(lo, hi, INTERVAL {step})) AS timestamp_mst FROM bounds_{out}) g
  LEFT JOIN {source} s ON s.unique_id = g.unique_id AND s.timestamp_mst = g.timestamp_mst)"""
    if grid_only:
        return grid
    look = []
    final = []
    for c in cols:
        look.append(f"""last_value(CASE WHEN {c} IS NOT NULL THEN epoch(timestamp_mst) END IGNORE NULLS) OVER b AS pt_{c},
 last_value({c} IGNORE NULLS) OVER b AS py_{c},
 first_value(CASE WHEN {c} IS NOT NULL THEN epoch(timestamp_mst) END IGNORE NULLS) OVER a AS nt_{c},
 first_value({c} IGNORE NULLS) OVER a AS ny_{c}""")
        final.append(f"""CASE WHEN {c} IS NOT NULL THEN {c}
 WHEN py_{c} IS NOT NULL AND ny_{c} IS NOT NULL THEN py_{c} + (ny_{c} - py_{c}) * (epoch(timestamp_mst) - pt_{c}) / (nt_{c} - pt_{c})
 ELSE coalesce(py_{c}, ny_{c}) END AS {c}""")
    return f"""{grid},
look_{out} AS (SELECT *, {', '.join(look)} FROM grid_{out}
 WINDOW b AS (PARTITION BY unique_id ORDER BY timestamp_mst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        a AS (PARTITION BY unique_id ORDER BY timestamp_mst ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{out} AS (SELECT unique_id, timestamp_mst, {', '.join(final)} FROM look_{out})"""


DAILY = f"""daily AS (SELECT l_returnflag AS unique_id, l_shipdate AS timestamp_mst, {mean('l_extendedprice')} AS LMP, {mean('l_quantity')} AS MTLF
 FROM lineitem GROUP BY ALL)"""
