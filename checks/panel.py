"""Feature, series and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    CUTOFF, DAILY, DECIMALS, HOUR_COLS, HOURS, IV, LOAD, LOCAL, PANEL_COLS, PRICE, RENEWABLE, START,
    daily_price, dense_sql, gen_cap, half_away, he, hourly_price, intervals, lmp, mean, mtlf, mtrf, panel_sql, r6, rounded, table, total,
)
from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import clamp
from hourgrid.operators import series, training
from hourgrid.operators.windows import lag_diff, series_window, with_rolling_sums
from hourgrid.plans import features, report
from hourgrid.sources import feeds

Q: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


def panel(spark, sf, node="event_type"):
    return features.build_features(
        lmp(spark, sf, node), mtlf(spark, sf), mtrf(spark, sf), start=START, pattern=".", exclude=None,
        cutoff=CUTOFF, **LOCAL,
    ).select("unique_id", "timestamp_mst", *PANEL_COLS)


def dense(spark, sf):
    """Hourly price of each event type without gaps."""
    return series.filled_series(hourly_price(spark, sf), ["LMP"])


def dense_daily(spark, sf):
    return series.filled_series(daily_price(spark, sf), ["LMP", "MTLF"], step="INTERVAL '1' DAY")


# --- time and scalar expressions -------------------------------------------------

@query("hour_ending", f"SELECT event_id, {he('ts')} AS hour_ending FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", tu.hour_ending("ts").alias("hour_ending"))


@query("five_min_ceiling", """SELECT event_id, CASE WHEN time_bucket(INTERVAL 5 MINUTE, ts) = ts THEN ts
 ELSE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE END AS interval_end FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", tu.ceil_minutes("ts", 5).alias("interval_end"))


@query("fixed_offset", "SELECT event_id, ts - INTERVAL 7 HOUR AS timestamp_mst FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", tu.fixed_offset("ts").alias("timestamp_mst"))


@query("calendar_encoders", """SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
 CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", tu.month_of("ts").alias("month"), tu.day_of_week("ts").alias("weekday"), tu.hour_of_day("ts").alias("hour")
    )


@query("relative_position", f"""WITH {IV}, o AS (SELECT event_type, max(he) - INTERVAL 120 HOUR AS origin FROM iv GROUP BY ALL)
SELECT event_id, CAST((epoch(he) - epoch(origin)) / 3600 AS INTEGER) AS position FROM iv JOIN o USING (event_type)""")
def _(spark, sf):
    i = intervals(spark, sf)
    origin = i.groupBy("event_type").agg((F.max("he") - tu.hours(params.HORIZON)).alias("origin"))
    return i.join(origin, "event_type").select("event_id", tu.relative_position("he", "origin").alias("position"))


@query("clamp_price", "SELECT c_custkey, round(greatest(least(c_acctbal, 200), -200), 6) AS price FROM customer")
def _(spark, sf):
    return rounded(table(spark, sf, "customer").select("c_custkey", clamp("c_acctbal").alias("price")))


@query("location_filter", """SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(small|red|blue) ')
 AND NOT contains(p_name, 'widget')""")
def _(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", F.col("p_name"))
    return features.select_locations(named, "^(small|red|blue) ", "widget", "p_name")


@query("time_range", """SELECT o_orderkey, o_orderdate FROM orders
 WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1999-06-30'""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return features.time_range(o, "o_orderdate", "1996-03-01 00:00:00", "1999-06-30 00:00:00")


# --- table preparation -----------------------------------------------------------

@query("hourly_price", f"""WITH {IV} SELECT he AS "Interval_HE", he AS "GMTIntervalEnd_HE", timestamp_mst AS "timestamp_mst_HE",
 event_type AS "Settlement_Location_Name", CAST(user_id AS VARCHAR) AS "PNODE_Name", round({mean('value')}, 6) AS "LMP",
 round({mean('-value')}, 6) AS "MLC", round({mean('2 * value')}, 6) AS "MCC", round({mean('value')}, 6) AS "MEC",
 max(ts) AS file_create_time_utc FROM iv GROUP BY he, timestamp_mst, event_type, user_id""")
def _(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(
        F.col("ts").alias("Interval"), F.col("ts").alias("GMTIntervalEnd"), tu.fixed_offset("ts").alias("timestamp_mst"),
        F.col("event_type").alias("Settlement_Location_Name"), F.col("user_id").cast("string").alias("PNODE_Name"),
        F.col("value").alias("LMP"), (-F.col("value")).alias("MLC"), (2 * F.col("value")).alias("MCC"), F.col("value").alias("MEC"),
        F.col("ts").alias("file_create_time_utc"), F.col("event_id").cast("string").alias("url"),
    )
    return rounded(feeds.hourly_prices(rows, "mean", "double", DECIMALS).drop("url"))


@query("prep_price", f"""WITH {IV}, price AS (SELECT event_type AS unique_id, timestamp_mst, {mean('value')} AS LMP FROM iv
 WHERE regexp_matches(event_type, '^[cvpe]') AND NOT contains(event_type, 'error')
 AND timestamp_mst >= TIMESTAMP '2024-01-02' AND timestamp_mst <= TIMESTAMP '2024-01-25' GROUP BY ALL)
SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP",
 round(LMP - lag(LMP) OVER (PARTITION BY unique_id ORDER BY timestamp_mst), 6) AS lmp_diff FROM price""")
def _(spark, sf):
    return rounded(features.prep_price(
        lmp(spark, sf), start="2024-01-02 00:00:00", end="2024-01-25 00:00:00", pattern="^[cvpe]", exclude="error", **LOCAL
    ))


@query("price_diff", f"""WITH {IV}, {PRICE} SELECT unique_id, timestamp_mst,
 round(LMP - lag(LMP) OVER (PARTITION BY unique_id ORDER BY timestamp_mst), 6) AS lmp_diff FROM price""")
def _(spark, sf):
    p = hourly_price(spark, sf)
    return rounded(p.select("unique_id", "timestamp_mst", lag_diff("LMP", series_window("unique_id")).alias("lmp_diff")))


@query("rolling_sums", f"""WITH {IV}, {PRICE}, d AS (SELECT *, LMP - lag(LMP) OVER w AS lmp_diff FROM price
 WINDOW w AS (PARTITION BY unique_id ORDER BY timestamp_mst)), r AS (SELECT unique_id, timestamp_mst,
 {', '.join(f"{' + '.join([f'lag(lmp_diff, {k}) OVER w' for k in range(i, 0, -1)] + ['lmp_diff'])} AS lmp_diff_rolling_{i}" for i in (2, 3, 4, 5, 6))}
 FROM d WINDOW w AS (PARTITION BY unique_id ORDER BY timestamp_mst))
SELECT unique_id, timestamp_mst, {r6(*[f'lmp_diff_rolling_{i}' for i in (2, 3, 4, 5, 6)])} FROM r""")
def _(spark, sf):
    w = series_window("unique_id")
    p = hourly_price(spark, sf).withColumn("lmp_diff", lag_diff("LMP", w))
    return rounded(with_rolling_sums(p, "lmp_diff", w, measure="double").drop("LMP", "lmp_diff"))


@query("prep_load", f"WITH {IV}, {LOAD} SELECT timestamp_mst, {r6('MTLF', 'Averaged_Actual')} FROM load")
def _(spark, sf):
    return rounded(features.prep_load(mtlf(spark, sf), "2023-12-31 00:00:00", **LOCAL))


@query("prep_renewable", f"WITH {IV}, {RENEWABLE} SELECT timestamp_mst, {r6('Wind_Forecast_MW', 'Solar_Forecast_MW')} FROM renewable")
def _(spark, sf):
    return rounded(features.prep_renewable(mtrf(spark, sf), "2023-12-31 00:00:00", **LOCAL))


@query("prep_weather", f"""WITH {IV} SELECT timestamp_mst, round(CAST(value AS DOUBLE), 6) AS temperature FROM iv
 WHERE timestamp_mst >= TIMESTAMP '2024-01-05' AND timestamp_mst <= TIMESTAMP '2024-01-20 12:00:00'""")
def _(spark, sf):
    w = intervals(spark, sf).select(F.col("he").alias("timestamp"), "timestamp_mst", F.col("value").alias("temperature"))
    return rounded(features.prep_weather(w, "2024-01-05 00:00:00", "2024-01-20 12:00:00", measure="double"))


def _fuel(*kinds):
    names = ", ".join(f"'{k}'" for k in kinds)
    return f"coalesce({total(f'CASE WHEN event_type IN ({names}) THEN value END')}, 0)"


@query("fuel_combine", f"""WITH {IV} SELECT timestamp_mst, round({_fuel('click')} + {_fuel('view')}, 6) AS "Coal",
 round({_fuel('purchase')}, 6) AS "Hydro", round({_fuel('error')}, 6) AS "Natural_Gas", round({_fuel('signup')}, 6) AS "Nuclear",
 round({_fuel('click', 'view')}, 6) AS "Solar", round({_fuel('error', 'signup')}, 6) AS "Wind" FROM iv GROUP BY timestamp_mst""")
def _(spark, sf):
    return rounded(features.prep_generation(gen_cap(spark, sf), "2023-12-31 00:00:00", measure="double"))


@query("clip_outliers", """WITH n AS (SELECT count(value) AS n FROM events),
b AS (SELECT (SELECT value FROM events ORDER BY value LIMIT 1 OFFSET (SELECT CAST(floor((n - 1) * 0.0025 + 0.5) AS BIGINT) FROM n)) AS low,
 (SELECT value FROM events ORDER BY value LIMIT 1 OFFSET (SELECT CAST(floor((n - 1) * 0.9975 + 0.5) AS BIGINT) FROM n)) AS high)
SELECT event_id, round(CASE WHEN value > high THEN high WHEN value < low THEN low ELSE value END, 6) AS "LMP" FROM events, b""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("value").alias("LMP"))
    return rounded(features.clip_outliers(e))


@query("join_load_renewable", f"""WITH {IV}, {LOAD}, {RENEWABLE} SELECT timestamp_mst,
 {r6('MTLF', 'Averaged_Actual', 'Wind_Forecast_MW', 'Solar_Forecast_MW')} FROM load LEFT JOIN renewable USING (timestamp_mst)""")
def _(spark, sf):
    load = features.prep_load(mtlf(spark, sf), "2023-12-31 00:00:00", **LOCAL)
    renewable = features.prep_renewable(mtrf(spark, sf), "2023-12-31 00:00:00", **LOCAL)
    return rounded(load.join(renewable, "timestamp_mst", "left"))


@query("node_hour_grid", f"""WITH {IV} SELECT n.unique_id, h.timestamp_mst FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS unique_id FROM events) n
 CROSS JOIN (SELECT DISTINCT timestamp_mst FROM iv) h""")
def _(spark, sf):
    nodes = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("unique_id"))
    return features.node_hours(nodes, intervals(spark, sf).select("timestamp_mst"))


@query("panel_join", f"""WITH {panel_sql()} SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM p1""")
def _(spark, sf):
    return rounded(panel(spark, sf).select("unique_id", "timestamp_mst", "LMP"))


@query("net_load_features", f"WITH {IV}, {HOURS} SELECT timestamp_mst, {r6(*HOUR_COLS)} FROM hf")
def _(spark, sf):
    load = features.prep_load(mtlf(spark, sf), START, **LOCAL)
    renewable = features.prep_renewable(mtrf(spark, sf), START, **LOCAL)
    hours = features.hour_features(load, renewable, CUTOFF, "double")
    return rounded(hours.select("timestamp_mst", *HOUR_COLS))


DIFFS = ["lmp_diff", "re_diff", "mtlf_diff", "wind_diff", "solar_diff", "load_net_re_diff"]


@query("feature_diffs", f"WITH {panel_sql()} SELECT unique_id, timestamp_mst, {r6(*DIFFS)} FROM panel")
def _(spark, sf):
    return rounded(panel(spark, sf).select("unique_id", "timestamp_mst", *DIFFS))


@query("feature_panel", f"WITH {panel_sql()} SELECT unique_id, timestamp_mst, {r6(*PANEL_COLS)} FROM panel")
def feature_panel(spark, sf):
    return rounded(panel(spark, sf))


@query("feature_panel_users", f"WITH {panel_sql('user_id')} SELECT unique_id, timestamp_mst, {r6(*PANEL_COLS)} FROM panel")
def _(spark, sf):
    return rounded(panel(spark, sf, "user_id"))


@query("model_columns", f"""WITH {panel_sql()} SELECT timestamp_mst, unique_id,
 {r6('LMP', *params.PAST_COLS, *params.FUTURE_COLS)} FROM panel""")
def _(spark, sf):
    return rounded(features.model_columns(panel(spark, sf)))


# --- series ----------------------------------------------------------------------

@query("gap_fill", f"""WITH {IV}, {PRICE}, {dense_sql('price', ['LMP'], grid_only=True)}
SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM grid_dense""")
def _(spark, sf):
    return rounded(series.fill_grid(hourly_price(spark, sf)))


@query("interpolate", f"""WITH {IV}, {PRICE}, {dense_sql('price', ['LMP'])}
SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM dense""")
def _(spark, sf):
    return rounded(dense(spark, sf))


COVS = ["LMP", "MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW", "re_ratio", "lmp_diff"]


@query("interpolate_covariates", f"""WITH {panel_sql()}, {dense_sql('panel', COVS)}
SELECT unique_id, timestamp_mst, {r6(*COVS)} FROM dense""")
def _(spark, sf):
    return rounded(series.filled_series(panel(spark, sf), COVS))


@query("ratio_after_fill", f"""WITH {panel_sql()}, {dense_sql('panel', ['MTLF', 'Wind_Forecast_MW', 'Solar_Forecast_MW'])}
SELECT unique_id, timestamp_mst, round((Wind_Forecast_MW + Solar_Forecast_MW) / NULLIF(MTLF, 0), 6) AS "Ratio" FROM dense""")
def _(spark, sf):
    cols = ["MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW"]
    filled = series.filled_series(panel(spark, sf), cols)
    return rounded(series.ratio_after_fill(filled).select("unique_id", "timestamp_mst", "Ratio"))


CUTS = f"""WITH {IV}, {PRICE}, cuts AS (SELECT min(timestamp_mst) + INTERVAL 96 HOUR AS train_start,
 max(timestamp_mst) - INTERVAL 144 HOUR AS split, max(timestamp_mst) - INTERVAL 48 HOUR AS test_end FROM price)
SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM price, cuts WHERE """


def _split(part):
    def run(spark, sf):
        return rounded(series.temporal_split(hourly_price(spark, sf), input_chunk=48, buffer_hours=48)[part])
    return run


for _name, _part, _cond in [
    ("split_train", "train", "timestamp_mst > train_start AND timestamp_mst < split"),
    ("split_test", "test", "timestamp_mst > split AND timestamp_mst < test_end"),
    ("split_train_test", "train_test", "timestamp_mst > train_start AND timestamp_mst < test_end"),
    ("split_all", "all", "true"),
]:
    Q[_name] = (_split(_part), CUTS + _cond)


@query("truncate_history", f"""WITH {IV}, {PRICE}, o AS (SELECT unique_id, max(timestamp_mst) - INTERVAL 120 HOUR AS origin FROM price GROUP BY ALL)
SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM price JOIN o USING (unique_id) WHERE timestamp_mst < origin""")
def _(spark, sf):
    p = hourly_price(spark, sf)
    o = p.groupBy("unique_id").agg((F.max("timestamp_mst") - tu.hours(120)).alias("origin"))
    return rounded(series.truncate_history(p.join(o, "unique_id"), "origin").drop("origin"))


@query("pack_series", f"""WITH {IV}, {PRICE}, t AS (SELECT unique_id, '{{"time":"' || strftime(timestamp_mst, '%Y-%m-%d %H:%M:%S') || '","LMP":' ||
 CAST(CAST(round(LMP, 0) AS BIGINT) AS VARCHAR) || '}}' AS point, timestamp_mst FROM price)
SELECT unique_id, '[' || string_agg(point, ',' ORDER BY timestamp_mst) || ']' AS series FROM t GROUP BY unique_id""")
def _(spark, sf):
    p = hourly_price(spark, sf).withColumn("LMP", F.round("LMP", 0).cast("bigint"))
    return series.pack_series(p, ["LMP"])


@query("unpack_series", f"""WITH {IV}, {PRICE} SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP" FROM price""")
def _(spark, sf):
    packed = series.pack_series(hourly_price(spark, sf), ["LMP"])
    return rounded(series.unpack_series(packed, ["LMP"]))


@query("origins", f"""WITH {IV}, h AS (SELECT CAST(user_id AS VARCHAR) AS unique_id, max(timestamp_mst) AS hi FROM iv GROUP BY ALL)
SELECT unique_id, unnest(generate_series(hi - INTERVAL 9 DAY, hi, INTERVAL 1 DAY)) AS origin FROM h""")
def _(spark, sf):
    i = intervals(spark, sf, "user_id").select(F.col("node").alias("unique_id"), "timestamp_mst")
    return series.origins(i)


WINDOWS_SQL = f"""WITH {DAILY}, {dense_sql('daily', ['LMP', 'MTLF'], '1 DAY')},
x AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY timestamp_mst) - 1 AS step FROM dense),
w AS (SELECT unique_id, timestamp_mst AS origin, step, count(*) OVER p AS n_past, count(*) OVER f AS n_future, CAST(sum(CAST(round(LMP * 10000) AS BIGINT)) OVER p AS BIGINT) AS past_sum,
 CAST(sum(CAST(round(MTLF * 10000) AS BIGINT)) OVER f AS BIGINT) AS future_sum, avg(LMP) OVER p AS norm_mean, stddev_pop(LMP) OVER p AS norm_std, first_value(LMP) OVER p AS first_past,
 max(timestamp_mst) OVER f AS last_time FROM x
 WINDOW p AS (PARTITION BY unique_id ORDER BY timestamp_mst ROWS BETWEEN 167 PRECEDING AND CURRENT ROW),
        f AS (PARTITION BY unique_id ORDER BY timestamp_mst ROWS BETWEEN 1 FOLLOWING AND 120 FOLLOWING))
"""


def _windows(spark, sf):
    return training.training_windows(dense_daily(spark, sf), ["LMP"], ["MTLF"], step_hours=24)


def _total(window, field):
    """Sum over a window in ten-thousandths: integers, so the order of addition does not matter."""
    start = F.lit(0).cast("bigint")
    return F.aggregate(window, start, lambda a, r: a + F.floor(r[field] * 10000 + 0.5)).alias(f"{window}_sum")


@query("training_windows", WINDOWS_SQL + f"""SELECT unique_id, origin, CAST(n_past AS INTEGER) AS n_past, CAST(n_future AS INTEGER) AS n_future,
 past_sum, future_sum, last_time FROM w WHERE n_past = 168 AND n_future = 120 AND (step - 167) % 25 = 0""")
def _(spark, sf):
    w = _windows(spark, sf)
    return w.select(
        "unique_id", "origin", F.size("past").alias("n_past"), F.size("future").alias("n_future"),
        _total("past", "LMP"), _total("future", "MTLF"), F.element_at("future", -1)["timestamp_mst"].alias("last_time"),
    )


@query("frame_windows", WINDOWS_SQL + f"""SELECT unique_id, origin, past_sum, future_sum FROM w
 WHERE n_past = 168 AND n_future = 120""")
def _(spark, sf):
    w = training.frame_windows(dense_daily(spark, sf), ["LMP"], ["MTLF"])
    return w.select("unique_id", "origin", _total("past", "LMP"), _total("future", "MTLF"))


@query("instance_norm", WINDOWS_SQL + f"""SELECT unique_id, origin, {r6('norm_mean', 'norm_std', places=4)},
 round((first_past - norm_mean) / sqrt(norm_std * norm_std + 0.00001), 4) AS norm_first, round(first_past, 7) AS restored_first FROM w
 WHERE n_past = 168 AND n_future = 120 AND (step - 167) % 25 = 0""")
def _(spark, sf):
    w = training.with_instance_norm(_windows(spark, sf))
    first = F.col("past_norm")[0]
    restored = training.denormalize(first, F.col("norm_mean"), F.col("norm_std"))
    return w.select(
        "unique_id", "origin", half_away(F.col("norm_mean"), 4).alias("norm_mean"), half_away(F.col("norm_std"), 4).alias("norm_std"),
        half_away(first, 4).alias("norm_first"), half_away(restored, 7).alias("restored_first"),
    )


@query("robust_scale", """WITH s AS (SELECT quantile_cont(l_extendedprice, 0.25) AS lo, quantile_cont(l_extendedprice, 0.5) AS mid,
 quantile_cont(l_extendedprice, 0.75) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - mid) / (hi - lo), 6) AS scaled FROM lineitem, s""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(
        training.robust_scale(li, ["l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("scaled"))
    )


# --- report ------------------------------------------------------------------------

@query("price_nodes", "SELECT DISTINCT event_type AS unique_id FROM events")
def _(spark, sf):
    return report.price_nodes(table(spark, sf, "events").select(F.col("event_type").alias("unique_id")))


@query("available_hours", """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), n AS (SELECT max(ts) AS newest FROM events)
SELECT date, lpad(CAST(unnest(generate_series(0, CASE WHEN CAST(newest AS DATE) = date THEN hour(newest) ELSE 23 END)) AS VARCHAR), 2, '0') AS hour FROM d, n""")
def _(spark, sf):
    return report.available_hours(table(spark, sf, "events"), "ts")


@query("date_bounds", """SELECT o_custkey AS unique_id, greatest(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) - INTERVAL 60 DAY AS DATE)) AS min_date,
 CAST(max(o_orderdate) AS DATE) AS max_date FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("unique_id"), F.col("o_orderdate").alias("timestamp_mst"))
    return report.date_bounds(o)


@query("time_bounds", "SELECT min(o_orderdate) AS min_date, max(o_orderdate) AS max_date FROM orders")
def _(spark, sf):
    from hourgrid.operators.upsert import time_bounds

    return time_bounds(table(spark, sf, "orders"), "o_orderdate")
