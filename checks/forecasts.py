"""Forecast, evaluation and ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import DAILY, DECIMALS, IV, PRICE, dense_sql, intervals, mean, r6, rounded, table, total
from checks.panel import dense, dense_daily
from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import mean_of, sum_of
from hourgrid.operators import leastsquares, ranking, series
from hourgrid.operators.quantile import exact_quantiles
from hourgrid.operators.training import training_origins
from hourgrid.plans import evaluate, forecast, report, trials
from hourgrid.session import materialize, scratch_path

Q: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


LEVELS = params.QUANTILE_LEVELS
LEVEL_LIST = "[" + ", ".join(str(v) for v in LEVELS) + "]"


# --- samples -------------------------------------------------------------------------
# Samples of one forecast hour: the events of one type in one hour.

def samples(spark, sf):
    return intervals(spark, sf).select(
        F.col("event_type").alias("node"), F.col("he").alias("time"), F.col("user_id").alias("sample_id"), "value"
    )


@query("sample_quantiles", f"""WITH {IV} SELECT event_type AS node, he AS time, round(quantile_cont(value, 0.1), 6) AS q10,
 round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.9), 6) AS q90 FROM iv GROUP BY ALL""")
def _(spark, sf):
    return rounded(evaluate.pooled_quantiles(samples(spark, sf), ["node", "time"]))


@query("sample_mean", f"WITH {IV} SELECT event_type AS node, he AS time, round({mean('value')}, 6) AS mean_fcast FROM iv GROUP BY ALL")
def _(spark, sf):
    return rounded(samples(spark, sf).groupBy("node", "time").agg(mean_of("value", DECIMALS).alias("mean_fcast")))


@query("quantile_grid", " UNION ALL ".join(
    f"SELECT event_type, CAST({v} AS DOUBLE) AS level, round(quantile_cont(value, {v}), 6) AS quantile FROM events GROUP BY event_type" for v in LEVELS))
def _(spark, sf):
    return rounded(exact_quantiles(table(spark, sf, "events"), ["event_type"], "value", LEVELS))


@query("unpivot_samples", """WITH p AS (SELECT event_id, unnest([value, 2 * value, -value]) AS value, generate_subscripts([value, 2 * value, -value], 1) - 1 AS s FROM events)
SELECT event_id, CAST(s AS INTEGER) AS sample_id, round(value, 6) AS value FROM p""")
def _(spark, sf):
    wide = table(spark, sf, "events").select("event_id", F.array(F.col("value"), 2 * F.col("value"), -F.col("value")).alias("samples"))
    return rounded(forecast.unpivot_samples(wide, ["event_id"]))


# --- display ---------------------------------------------------------------------------
# Forecast: hourly sample summary of the last ten days.

FCAST_START = "2024-01-21 00:00:00"


def summary(spark, sf):
    rows = samples(spark, sf)
    late = F.col("time") >= F.lit(FCAST_START).cast("timestamp_ntz")
    q = evaluate.pooled_quantiles(rows, ["node", "time"])
    m = rows.groupBy("node", "time").agg(mean_of("value", DECIMALS).alias("mean_fcast"))
    return m.join(q, ["node", "time"]).where(late)


def covariates(spark, sf):
    nodes = samples(spark, sf).select("node", "time", "value")
    return nodes.groupBy("node", "time").agg(
        F.max("value").alias("MTLF"), F.min("value").alias("Wind_Forecast_MW"), (F.max("value") - F.min("value")).alias("Solar_Forecast_MW"),
        F.count(F.lit(1)).cast("double").alias("Ratio"), (2 * F.max("value")).alias("load_net_re"),
    )


def actuals(spark, sf):
    """Actual price of a node and hour: the mean without the largest value; null for a single one."""
    rest = F.try_divide(sum_of("value", DECIMALS) - F.max("value"), F.count("value") - 1)
    return samples(spark, sf).groupBy("node", "time").agg(rest.alias("LMP_HOURLY"))


def display(spark, sf):
    return report.display_frame(summary(spark, sf), covariates(spark, sf), actuals(spark, sf))


def group_quantile(level: float) -> str:
    """low + (high - low) * share over the sorted values ``l`` of a group: display rounding
    sees the last binary digit, so the order of operations is spelt out."""
    at = f"(len(l) - 1) * CAST({level} AS DOUBLE)"
    low, high = f"l[CAST(floor({at}) AS BIGINT) + 1]", f"l[CAST(ceil({at}) AS BIGINT) + 1]"
    return f"{low} + ({high} - {low}) * ({at} - floor({at}))"


DISPLAY = f"""WITH {IV}, s AS (SELECT event_type, he, list_sort(list(value)) AS l, {mean('value')} AS mean_fcast FROM iv GROUP BY ALL),
f AS (SELECT event_type AS node, he AS time, mean_fcast, {group_quantile(0.1)} AS q10, {group_quantile(0.5)} AS q50, {group_quantile(0.9)} AS q90 FROM s WHERE he >= TIMESTAMP '{FCAST_START}'),
c AS (SELECT event_type AS node, he AS time, max(value) AS MTLF, min(value) AS Wind_Forecast_MW, max(value) - min(value) AS Solar_Forecast_MW,
 CAST(count(*) AS DOUBLE) AS Ratio, 2 * max(value) AS load_net_re FROM iv GROUP BY ALL),
p AS (SELECT event_type AS node, he AS time, ({total('value')} - max(value)) / NULLIF(count(value) - 1, 0) AS LMP_HOURLY FROM iv GROUP BY ALL),
d AS (SELECT * FROM f RIGHT JOIN c USING (node, time) LEFT JOIN p USING (node, time)),
b AS (SELECT node, min(time) - INTERVAL 168 HOUR AS lo, max(time) AS hi FROM d WHERE mean_fcast IS NOT NULL GROUP BY ALL),
win AS (SELECT d.* FROM d JOIN b USING (node) WHERE time BETWEEN lo AND hi)
"""
SHOWN = ["mean_fcast", "q10", "q50", "q90", "MTLF", "Wind_Forecast_MW", "Solar_Forecast_MW", "Ratio", "load_net_re", "LMP_HOURLY"]


@query("display_frame", DISPLAY + f"SELECT node, time, {r6(*SHOWN)} FROM d")
def _(spark, sf):
    return rounded(display(spark, sf))


@query("display_window", DISPLAY + f"SELECT node, time, {r6(*SHOWN)} FROM win")
def _(spark, sf):
    return rounded(report.display_window(display(spark, sf)))


@query("display_table", DISPLAY + "SELECT node, time, " + ", ".join(
    f"round_even({c} * 100, 0) / 100 AS {c}" for c in report.TABLE_COLUMNS[2:]) + " FROM win")
def _(spark, sf):
    return report.display_table(report.display_window(display(spark, sf)))


# --- metrics ---------------------------------------------------------------------------

BOTH = "FROM d WHERE mean_fcast IS NOT NULL AND LMP_HOURLY IS NOT NULL GROUP BY node"


def scored(spark, sf):
    d = display(spark, sf)
    return d.where(F.col("mean_fcast").isNotNull() & F.col("LMP_HOURLY").isNotNull())


def _metric(name, expression, sql):
    def run(spark, sf):
        return rounded(scored(spark, sf).groupBy("node").agg(expression().alias(name)))
    Q[f"forecast_{name}" if name in ("mae", "bias", "rmse") else name] = (run, DISPLAY + f"SELECT node, round({sql}, 6) AS {name} {BOTH}")


_metric("mae", lambda: evaluate.mae("LMP_HOURLY", "mean_fcast"), "avg(abs(LMP_HOURLY - mean_fcast))")
_metric("bias", lambda: evaluate.bias("LMP_HOURLY", "mean_fcast"), "avg(mean_fcast - LMP_HOURLY)")
_metric("rmse", lambda: evaluate.rmse("LMP_HOURLY", "mean_fcast"), "sqrt(avg((LMP_HOURLY - mean_fcast) * (LMP_HOURLY - mean_fcast)))")
_metric("ci_coverage", lambda: evaluate.report_coverage("LMP_HOURLY", "q10", "q90"),
        "1 - avg(CASE WHEN LMP_HOURLY < q10 OR LMP_HOURLY > q90 THEN 1 ELSE 0 END)")
_metric("coverage_error", lambda: evaluate.coverage_error("LMP_HOURLY", "q10", "q90"),
        "100 * abs(avg(CASE WHEN q90 > LMP_HOURLY AND q10 < LMP_HOURLY THEN 1 ELSE 0 END) - 0.8)")


@query("report_metrics", DISPLAY + """SELECT node, count(*) FILTER (WHERE mean_fcast IS NOT NULL AND LMP_HOURLY IS NOT NULL) AS n_hours,
 round_even(avg(abs(LMP_HOURLY - mean_fcast)) * 100, 0) / 100 AS mae_2, round_even(avg(mean_fcast - LMP_HOURLY) * 100, 0) / 100 AS bias_2,
 round(1 - avg(CASE WHEN mean_fcast IS NULL OR LMP_HOURLY IS NULL THEN NULL WHEN LMP_HOURLY < q10 OR LMP_HOURLY > q90 THEN 1 ELSE 0 END), 6) AS ci_coverage
 FROM d GROUP BY node""")
def _(spark, sf):
    m = evaluate.report_metrics(display(spark, sf))
    one = lambda c: F.expr(f"try_cast({c} AS DOUBLE)").alias(f"{c}_2")
    return m.select("node", "n_hours", one("mae"), one("bias"), F.round("ci_coverage", 6).alias("ci_coverage"))


@query("model_report", DISPLAY + """, n AS (SELECT node, avg(abs(LMP_HOURLY - q50)) AS mae, sqrt(avg((LMP_HOURLY - q50) * (LMP_HOURLY - q50))) AS rmse,
 100 * abs(avg(CASE WHEN q90 > LMP_HOURLY AND q10 < LMP_HOURLY THEN 1 ELSE 0 END) - 0.8) AS ci_coverage_error, count(*) AS n_hours
 FROM d WHERE q50 IS NOT NULL AND LMP_HOURLY IS NOT NULL GROUP BY node)
SELECT node, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(ci_coverage_error, 6) AS ci_coverage_error, n_hours FROM n
UNION ALL SELECT NULL, round(avg(mae), 6), round(avg(rmse), 6), round(avg(ci_coverage_error), 6), CAST(sum(n_hours) AS BIGINT) FROM n""")
def _(spark, sf):
    return rounded(evaluate.model_report(display(spark, sf), "node", "LMP_HOURLY"))


# --- members ---------------------------------------------------------------------------

HISTORY = f"WITH {IV}, {PRICE}, {dense_sql('price', ['LMP'])}"


def q_columns(df, *keys):
    """Low, middle and high levels of the 21."""
    pick = {"q01": 0, "q50": 10, "q99": 20}
    return df.select(*keys, *[F.col("q")[i].alias(n) for n, i in pick.items()])


def origins_of(history):
    """Four days before the end of each series, 96 hours to forecast."""
    return history.groupBy("unique_id").agg((F.max("timestamp_mst") - tu.hours(96)).alias("origin"))


PROFILE_SQL = HISTORY + """, o AS (SELECT unique_id, max(timestamp_mst) - INTERVAL 96 HOUR AS origin FROM dense GROUP BY ALL),
hist AS (SELECT d.* FROM dense d JOIN o USING (unique_id) WHERE timestamp_mst < origin),
t AS (SELECT unique_id, origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS time FROM o, generate_series(1, 96) g(h)),
prof AS (SELECT unique_id, isodow(timestamp_mst) AS wd, hour(timestamp_mst) AS hr, quantile_cont(LMP, {levels}) AS q FROM hist GROUP BY ALL),
fp AS (SELECT t.*, q FROM t JOIN prof p ON p.unique_id = t.unique_id AND p.wd = isodow(t.time) AND p.hr = hour(t.time)),
res AS (SELECT a.unique_id, quantile_cont(a.LMP - b.LMP, {levels}) AS rq FROM hist a JOIN hist b ON a.unique_id = b.unique_id AND b.timestamp_mst = a.timestamp_mst - INTERVAL 168 HOUR GROUP BY ALL),
fn AS (SELECT t.*, [b.LMP + r for r in rq] AS q FROM t JOIN hist b ON b.unique_id = t.unique_id AND b.timestamp_mst = t.time - INTERVAL 168 HOUR JOIN res ON res.unique_id = t.unique_id)
""".replace("{levels}", LEVEL_LIST)
Q3 = "round(q[1], 9) AS q01, round(q[11], 9) AS q50, round(q[21], 9) AS q99"


def members(spark, sf):
    full = dense(spark, sf)
    o = origins_of(full)
    history = series.truncate_history(full.join(o, "unique_id"), "origin").drop("origin")
    return forecast.predict_members(history, forecast.forecast_targets(o, 96))


@query("profile_forecast", PROFILE_SQL + f"SELECT unique_id, origin, horizon, time, {Q3} FROM fp")
def _(spark, sf):
    return rounded(q_columns(members(spark, sf)["profile"], "unique_id", "origin", "horizon", "time"), 9)


@query("seasonal_naive", PROFILE_SQL + f"SELECT unique_id, origin, horizon, time, {Q3} FROM fn")
def _(spark, sf):
    return rounded(q_columns(members(spark, sf)["seasonal_naive"], "unique_id", "origin", "horizon", "time"), 9)


@query("ensemble_mean", PROFILE_SQL + """SELECT unique_id, origin, horizon, time, round(avg(q[1]), 9) AS q01, round(avg(q[11]), 9) AS q50, round(avg(q[21]), 9) AS q99
 FROM (SELECT unique_id, origin, horizon, time, q FROM fp UNION ALL SELECT unique_id, origin, horizon, time, q FROM fn) GROUP BY ALL""")
def _(spark, sf):
    m = forecast.ensemble_mean(list(members(spark, sf).values()))
    return rounded(q_columns(m, "unique_id", "origin", "horizon", "time"), 9)


@query("quantile_samples", PROFILE_SQL + """SELECT unique_id, time, CAST(200 AS BIGINT) AS n_samples, true AS inside, round(q[1], 9) AS q01, round(q[21], 9) AS q99 FROM fp""")
def _(spark, sf):
    """Samples per forecast hour, and whether all lie within the outer quantiles."""
    f = members(spark, sf)["profile"].select("unique_id", "time", "q", F.col("q")[0].alias("q01"), F.col("q")[20].alias("q99"))
    s = forecast.sample_paths(f, params.SAMPLES_BACKTEST)
    inside = F.bool_and(F.col("value").between(F.col("q01"), F.col("q99")))
    return rounded(s.groupBy("unique_id", "time", "q01", "q99").agg(F.count(F.lit(1)).alias("n_samples"), inside.alias("inside")), 9)


@query("sampled_forecast")
def _(spark, sf):
    """Ensemble samples and their summary, as a request for every node would return."""
    m = forecast.ensemble_mean(list(members(spark, sf).values()))
    return evaluate.sample_summary(forecast.sample_paths(m, params.SAMPLES_REQUEST), ["unique_id", "time"])


@query("linear_forecast")
def _(spark, sf):
    """Direct linear model on the daily panel with a future covariate."""
    full = dense_daily(spark, sf)
    fitted = forecast.fit_linear(full, training_origins(full, step_hours=24), params.HORIZON, ["MTLF"], step_hours=24)
    last = full.groupBy("unique_id").agg((F.max("timestamp_mst") - tu.days(params.HORIZON)).alias("origin"))
    return q_columns(forecast.predict_linear(fitted, full, last, params.HORIZON, 24), "unique_id", "origin", "horizon", "time")


MOMENTS = f"""WITH {DAILY}, {dense_sql('daily', ['LMP', 'MTLF'], '1 DAY')},
d AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS step, avg(LMP) OVER (w ROWS 23 PRECEDING) AS mean_24, count(*) OVER (PARTITION BY unique_id) - 1 AS last
      FROM dense WINDOW w AS (PARTITION BY unique_id ORDER BY timestamp_mst)),
e AS MATERIALIZED (SELECT unique_id, step, LMP AS f_last, mean_24 AS f_mean, unnest(range(1, {params.HORIZON} + 1)) AS h FROM d
      WHERE step >= {params.INPUT_CHUNK - 1} AND (step - {params.INPUT_CHUNK - 1}) % {params.BACKTEST_STRIDE} = 0 AND step <= last - {params.HORIZON}),
r AS (SELECT e.h AS horizon, t.LMP AS y, e.f_last, e.f_mean, s.LMP AS f_season FROM e JOIN d t ON t.unique_id = e.unique_id AND t.step = e.step + e.h
      JOIN d s ON s.unique_id = e.unique_id AND s.step = e.step + e.h - {forecast.SEASON_HOURS})
SELECT CAST(horizon AS INTEGER) AS horizon, count(*) AS n_rows, round(avg(y), 6) AS mean_y, round(sum(y * f_last) / sum(y * y), 9) AS by_last,
 round(sum(y * f_mean) / sum(y * y), 9) AS by_mean, round(sum(y * f_season) / sum(y * y), 9) AS by_season, true AS solved FROM r GROUP BY horizon"""


@query("linear_moments", MOMENTS)
def _(spark, sf):
    """Sums of products that the linear member is fitted from, by horizon, and whether its coefficients solve the normal equations."""
    full, names = dense_daily(spark, sf), forecast.linear_features(["MTLF"])
    rows = materialize(forecast.linear_training_rows(full, training_origins(full, step_hours=24), params.HORIZON, ["MTLF"], step_hours=24), "rows")
    parts = leastsquares.moments(rows, names, "y", ["horizon"])
    size = len(names) + 2
    sums = lambda i, j: F.col("m")[i * size - i * (i - 1) // 2 + j - i]
    by = {"by_last": "f_last", "by_mean": "f_mean_24", "by_season": "f_season"}
    last = size - 1
    shown = parts.select(
        "horizon", F.col("n").alias("n_rows"), (sums(0, last) / F.col("n")).alias("mean_y"),
        *[F.round(sums(names.index(f) + 1, last) / sums(last, last), 9).alias(c) for c, f in by.items()],
    ).withColumn("mean_y", F.round("mean_y", 6))
    fitted = leastsquares.fit(parts, "horizon", (0.0,)).select("horizon", "coefficients")
    errors = rows.join(fitted, "horizon").withColumn("e", F.col("y") - leastsquares.predicted("coefficients", names))
    # Errors are orthogonal to every feature, and to 1.
    near = lambda x: F.abs(F.avg(F.col("e") * x)) <= 1e-6 * F.sqrt(F.avg(F.col("y") * F.col("y")) * F.avg(x * x)) + 1e-9
    solved = near(F.lit(1.0))
    for n in names:
        solved = solved & near(F.col(n))
    return shown.join(errors.groupBy("horizon").agg(solved.alias("solved")), "horizon")


@query("member_discovery", """SELECT p_partkey, artifact, kind AS member_kind FROM (SELECT p_partkey, artifact, CASE WHEN contains(artifact, 'tsmixer') THEN 'mixer'
 WHEN contains(artifact, 'tide_') THEN 'dense' WHEN contains(artifact, 'tft') THEN 'attention' END AS kind FROM
 (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'tide_' WHEN p_size < 20 THEN 'tft_' WHEN p_size < 30 THEN 'tsmixer_' ELSE 'other_' END || CAST(p_partkey AS VARCHAR) ||
 CASE WHEN p_retailprice < 950 THEN '.pt' WHEN p_retailprice < 1000 THEN '.pt.ckpt' ELSE '.pt' END AS artifact FROM part)) WHERE kind IS NOT NULL AND NOT contains(artifact, '.ckpt')""")
def _(spark, sf):
    size, price = F.col("p_size"), F.col("p_retailprice")
    name = F.concat(
        F.when(size < 10, "tide_").when(size < 20, "tft_").when(size < 30, "tsmixer_").otherwise("other_"),
        F.col("p_partkey").cast("string"), F.when(price < 950, ".pt").when(price < 1000, ".pt.ckpt").otherwise(".pt"),
    )
    return forecast.discover_members(table(spark, sf, "part").select("p_partkey", name.alias("artifact")))


# --- backtest and trials -----------------------------------------------------------------

TEST_START = "2024-01-20 00:00:00"
BACKTEST = HISTORY + f""", train AS (SELECT * FROM dense WHERE timestamp_mst < TIMESTAMP '{TEST_START}'), test AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY timestamp_mst) - 1 AS step
 FROM dense WHERE timestamp_mst >= TIMESTAMP '{TEST_START}'),
prof AS (SELECT unique_id, isodow(timestamp_mst) AS wd, hour(timestamp_mst) AS hr, quantile_cont(LMP, [0.1, 0.5, 0.9]) AS q FROM train GROUP BY ALL),
res AS (SELECT a.unique_id, quantile_cont(a.LMP - b.LMP, [0.1, 0.5, 0.9]) AS rq FROM train a JOIN train b ON a.unique_id = b.unique_id AND b.timestamp_mst = a.timestamp_mst - INTERVAL 168 HOUR GROUP BY ALL),
last AS (SELECT unique_id, max(step) AS last FROM test GROUP BY ALL),
t AS (SELECT test.unique_id, o.timestamp_mst AS origin, test.timestamp_mst AS time, test.LMP AS actual FROM test JOIN last USING (unique_id)
 JOIN test o ON o.unique_id = test.unique_id AND test.step > o.step AND test.step <= o.step + 24 WHERE o.step >= 47 AND (o.step - 47) % 25 = 0 AND o.step <= last - 24),
m AS (SELECT t.*, (p.q[1] + b.LMP + rq[1]) / 2 AS lo, (p.q[2] + b.LMP + rq[2]) / 2 AS mid, (p.q[3] + b.LMP + rq[3]) / 2 AS hi FROM t
 JOIN prof p ON p.unique_id = t.unique_id AND p.wd = isodow(time) AND p.hr = hour(time)
 JOIN dense b ON b.unique_id = t.unique_id AND b.timestamp_mst = t.time - INTERVAL 168 HOUR JOIN res ON res.unique_id = t.unique_id),
per AS (SELECT unique_id, origin, avg(abs(actual - mid)) AS mae, 100 * abs(avg(CASE WHEN hi > actual AND lo < actual THEN 1 ELSE 0 END) - 0.8) AS ci_error, count(*) AS n_hours FROM m GROUP BY ALL)
"""


def split(spark, sf):
    full = dense(spark, sf)
    at = F.lit(TEST_START).cast("timestamp_ntz")
    return full.where(F.col("timestamp_mst") < at), full.where(F.col("timestamp_mst") >= at)


def run_backtest(spark, sf):
    train, test = split(spark, sf)
    return evaluate.backtest(train, test, horizon=24, input_chunk=48)


@query("backtest", BACKTEST + "SELECT unique_id, origin, round(mae, 6) AS mae, round(ci_error, 6) AS ci_error, n_hours FROM per")
def _(spark, sf):
    return rounded(run_backtest(spark, sf))


@query("backtest_summary", BACKTEST + "SELECT unique_id, round(avg(mae), 6) AS mae, round(avg(ci_error), 6) AS ci_error, count(*) AS n_origins FROM per GROUP BY ALL")
def _(spark, sf):
    return rounded(evaluate.backtest_summary(run_backtest(spark, sf)))


def _season_sql(season):
    return f"""SELECT {season} AS season_hours, avg(v0) AS value_0, avg(v1) AS value_1 FROM (SELECT unique_id, avg(abs(y - mid)) AS v0,
 100 * abs(avg(CASE WHEN hi > y AND lo < y THEN 1 ELSE 0 END) - 0.8) AS v1 FROM (SELECT te.unique_id, te.LMP AS y, b.LMP + rq[1] AS lo, b.LMP + rq[2] AS mid, b.LMP + rq[3] AS hi
 FROM test te JOIN dense b ON b.unique_id = te.unique_id AND b.timestamp_mst = te.timestamp_mst - INTERVAL {season} HOUR
 JOIN (SELECT a.unique_id, quantile_cont(a.LMP - c.LMP, [0.1, 0.5, 0.9]) AS rq FROM train a JOIN train c ON a.unique_id = c.unique_id AND c.timestamp_mst = a.timestamp_mst - INTERVAL {season} HOUR GROUP BY ALL) r
 ON r.unique_id = te.unique_id) GROUP BY ALL)"""


@query("search_grid", BACKTEST + ", g AS (" + " UNION ALL ".join(_season_sql(s) for s in (24, 48, 168)) + ") SELECT season_hours, round(value_0, 6) AS value_0, round(value_1, 6) AS value_1 FROM g")
def _(spark, sf):
    train, test = split(spark, sf)
    return rounded(trials.score_seasons(train, test, [24, 48, 168]))


SEARCHED = [(24, 72), (24, 400), (48, 72), (48, 400), (168, 72), (168, 400)]


def _trial_sql(number, season, window):
    recent = f"a.timestamp_mst > (SELECT max(timestamp_mst) FROM train) - INTERVAL {window} HOUR AND c.timestamp_mst = a.timestamp_mst"
    return _season_sql(season).replace("c.timestamp_mst = a.timestamp_mst", recent).replace(f"SELECT {season} AS", f"SELECT CAST({number} AS BIGINT) AS number, CAST({window} AS BIGINT) AS window_hours, CAST({season} AS BIGINT) AS", 1)


@query("search_trials", BACKTEST + ", g AS (" + " UNION ALL ".join(_trial_sql(i, *t) for i, t in enumerate(SEARCHED)) + """) SELECT number, season_hours, window_hours,
 round(value_0, 6) AS value_0, round(value_1, 6) AS value_1, round(value_0 + 0.5 * value_1, 6) AS total_value FROM g ORDER BY value_0 + 0.5 * value_1, number LIMIT 5""")
def _(spark, sf):
    """A search in two runs over one stored table: the second adds a window to the first."""
    train, test = split(spark, sf)
    path = scratch_path(spark, "trials")
    grid = trials.parameter_grid(spark, season_hours=[24, 48, 168], window_hours=[72, 400])
    trials.search(train, test, grid.where("window_hours = 72"), path)
    return rounded(trials.best_trials(trials.search(train, test, grid, path), weight=0.5).drop("params"))


def trial_rows(spark, sf):
    """Parts as trials: size and price objectives, brand and type as parameters."""
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("number"), F.concat_ws("/", "p_brand", "p_type").alias("params"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")).alias("value_0"), F.col("p_size").cast("double").alias("value_1"),
    )


TRIALS = """WITH t AS (SELECT p_partkey AS number, p_brand || '/' || p_type AS params, CASE WHEN p_size % 7 <> 0 THEN p_retailprice ELSE CAST('Infinity' AS DOUBLE) END AS value_0,
 CAST(p_size AS DOUBLE) AS value_1 FROM part), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY params ORDER BY number) AS rn FROM t) WHERE rn = 1)
"""


@query("trial_objectives", TRIALS + "SELECT number, params, value_0, value_1 FROM t")
def _(spark, sf):
    return trials.objectives(trial_rows(spark, sf))


@query("top_trials", TRIALS + """SELECT number, params, value_0, value_1, round(value_0 + 0.5 * value_1, 6) AS total_value FROM d
 ORDER BY value_0 + 0.5 * value_1, number LIMIT 5""")
def _(spark, sf):
    return rounded(trials.best_trials(trials.objectives(trial_rows(spark, sf)), weight=0.5))


@query("best_trial", TRIALS + "SELECT number, params, value_0, value_1 FROM t ORDER BY value_0 + 0.5 * value_1, number LIMIT 1")
def _(spark, sf):
    t = trials.objectives(trial_rows(spark, sf))
    return ranking.best_row(t, ranking.weighted_score("value_0", "value_1", 0.5), ["number"])


@query("pareto_front", """SELECT p_partkey, p_retailprice, p_size FROM part a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_retailprice <= a.p_retailprice AND b.p_size <= a.p_size
 AND (b.p_retailprice < a.p_retailprice OR b.p_size < a.p_size))""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    return ranking.pareto_front(p, "p_retailprice", "p_size")


@query("promotion_decision", f"""WITH n AS (SELECT o_custkey AS evaluation, CASE WHEN o_custkey % 11 <> 0 THEN {mean('o_totalprice')} END AS new_mae FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
c AS (SELECT o_custkey AS evaluation, {mean('o_totalprice')} AS champion_mae FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
b AS (SELECT * FROM n LEFT JOIN c USING (evaluation))
SELECT evaluation, round(new_mae, 6) AS new_mae, round(champion_mae, 6) AS champion_mae,
 CASE WHEN new_mae IS NULL THEN false WHEN champion_mae IS NULL THEN true ELSE new_mae < champion_mae END AS promoted,
 CASE WHEN new_mae IS NULL THEN 'new metrics missing' WHEN champion_mae IS NULL THEN 'no champion' WHEN new_mae < champion_mae THEN 'new MAE is lower' ELSE 'champion MAE is not higher' END AS promotion_reason FROM b""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    score = mean_of("o_totalprice", DECIMALS)
    by = lambda s: o.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("evaluation"))
    new = by("O").agg(F.when(F.col("evaluation") % 11 != 0, score).alias("avg_mae"))
    return rounded(evaluate.promotion_decision(new, by("F").agg(score.alias("avg_mae"))))



@query("top_parameter_sets", TRIALS + """SELECT * EXCLUDE (rn), rn AS rank FROM (SELECT number, params, split_part(params, '/', 2) AS kind, value_0, value_1,
 CAST(row_number() OVER (PARTITION BY split_part(params, '/', 2) ORDER BY value_0, number) AS INTEGER) AS rn FROM t) WHERE rn <= 5""")
def _(spark, sf):
    t = trials.objectives(trial_rows(spark, sf)).withColumn("kind", F.split_part("params", F.lit("/"), F.lit(2)))
    return ranking.top_per_key(t, ["kind"], ["value_0", "number"], params.TOP_TRIALS)


NODES = DISPLAY + """, n AS (SELECT node, avg(abs(LMP_HOURLY - {0})) AS mae, sqrt(avg((LMP_HOURLY - {0}) * (LMP_HOURLY - {0}))) AS rmse,
 100 * abs(avg(CASE WHEN q90 > LMP_HOURLY AND q10 < LMP_HOURLY THEN 1 ELSE 0 END) - 0.8) AS ci FROM d WHERE q50 IS NOT NULL AND LMP_HOURLY IS NOT NULL GROUP BY node),
champ AS (SELECT node, avg(abs(LMP_HOURLY - {1})) AS mae, sqrt(avg((LMP_HOURLY - {1}) * (LMP_HOURLY - {1}))) AS rmse,
 100 * abs(avg(CASE WHEN q90 > LMP_HOURLY AND q10 < LMP_HOURLY THEN 1 ELSE 0 END) - 0.8) AS ci FROM d WHERE q50 IS NOT NULL AND LMP_HOURLY IS NOT NULL GROUP BY node),
u AS (SELECT n.node, n.mae AS a, n.rmse AS b, n.ci AS e, champ.mae AS f, champ.rmse AS g, champ.ci AS h FROM n JOIN champ USING (node)),
w AS (SELECT * FROM u UNION ALL SELECT NULL, avg(a), avg(b), avg(e), avg(f), avg(g), avg(h) FROM u)
SELECT node, round(a, 6) AS new_mae, round(b, 6) AS new_rmse, round(e, 6) AS new_ci_coverage_error, round(f, 6) AS champion_mae,
 round(g, 6) AS champion_rmse, round(h, 6) AS champion_ci_coverage_error FROM w"""


@query("compare_reports", NODES.replace("{0}", "q50").replace("{1}", "mean_fcast"))
def _(spark, sf):
    """Median against mean forecast in the roles of a new model and the champion."""
    d = display(spark, sf)
    new = evaluate.model_report(d, "node", "LMP_HOURLY")
    champion = evaluate.model_report(d.withColumn("q50", F.col("mean_fcast")), "node", "LMP_HOURLY")
    return rounded(evaluate.compare_reports(new, champion, "node"))
