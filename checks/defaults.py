"""Production defaults, the scoring job and the forecasts whose values SQL cannot state."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks.base import DAILY, DECIMALS, IV, LOCAL, lmp, mean, rounded, table, total
from checks.forecasts import PROFILE_SQL, dense_daily, members
from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import mean_of
from hourgrid.operators import series
from hourgrid.operators.training import training_origins
from hourgrid.plans import evaluate, features, forecast, training_job
from hourgrid.session import scratch_path
from hourgrid.sources import feeds

Q: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = (fn, sql)
        return fn
    return register


@query("hourly_price_per_file", f"""WITH {IV} SELECT he AS "GMTIntervalEnd_HE", event_type AS "Settlement_Location_Name", CAST(user_id AS VARCHAR) AS url,
 round({mean('value')}, 6) AS "LMP", count(*) AS n_intervals FROM iv GROUP BY he, event_type, user_id""")
def _(spark, sf):
    """The default method: a mean per file and hour, with the number of its intervals."""
    e = table(spark, sf, "events")
    rows = e.select(
        F.col("ts").alias("Interval"), F.col("ts").alias("GMTIntervalEnd"), tu.fixed_offset("ts").alias("timestamp_mst"),
        F.col("event_type").alias("Settlement_Location_Name"), F.lit("p").alias("PNODE_Name"),
        *[F.col("value").alias(c) for c in ("LMP", "MLC", "MCC", "MEC")],
        F.date_trunc("month", "ts").cast("timestamp_ntz").alias("file_create_time_utc"), F.col("user_id").cast("string").alias("url"),
    )
    out = feeds.hourly_prices(rows, measure="double", decimals=DECIMALS, with_counts=True)
    return rounded(out.select("GMTIntervalEnd_HE", "Settlement_Location_Name", "url", "LMP", "n_intervals"))


CLIPPED = f"""{IV}, s AS (SELECT * FROM iv WHERE regexp_matches(event_type, '^[cvpe]') AND timestamp_mst >= TIMESTAMP '2024-01-02'),
n AS (SELECT count(value) AS n FROM s),
b AS (SELECT (SELECT value FROM s ORDER BY value LIMIT 1 OFFSET (SELECT CAST(floor((n - 1) * 0.0025 + 0.5) AS BIGINT) FROM n)) AS low,
 (SELECT value FROM s ORDER BY value LIMIT 1 OFFSET (SELECT CAST(floor((n - 1) * 0.9975 + 0.5) AS BIGINT) FROM n)) AS high),
price AS (SELECT event_type AS unique_id, timestamp_mst, {mean('CASE WHEN value > high THEN high WHEN value < low THEN low ELSE value END')} AS LMP FROM s, b GROUP BY ALL)"""


@query("prep_price_clipped", f"""WITH {CLIPPED} SELECT unique_id, timestamp_mst, round(LMP, 6) AS "LMP",
 round(LMP - lag(LMP) OVER (PARTITION BY unique_id ORDER BY timestamp_mst), 6) AS lmp_diff FROM price""")
def _(spark, sf):
    return rounded(features.prep_price(lmp(spark, sf), start="2024-01-02 00:00:00", pattern="^[cvpe]", clip=True, **LOCAL))


@query("prep_price_float", f"""WITH {IV} SELECT event_type AS unique_id, timestamp_mst, CAST(CAST({mean('CAST(CAST(value AS FLOAT) AS DOUBLE)')} AS FLOAT) AS DOUBLE) AS "LMP"
 FROM iv WHERE regexp_matches(event_type, '^[cvpe]') GROUP BY ALL""")
def _(spark, sf):
    """32-bit prices, the default measure."""
    out = features.prep_price(lmp(spark, sf), start="2023-01-01 00:00:00", pattern="^[cvpe]", decimals=DECIMALS)
    return out.select("unique_id", "timestamp_mst", F.col("LMP").cast("double").alias("LMP"))


@query("promotion_forced", f"""WITH n AS (SELECT o_custkey AS evaluation, CASE WHEN o_custkey % 11 <> 0 THEN {mean('o_totalprice')} END AS new_mae FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
c AS (SELECT o_custkey AS evaluation, {mean('o_totalprice')} AS champion_mae FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT evaluation, round(new_mae, 6) AS new_mae, round(champion_mae, 6) AS champion_mae, true AS promoted, 'force promoted' AS promotion_reason FROM n LEFT JOIN c USING (evaluation)""")
def _(spark, sf):
    o, score = table(spark, sf, "orders"), mean_of("o_totalprice", DECIMALS)
    by = lambda s: o.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("evaluation"))
    new = by("O").agg(F.when(F.col("evaluation") % 11 != 0, score).alias("avg_mae"))
    return rounded(evaluate.promotion_decision(new, by("F").agg(score.alias("avg_mae")), force=True))


@query("sample_summary", f"""SELECT o_custkey AS node, o_orderstatus AS time, round({total('o_totalprice')} / count(*), 6) AS mean_fcast, round(quantile_cont(o_totalprice, 0.1), 6) AS q10,
 round(quantile_cont(o_totalprice, 0.5), 6) AS q50, round(quantile_cont(o_totalprice, 0.9), 6) AS q90 FROM orders GROUP BY ALL""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("node"), F.col("o_orderstatus").alias("time"), F.col("o_totalprice").alias("value"))
    out = evaluate.sample_summary(o)
    return rounded(out.select("node", "time", "mean_fcast", *[c for c in out.columns if c in ("q10", "q50", "q90")]))


@query("sampled_ensemble", PROFILE_SQL + f"""SELECT unique_id, time, CAST({params.SAMPLES_REQUEST} AS BIGINT) AS n_samples, true AS inside, true AS ordered, true AS centred
 FROM t""")
def _(spark, sf):
    """Ensemble samples: how many there are, and whether they lie inside the quantiles, in order, around the median."""
    m = forecast.ensemble_mean(list(members(spark, sf).values()))
    s = forecast.sample_paths(m.select("unique_id", "time", "q", F.col("q")[0].alias("low"), F.col("q")[20].alias("high"), F.col("q")[7].alias("left"), F.col("q")[13].alias("right")), params.SAMPLES_REQUEST)
    out = s.groupBy("unique_id", "time").agg(
        F.count(F.lit(1)).alias("n_samples"), F.bool_and(F.col("value").between(F.col("low"), F.col("high"))).alias("inside"),
        F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("p"), F.min("left").alias("left"), F.max("right").alias("right"),
    )
    return out.select(
        "unique_id", "time", "n_samples", "inside", ((F.col("p")[0] <= F.col("p")[1]) & (F.col("p")[1] <= F.col("p")[2])).alias("ordered"),
        F.col("p")[1].between(F.col("left"), F.col("right")).alias("centred"),
    )


@query("linear_held_out", f"""WITH {DAILY}, o AS (SELECT unique_id, CAST(max(timestamp_mst) AS TIMESTAMP) - INTERVAL {params.HORIZON} DAY AS origin FROM daily GROUP BY ALL)
SELECT unique_id, origin, CAST(h AS INTEGER) AS horizon, origin + to_days(CAST(h AS INTEGER)) AS time, true AS ordered FROM o, generate_series(1, {params.HORIZON}) g(h)""")
def _(spark, sf):
    """Direct linear model fitted on origins whose outcomes all lie before the forecast origin; every hour asked for comes out."""
    full = dense_daily(spark, sf)
    last = full.groupBy("unique_id").agg((F.max("timestamp_mst") - tu.days(params.HORIZON)).alias("origin"))
    past = series.truncate_history(full.join(last, "unique_id"), "origin").drop("origin")
    fitted = forecast.fit_linear(past, training_origins(past, step_hours=24), params.HORIZON, ["MTLF"], step_hours=24)
    out = forecast.predict_linear(fitted, full, last, params.HORIZON, 24)
    q = F.col("q")
    return out.select(
        "unique_id", F.col("origin").cast("timestamp_ntz").alias("origin"), "horizon", F.col("time").cast("timestamp_ntz").alias("time"),
        ((q[0] <= q[10]) & (q[10] <= q[20])).alias("ordered"),
    )


@query("score_job", f"""WITH {IV}, p AS (SELECT event_type AS unique_id, max(timestamp_mst) AS last FROM iv WHERE regexp_matches(event_type, '^[cvpe]') GROUP BY ALL),
m AS (SELECT CAST(date_trunc('day', max(last)) AS TIMESTAMP) - INTERVAL 2 DAY AS day FROM p),
o AS (SELECT unique_id, day + INTERVAL 4 HOUR AS origin FROM p, m UNION ALL SELECT unique_id, day + INTERVAL 5 HOUR FROM p, m)
SELECT unique_id, origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS time, true AS complete FROM o, generate_series(1, 48) g(h)""")
def _(spark, sf):
    """Fit and promote, score two origins of one date and again a single node; all stored rows read back."""
    base = scratch_path(spark, "score-job")
    price = lmp(spark, sf)
    price.withColumn("PNODE_Name", F.col("Settlement_Location_Name")).write.parquet(f"{base}/lmp")
    options = {"start": "2023-01-01 00:00:00", "pattern": "^[cvpe]"}
    training_job.retrain(spark, base, "v1", horizon=48, input_chunk=72, buffer_hours=24, promoted_at=datetime(2024, 3, 1), **options)
    clean = features.prep_price(spark.read.parquet(f"{base}/lmp"), **options)
    day = clean.agg(F.date_trunc("day", F.max("timestamp_mst"))).first()[0] - timedelta(days=2)
    for hour in (5, 6):
        training_job.score(spark, base, clean, day + timedelta(hours=hour), horizon=48)
    training_job.score(spark, base, clean, day + timedelta(hours=6), horizon=48, nodes=["view"])
    stored = spark.read.parquet(f"{base}/forecasts")
    return stored.select("unique_id", "origin", "horizon", "time", (F.size("q") == len(params.QUANTILE_LEVELS)).alias("complete"))
