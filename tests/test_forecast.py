from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.operators.training import training_origins
from hourgrid.plans import evaluate, forecast, report, trials

T0 = datetime(2024, 1, 1)


def weekly(spark, weeks=6, nodes=("a", "b")):
    """A price with a weekly shape, a trend per week and some noise."""
    rng = np.random.default_rng(0)
    rows = [
        (n, T0 + timedelta(hours=i), float(20 + 5 * k + 10 * np.sin(i % 168 / 168 * 6.283) + i / 168 + rng.normal()), float(i % 24))
        for k, n in enumerate(nodes) for i in range(weeks * 168)
    ]
    return spark.createDataFrame(rows, "unique_id string, timestamp_mst timestamp_ntz, LMP double, MTLF double")


def last_origin(df, hours=120):
    return df.groupBy("unique_id").agg((F.max("timestamp_mst") - tu.hours(hours)).alias("origin"))


def test_quantile_levels():
    assert len(params.QUANTILE_LEVELS) == 21 and params.QUANTILE_LEVELS[0] == 0.01 and params.QUANTILE_LEVELS[-1] == 0.99
    assert {0.1, 0.5, 0.9} <= set(params.QUANTILE_LEVELS)


@pytest.fixture(scope="module")
def members(spark):
    df = weekly(spark)
    origins = last_origin(df)
    history = df.join(origins, "unique_id").where("timestamp_mst < origin").drop("origin")
    targets = forecast.forecast_targets(origins, 120)
    out = forecast.predict_members(history, targets)
    return {n: m.cache() for n, m in out.items()}


def test_members_cover_every_node_and_hour_with_ordered_quantiles(members):
    for member in members.values():
        assert member.count() == 240
        falling = F.exists(F.sequence(F.lit(1), F.lit(20)), lambda i: F.get("q", i) < F.get("q", i - 1))
        assert member.where(falling | (F.size("q") != 21)).count() == 0


def test_seasonal_naive_repeats_last_week(spark):
    df = weekly(spark, 4, ("a",))
    origins = last_origin(df, 0)
    targets = forecast.forecast_targets(origins, 200)
    fitted = forecast.fit_seasonal_naive(df, [0.5])
    out = forecast.predict_seasonal_naive(fitted, df, targets).orderBy("horizon").collect()
    assert len(out) == 200
    known = {r.timestamp_mst: r.LMP for r in df.collect()}
    shift = fitted.first().residual_q[0]
    for r in out:
        back = 168 if r.horizon <= 168 else 336
        assert r.q[0] == pytest.approx(known[r.time - timedelta(hours=back)] + shift)


def test_ensemble_is_the_plain_average(members):
    both = forecast.ensemble_mean(list(members.values()))
    pair = members["profile"].select("unique_id", "time", F.col("q").alias("p")).join(
        members["seasonal_naive"].select("unique_id", "time", F.col("q").alias("s")), ["unique_id", "time"])
    gap = both.join(pair, ["unique_id", "time"]).select(F.max(F.abs(F.col("q")[7] - (F.col("p")[7] + F.col("s")[7]) / 2)))
    assert both.count() == 240 and gap.first()[0] < 1e-9


def test_samples_do_not_depend_on_partitioning(members):
    one = forecast.sample_paths(members["profile"].coalesce(1), 50, seed=3)
    many = forecast.sample_paths(members["profile"].repartition(13), 50, seed=3)
    total = lambda d: sorted((r.unique_id, r.time, r.sample_id, r.value) for r in d.collect())
    a = total(one)
    assert a == total(many) and len(a) == 240 * 50
    assert a != total(forecast.sample_paths(members["profile"], 50, seed=4))


def test_samples_follow_the_quantile_function(spark):
    grid = spark.createDataFrame([("a", T0, [float(v) for v in params.QUANTILE_LEVELS])], "unique_id string, time timestamp_ntz, q array<double>")
    values = np.array([r.value for r in forecast.sample_paths(grid, 20000).collect()])
    for level in (0.05, 0.25, 0.5, 0.9):
        assert abs(np.quantile(values, level) - level) < 0.015
    assert values.min() >= 0.01 and values.max() <= 0.99


def test_linear_member_beats_the_mean(spark):
    df = weekly(spark, 8)
    origins = training_origins(df, horizon=24, stride=25)
    fitted = forecast.fit_linear(df, origins, 24, ["MTLF"], [0.1, 0.5, 0.9])
    out = forecast.predict_linear(fitted, df, last_origin(df, 24), 24)
    joined = out.join(df.withColumnRenamed("timestamp_mst", "time"), ["unique_id", "time"])
    row = joined.agg(evaluate.mae("LMP", F.col("q")[1]).alias("m"), F.count("*").alias("n"), F.stddev("LMP").alias("s")).first()
    assert row.n == 48 and row.m < row.s / 2


def test_member_discovery(spark):
    names = ["tide_0.pt", "tft_0.pt", "tide_0.pt.ckpt", "TRAIN_TIMESTAMP.pkl", "other.pt", "my_tsmixer_3.pt"]
    found = forecast.discover_members(spark.createDataFrame([(n,) for n in names], "artifact string"))
    assert {r.artifact: r.member_kind for r in found.collect()} == {"tide_0.pt": "dense", "tft_0.pt": "attention", "my_tsmixer_3.pt": "mixer"}
    assert forecast.discover_members(spark.createDataFrame([], "artifact string")).count() == 0


def test_boundary_counts_differ_between_report_and_metric(spark):
    df = spark.createDataFrame([(10.0, 10.0, 20.0)], "a double, lo double, hi double")
    row = df.agg(evaluate.report_coverage("a", "lo", "hi").alias("r"), evaluate.coverage_error("a", "lo", "hi").alias("e")).first()
    assert row.r == 1.0 and row.e == pytest.approx(80.0)


def test_coverage_error_is_zero_at_eighty_percent(spark):
    df = spark.createDataFrame([(float(i < 8) * 5, 1.0, 9.0) for i in range(10)], "a double, lo double, hi double")
    assert df.agg(evaluate.coverage_error("a", "lo", "hi")).first()[0] == pytest.approx(0.0)


def test_sample_summary(spark):
    df = spark.createDataFrame([("n", T0, float(v)) for v in range(10)], "node string, time timestamp_ntz, value double")
    row = evaluate.sample_summary(df).first()
    assert (row.mean_fcast, row.q10, row.q50, row.q90) == pytest.approx((4.5, 0.9, 4.5, 8.1))


def display_rows(spark):
    rows = [("n", T0 + timedelta(hours=i), 10.0 + i, *( (11.0 + i, 8.0, 11.0, 30.0) if i >= 60 else (None,) * 4), 1.0, 2.0, 3.0, 0.125, 4.0) for i in range(100)]
    return spark.createDataFrame(rows, "node string, time timestamp_ntz, LMP_HOURLY double, mean_fcast double, q10 double, q50 double, q90 double, MTLF double, Wind_Forecast_MW double, Solar_Forecast_MW double, Ratio double, load_net_re double")


def test_display_window_and_table(spark):
    df = display_rows(spark)
    sizes = [report.display_window(df, h).count() for h in (24, 48, 168)]
    assert sizes == [24 + 40, 48 + 40, 100]
    shown = report.display_table(df)
    assert shown.columns == report.TABLE_COLUMNS and shown.first().Ratio == 0.12


def test_report_metrics_and_dash_without_overlap(spark):
    df = display_rows(spark)
    row = evaluate.report_metrics(df).first()
    assert (row.mae, row.bias, row.n_hours) == ("1.0", "1.0", 40) and row.ci_coverage == 0.0
    none = evaluate.report_metrics(df.where("mean_fcast IS NULL")).first()
    assert (none.mae, none.bias, none.n_hours) == ("-", "-", 0)


def test_display_frame_keeps_covariate_hours(spark):
    key = lambda *rows: spark.createDataFrame(list(rows), "node string, time int")
    summary = key(("n", 2)).selectExpr("*", "1.0 mean_fcast", "1.0 q10", "1.0 q50", "1.0 q90")
    prices = key(("n", 1), ("n", 9)).selectExpr("*", "5.0 LMP_HOURLY")
    out = report.display_frame(summary, key(("n", 1), ("n", 2)).selectExpr("*", "7.0 MTLF"), prices).orderBy("time").collect()
    assert [(r.time, r.mean_fcast, r.LMP_HOURLY) for r in out] == [(1, None, 5), (2, 1, None)]


def test_selectors(spark):
    rows = [("a", datetime(2024, 1, 1, 5)), ("a", datetime(2024, 3, 31, 3)), ("b", datetime(2024, 3, 30, 23))]
    df = spark.createDataFrame(rows, "unique_id string, timestamp_mst timestamp_ntz")
    hours = report.available_hours(df).groupBy("date").count().orderBy("date").collect()
    assert [r["count"] for r in hours] == [24, 24, 4]
    only = report.available_hours(df.where("unique_id = 'b'").selectExpr("unique_id", "TIMESTAMP_NTZ'2024-03-30 00:00:00' AS timestamp_mst"))
    assert [r.hour for r in only.collect()] == ["00"]
    bounds = {r.unique_id: (str(r.min_date), str(r.max_date)) for r in report.date_bounds(df).collect()}
    assert bounds == {"a": ("2024-01-31", "2024-03-31"), "b": ("2024-03-30", "2024-03-30")}
    assert [r.unique_id for r in report.price_nodes(df).collect()] == ["a", "b"]


def test_backtest_origins_match_brute_force(spark):
    df = weekly(spark, 2, ("a",)).limit(100)
    out = evaluate.backtest_targets(df, horizon=10, stride=7, input_chunk=20)
    got = {(r.origin, r.time, r.horizon) for r in out.collect()}
    want = {(T0 + timedelta(hours=o), T0 + timedelta(hours=o + h), h) for o in range(19, 90, 7) for h in range(1, 11)}
    assert got == want


def test_backtest_and_report(spark):
    df = weekly(spark, 6)
    at = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    per = evaluate.backtest(df.where(F.col("timestamp_mst") < at), df.where(F.col("timestamp_mst") >= at), horizon=24, input_chunk=48)
    rows = per.collect()
    assert len(rows) == 2 * 11 and all(r.n_hours == 24 for r in rows)
    assert all(r.mae < 6 for r in rows) and evaluate.backtest_summary(per).first().n_origins == 11


def test_model_report_averages_nodes_equally(spark):
    rows = [("a", 1.0, 0.0, 2.0, 5.0)] * 3 + [("b", 5.0, 0.0, 1.0, 9.0)]
    df = spark.createDataFrame(rows, "unique_id string, actual double, q10 double, q50 double, q90 double")
    out = {r.unique_id: r for r in evaluate.model_report(df).collect()}
    assert out[None].mae == (1 + 4) / 2 and out["a"].rmse == 1.0 and out[None].n_hours == 4


@pytest.mark.parametrize("new,champion,force,promoted", [
    (12.3, 14.1, False, True), (14.1, 12.3, False, False), (12.3, 12.3, False, False),
    (12.3, None, False, True), (None, 12.3, False, False), (None, None, False, False), (99.0, 1.0, True, True),
])
def test_promotion(spark, new, champion, force, promoted):
    schema = "evaluation string, avg_mae double"
    held = spark.createDataFrame([] if champion is None else [("e", champion)], schema)
    row = evaluate.promotion_decision(spark.createDataFrame([("e", new)], schema), held, force=force).first()
    assert row.promoted is promoted


def test_smoke_test(spark):
    evaluate.smoke_test(spark.range(1))
    with pytest.raises(ValueError):
        evaluate.smoke_test(spark.range(0))


def test_trials(spark, tmp_path):
    rows = [(1, "p", 10.0, 4.0), (2, "p", 1.0, 1.0), (3, "q", 8.0, 8.0), (4, "r", None, 1.0)]
    t = trials.objectives(spark.createDataFrame(rows, "number int, params string, value_0 double, value_1 double"))
    best = trials.best_trials(t, n=2, weight=0.5).collect()
    assert [(r.number, r.total_value) for r in best] == [(1, 12.0), (3, 12.0)]
    trials.append_trials(t, str(tmp_path / "t"))
    trials.append_trials(t, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8
    grid = trials.parameter_grid(spark, season=[24, 168], width=[1, 2, 3])
    assert grid.count() == 6 and grid.select("params").distinct().count() == 6


def test_search_prefers_the_true_season(spark):
    df = weekly(spark, 6)
    at = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    out = trials.score_seasons(df.where(F.col("timestamp_mst") < at), df.where(F.col("timestamp_mst") >= at), [61, 168])
    assert out.orderBy("value_0").first().season_hours == 168


def brute_trial(rows, at, season, window):
    """(MAE, coverage error) of a trial from dictionaries, means over series."""
    maes, errors = [], []
    end = max(t for _, t, _ in rows if t < at)
    for node in sorted({r[0] for r in rows}):
        y = {t: v for n, t, v in rows if n == node}
        back = timedelta(hours=season)
        fit = [y[t] - y[t - back] for t in y if t < at and t - back in y and (window is None or t > end - timedelta(hours=window))]
        asked = [t for t in y if t >= at and t - back in y]
        if fit and asked:
            low, mid, high = np.quantile(fit, params.REPORT_QUANTILES)
            maes.append(np.mean([abs(y[t] - y[t - back] - mid) for t in asked]))
            inside = [y[t - back] + low < y[t] < y[t - back] + high for t in asked]
            errors.append(100 * abs(np.mean(inside) - params.TARGET_COVERAGE))
    return (np.mean(maes), np.mean(errors)) if maes else (None, None)


def test_trials_are_rows_and_equal_brute_force(spark):
    df = weekly(spark, 3).where("NOT (unique_id = 'a' AND hour(timestamp_mst) = 5)")
    at = datetime(2024, 1, 16)
    train, test = df.where(F.col("timestamp_mst") < F.lit(at).cast("timestamp_ntz")), df.where(F.col("timestamp_mst") >= F.lit(at).cast("timestamp_ntz"))
    grid = trials.parameter_grid(spark, season_hours=[24, 61, 9000], window_hours=[30, 200, None])
    scored = trials.score_trials(train.unionByName(train), test, grid)      # repeated rows count once
    rows = [(r.unique_id, r.timestamp_mst, r.LMP) for r in df.collect()]
    out = scored.collect()
    assert len(out) == 9
    for r in out:
        want = brute_trial(rows, at, r.season_hours, r.window_hours)
        assert [r.value_0, r.value_1] == ([None, None] if want[0] is None else pytest.approx(want))
    assert trials.score_trials(train.limit(0), test, grid).where("value_0 IS NULL").count() == 9
    assert trials.score_trials(train, test, grid.limit(0)).count() == 0


def test_plan_does_not_grow_with_trials(spark):
    df = weekly(spark, 1)
    size = lambda g: trials.score_trials(df, df, g)._jdf.queryExecution().optimizedPlan().toString().count("Join")
    few = trials.parameter_grid(spark, season_hours=[24])
    many = trials.parameter_grid(spark, season_hours=list(range(1, 40)), window_hours=[24, 48])
    assert size(few) == size(many)


def test_search_resumes(spark, tmp_path):
    df = weekly(spark, 3)
    at = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    train, test = df.where(F.col("timestamp_mst") < at), df.where(F.col("timestamp_mst") >= at)
    path = str(tmp_path / "trials")
    grid = trials.parameter_grid(spark, season_hours=[24, 168, 9000])
    assert trials.search(train, test, grid.where("season_hours = 24"), path).count() == 1
    out = {r.season_hours: r.value_0 for r in trials.search(train, test, grid, path).collect()}
    assert set(out) == {24, 168, 9000} and out[168] < out[24] and out[9000] == float("inf")
    trials.search(train, test, grid, path)
    assert spark.read.parquet(path).count() == 3


def test_every_target_row_comes_out(spark):
    """Little history, unknown series, missing covariates: rows stay, without a value at worst."""
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0 + timedelta(hours=i), float(i % 24), float(i) if i % 3 else None) for i in range(72)]
    history = spark.createDataFrame(rows, "unique_id string, timestamp_mst timestamp_ntz, LMP double, wind double")
    origins = spark.createDataFrame([("a", t0 + timedelta(hours=71)), ("new", t0 + timedelta(hours=71))], "unique_id string, origin timestamp_ntz")
    targets = forecast.forecast_targets(origins, 120)
    members = forecast.predict_members(history, targets)
    assert {m.count() for m in members.values()} == {240}
    mean = forecast.ensemble_mean(list(members.values()))
    assert mean.count() == 240 and mean.where("n_members = 0 AND q IS NOT NULL").count() == 0
    filled = forecast.with_fallback(mean, *forecast.fit_fallback(history))
    assert filled.count() == 240 and filled.where("q IS NULL").count() == 0
    assert {r.fallback for r in filled.where("unique_id = 'new'").collect()} == {True}

    fit_on = spark.createDataFrame([("a", t0 + timedelta(hours=30))], "unique_id string, origin timestamp_ntz")
    member = forecast.fit_linear(history, fit_on, 12, ["wind"], season_steps=24)
    out = forecast.predict_linear(member, history, origins, 24)
    assert out.count() == 48 and out.where("unique_id = 'a' AND horizon <= 12 AND q IS NULL").count() == 0
