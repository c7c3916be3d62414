"""Retraining and scoring jobs over stored tables.

A retrain snapshots its input tables, fits the members, scores them and the current
champion on the same test range and promotes the better one. Fitted members are
small parquet tables (a row per series and calendar slot) in the artifact folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.functions.measures import clamp
from hourgrid.operators import series
from hourgrid.operators.training import training_origins
from hourgrid.plans import evaluate, features, forecast, profile, registry
from hourgrid.session import materialize
from hourgrid.sources.tables import read_table, table_path

ID, TIME, TARGET = params.ID, params.TIME, params.TARGET
MODEL = "price"


@dataclass
class RetrainResult:
    artifact_folder: str
    report: DataFrame
    decision: DataFrame
    promoted: bool


LINEAR_STRIDE = 24      # hours between the origins that the linear member learns from


def fit_members(train: DataFrame, folder: str, horizon: int = params.HORIZON, input_chunk: int = params.INPUT_CHUNK) -> None:
    """Fit the hour-of-week profile, the seasonal-naive and the linear member and the quantiles they fall back to, and store them."""
    origins = training_origins(train, input_chunk=input_chunk, horizon=horizon, stride=LINEAR_STRIDE)
    forecast.fit_linear(train, origins, horizon).write(folder)
    forecast.fit_profile(train).write.mode("overwrite").parquet(f"{folder}/profile")
    forecast.fit_seasonal_naive(train).write.mode("overwrite").parquet(f"{folder}/seasonal_naive")
    by_series, pooled = forecast.fit_fallback(train)
    by_series.write.mode("overwrite").parquet(f"{folder}/series_quantiles")
    pooled.write.mode("overwrite").parquet(f"{folder}/pooled_quantiles")


def predict_stored(spark: SparkSession, folder: str, history: DataFrame, targets: DataFrame) -> DataFrame:
    """Ensemble mean of the members stored in an artifact folder, one row for every target.

    A row that no member has a value for takes the quantiles of its series, or of all series; its
    ``n_members`` is 0 and its ``fallback`` flag is set.
    """
    by_week = forecast.predict_profile(spark.read.parquet(f"{folder}/profile"), targets)
    naive = forecast.predict_seasonal_naive(spark.read.parquet(f"{folder}/seasonal_naive"), history, targets)
    members = [by_week, naive]
    if read_table(spark, f"{folder}/linear") is not None:       # artifacts of earlier versions have two members
        horizon = targets.agg(F.max("horizon")).first()[0] or 0
        linear = forecast.predict_linear(forecast.read_linear(spark, folder), history, targets.select(ID, "origin").distinct(), horizon)
        members.append(targets.select(ID, "origin", "horizon", "time").join(linear.drop("time"), [ID, "origin", "horizon"], "left"))
    mean = forecast.ensemble_mean(members)
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    return forecast.with_fallback(mean, read("series_quantiles"), read("pooled_quantiles"))


def score_on_test(spark: SparkSession, folder: str, history: DataFrame, test: DataFrame, horizon: int) -> DataFrame:
    """Forecast of the first ``horizon`` test hours of each series beside the actual values."""
    start = test.groupBy(ID).agg((F.min(TIME) - F.expr("INTERVAL '1' HOUR")).alias("origin"))
    targets = forecast.forecast_targets(start, horizon)
    q = predict_stored(spark, folder, history, targets)
    actual = test.select(ID, F.col(TIME).alias("time"), F.col(TARGET).alias("actual"))
    level = {name: params.QUANTILE_LEVELS.index(value) for name, value in evaluate.REPORT_NAMES.items()}
    return q.join(actual, [ID, "time"]).select(ID, "time", "actual", *[F.col("q")[i].alias(n) for n, i in level.items()])


def retrain(
    spark: SparkSession,
    base: str,
    version: str,
    horizon: int = params.HORIZON,
    input_chunk: int = params.INPUT_CHUNK,
    buffer_hours: int = params.REVISION_BUFFER_HOURS,
    force: bool = False,
    promoted_at: datetime | None = None,
    **price_options,
) -> RetrainResult:
    """Snapshot, fit, evaluate against the champion, fit again with the test hours and promote."""
    tables = [t for t in ("lmp", "mtlf", "mtrf") if read_table(spark, table_path(base, t)) is not None]
    snapshot = registry.snapshot_tables(spark, base, tables, version)
    frames = {t: spark.read.parquet(table_path(snapshot, t)) for t in tables}
    profile.table_profile(frames).write.parquet(f"{snapshot}/data_metrics")

    price = features.prep_price(frames["lmp"], clip=True, **price_options).drop("lmp_diff")
    dense = materialize(series.filled_series(price, [TARGET]), "series")
    parts = series.temporal_split(dense, TIME, input_chunk, buffer_hours)
    folder = f"{base.rstrip('/')}/model_retrains/{version}"
    evaluation = f"{folder}/evaluation"
    fit_members(parts["train"], evaluation, horizon, input_chunk)

    log = f"{base.rstrip('/')}/registry"
    history = series.truncate_history(dense, parts["test"].agg(F.min(TIME)).scalar())
    scored = materialize(score_on_test(spark, evaluation, history, parts["test"], horizon), "scored")
    report = evaluate.model_report(scored)
    report.write.parquet(f"{folder}/report")
    average = report.where(F.col(ID).isNull()).select(F.lit(MODEL).alias("evaluation"), F.col("mae").alias("avg_mae"))
    champion = registry.read_champion(spark, log)
    held = average.limit(0)
    if champion is not None and not force:
        row = champion.first()
        held_folder = f"{row.artifact_folder}/evaluation"
        held_folder = held_folder if read_table(spark, f"{held_folder}/profile") is not None else row.artifact_folder
        rescored = materialize(score_on_test(spark, held_folder, history, parts["test"], horizon), "rescored")
        # Both models forecast every test hour, so the errors are over the same rows.
        if rescored.count() != scored.count():
            raise ValueError("the champion and the new model were scored on different rows")
        held = evaluate.model_report(rescored).where(F.col(ID).isNull() & F.col("mae").isNotNull()).select(
            F.lit(MODEL).alias("evaluation"), F.col("mae").alias("avg_mae")
        )
    decision = materialize(evaluate.promotion_decision(average, held, force=force), "decision")
    verdict = decision.first()
    if verdict is not None and verdict.promoted:
        evaluate.smoke_test(scored)
        # What is promoted has seen the test hours too; the errors above are of the fit without them.
        fit_members(parts["train_test"], folder, horizon, input_chunk)
        overall = report.where(F.col(ID).isNull()).first()
        at = promoted_at or datetime.now()
        registry.promote(spark, log, {
            "model": MODEL, "artifact_folder": folder, "data_snapshot_path": snapshot, "train_timestamp": at,
            "promoted_at": at, "avg_mae": overall.mae, "avg_rmse": overall.rmse,
            "avg_ci_coverage_error": overall.ci_coverage_error,
        })
    return RetrainResult(folder, report, decision, bool(verdict is not None and verdict.promoted))


def score(
    spark: SparkSession,
    base: str,
    price: DataFrame,
    origin: datetime | str | None = None,
    horizon: int = params.HORIZON,
    nodes: list[str] | None = None,
) -> DataFrame:
    """Forecast nodes with the champion, store the result and return it.

    Prices are clamped. All nodes are forecast from one origin: with ``origin``, the first hour to
    forecast, the hour before it (later prices are not used), else the last hour of the newest node, so a node whose feed lags gets the same hours as the others. Every (node,
    hour) asked for comes out. A stored forecast is replaced by one of the same node and origin
    only: the rows of the same origin are read, those of other nodes kept, and the origin's
    partition is swapped. Only the hours that the members look back to are filled.
    """
    champion = registry.read_champion(spark, f"{base.rstrip('/')}/registry")
    if champion is None:
        raise ValueError("no champion has been promoted yet")
    folder = champion.first().artifact_folder
    clean = price.withColumn(TARGET, clamp(TARGET))
    if nodes is not None:
        clean = clean.where(F.col(ID).isin(nodes))
    at = clean.agg(F.max(TIME)).first()[0] if origin is None else datetime.fromisoformat(str(origin)) - timedelta(hours=1)
    if at is None:
        raise ValueError("there is no price to forecast from")
    stamp = F.lit(str(at)).cast("timestamp_ntz")
    back = -(-horizon // forecast.SEASON_HOURS) * forecast.SEASON_HOURS + params.INPUT_CHUNK
    recent = clean.where((F.col(TIME) <= stamp) & (F.col(TIME) > stamp - F.expr(f"INTERVAL '{back}' HOUR")))
    dense = materialize(series.filled_series(recent, [TARGET]), "history")
    asked = clean.select(ID).distinct().withColumn("origin", stamp)
    q = predict_stored(spark, folder, dense, forecast.forecast_targets(asked, horizon))
    fresh = materialize(q.withColumn("origin_hour", F.date_format("origin", "yyyy-MM-dd-HH")), "forecast")
    path = f"{base.rstrip('/')}/forecasts"
    stored = read_table(spark, path)
    merged = fresh
    if stored is not None:
        held = stored.where(F.col("origin_hour") == at.strftime("%Y-%m-%d-%H"))
        other = held.join(fresh.select(ID, "origin").distinct(), [ID, "origin"], "left_anti").select(*fresh.columns)
        merged = materialize(fresh.unionByName(other), "forecasts")
    (
        merged.hint("rebalance", "origin_hour")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("origin_hour").parquet(path)
    )
    return fresh.drop("origin_hour")
