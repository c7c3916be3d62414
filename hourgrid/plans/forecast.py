"""Probabilistic multi-horizon forecasts for all series at once.

Contract of a member: history in, rows (unique_id, origin, time, horizon, q) out,
where ``q`` holds one value per quantile level. Every target row comes out of every
member; where a member has no value, its ``q`` is null. Members are fitted by aggregation
or by a distributed regression; none walks over series one by one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.operators import leastsquares
from hourgrid.operators.quantile import exact_quantiles, small_group_quantiles
from hourgrid.session import materialize

ID, TIME, TARGET = params.ID, params.TIME, params.TARGET
SEASON_HOURS = 168
POOLED_ROWS = 50.0      # rows' worth of all horizons that each horizon's regression gets

# Artifact names that mark an ensemble member, and the member kind.
MEMBER_PATTERNS = {"tsmixer": "mixer", "tide_": "dense", "tft": "attention"}


def forecast_targets(origins: DataFrame, horizon: int = params.HORIZON, step_hours: int = 1) -> DataFrame:
    """Rows (.., origin, horizon, time) for every step after each origin."""
    steps = origins.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("time", F.col("origin") + tu.hours(F.col("horizon") * step_hours))


# --- hour-of-week profile ------------------------------------------------------

def fit_profile(
    history: DataFrame, levels: Sequence[float] = tuple(params.QUANTILE_LEVELS), ids: Sequence[str] = (ID,),
    time: str = TIME, value: str = TARGET, by_hour: bool = True,
) -> DataFrame:
    """Quantiles of the value per series, weekday and hour.

    A group has one row per week of history, so its quantiles are taken in place.
    """
    keys = {"weekday": tu.day_of_week(time)} | ({"hour": tu.hour_of_day(time)} if by_hour else {})
    return (
        history.where(F.col(value).isNotNull())
        .groupBy(*ids, *[c.alias(n) for n, c in keys.items()])
        .agg(small_group_quantiles(value, levels).alias("q"))
    )


def predict_profile(profile: DataFrame, targets: DataFrame, ids: Sequence[str] = (ID,), time: str = "time") -> DataFrame:
    keys = ["weekday"] + (["hour"] if "hour" in profile.columns else [])
    keyed = targets.withColumn("weekday", tu.day_of_week(time))
    if "hour" in keys:
        keyed = keyed.withColumn("hour", tu.hour_of_day(time))
    return keyed.join(profile, [*ids, *keys], "left").drop(*keys)


def fit_fallback(
    history: DataFrame, levels: Sequence[float] = tuple(params.QUANTILE_LEVELS), ids: Sequence[str] = (ID,), value: str = TARGET,
) -> tuple[DataFrame, DataFrame]:
    """Quantiles per series (its hours are bounded) and one row of pooled quantiles over all series."""
    known = history.where(F.col(value).isNotNull())
    by_series = known.groupBy(*ids).agg(small_group_quantiles(value, levels).alias("q"))
    rows = exact_quantiles(known, [], value, levels)
    pooled = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("level", "quantile"))), lambda r: r["quantile"]).alias("q"))
    return by_series, pooled


def with_fallback(
    member: DataFrame, by_series: DataFrame, pooled: DataFrame, ids: Sequence[str] = (ID,), n_levels: int = len(params.QUANTILE_LEVELS),
) -> DataFrame:
    """Fill rows without a value: from the quantiles of the series, else from the pooled ones.

    ``n_members`` and the ``fallback`` flag tell which rows were filled.
    """
    own = by_series.select(*ids, F.col("q").alias("_own"))
    everywhere = pooled.where(F.size("q") == n_levels).select("q").scalar()
    return (
        member.join(own, list(ids), "left")
        .withColumn("fallback", F.col("q").isNull())
        .withColumn("q", F.coalesce("q", "_own", everywhere))
        .drop("_own")
    )


# --- seasonal naive ------------------------------------------------------------

def season_residuals(
    history: DataFrame, season_hours: int = SEASON_HOURS, ids: Sequence[str] = (ID,), time: str = TIME, value: str = TARGET
) -> DataFrame:
    """Value minus the value one season earlier, joined by time so that gaps do not shift it."""
    now = history.select(*ids, F.col(time), F.col(value).cast("double").alias("_y"))
    past = history.select(*ids, (F.col(time) + tu.hours(season_hours)).alias(time), F.col(value).cast("double").alias("_s"))
    return now.join(past, [*ids, time]).select(*ids, time, (F.col("_y") - F.col("_s")).alias("residual"))


def fit_seasonal_naive(
    history: DataFrame, levels: Sequence[float] = tuple(params.QUANTILE_LEVELS), season_hours: int = SEASON_HOURS,
    ids: Sequence[str] = (ID,), time: str = TIME, value: str = TARGET,
) -> DataFrame:
    """Residual quantiles per series; a series has one residual per hour of history."""
    residuals = season_residuals(history, season_hours, ids, time, value)
    return residuals.where(F.col("residual").isNotNull()).groupBy(*ids).agg(
        small_group_quantiles("residual", levels).alias("residual_q")
    )


def predict_seasonal_naive(
    fitted: DataFrame, history: DataFrame, targets: DataFrame, season_hours: int = SEASON_HOURS,
    ids: Sequence[str] = (ID,), time: str = TIME, value: str = TARGET, step_hours: int = 1,
) -> DataFrame:
    """Value of the last known season plus residual quantiles."""
    seasons = F.ceil(F.col("horizon") * step_hours / season_hours).cast("int")
    keyed = targets.withColumn("_at", F.col("time") - tu.hours(seasons * season_hours))
    known = history.select(*ids, F.col(time).alias("_at"), F.col(value).cast("double").alias("_base"))
    shifted = F.transform("residual_q", lambda r: r + F.col("_base"))
    return (
        keyed.join(known, [*ids, "_at"], "left")
        .join(fitted, list(ids), "left")
        .withColumn("q", F.when(F.col("_base").isNotNull(), shifted))
        .drop("_at", "_base", "residual_q")
    )


# --- direct linear model -------------------------------------------------------

@dataclass
class LinearMember:
    """A direct linear model, one regression a horizon for all series: two small tables that can be stored."""

    coefficients: DataFrame         # (horizon, coefficients, covariates, season_steps)
    residuals: DataFrame            # (horizon, residual_q)
    covariates: tuple[str, ...]
    season_steps: int

    def write(self, folder: str) -> None:
        self.coefficients.write.mode("overwrite").parquet(f"{folder}/linear")
        self.residuals.write.mode("overwrite").parquet(f"{folder}/linear_residuals")


def read_linear(spark: SparkSession, folder: str) -> LinearMember:
    """The stored member; of an empty one no row is known, and its forecasts are null."""
    coefficients = spark.read.parquet(f"{folder}/linear")
    first = coefficients.select("covariates", "season_steps").first()
    covariates, season = (tuple(first.covariates), first.season_steps) if first is not None else ((), SEASON_HOURS)
    return LinearMember(coefficients, spark.read.parquet(f"{folder}/linear_residuals"), covariates, season)


def _linear_rows(
    dense: DataFrame, origins: DataFrame, horizon: int, covariates: Sequence[str], season_steps: int, step_hours: int,
) -> DataFrame:
    """Feature rows (unique_id, origin, time, horizon, features..., y)."""
    order = Window.partitionBy(ID).orderBy(TIME)
    # Means over the last rows from running sums: one addition per row instead of a frame.
    running = dense.select(
        ID, F.col(TIME), F.col(TARGET).cast("double").alias("f_last"),
        F.sum(F.col(TARGET).cast("double")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum"),
        F.row_number().over(order).alias("_n"),
    )
    mean = lambda k: (
        F.col("_sum") - F.coalesce(F.lag("_sum", k).over(order), F.lit(0.0))
    ) / F.least(F.col("_n"), F.lit(k))
    at_origin = running.select(
        ID, F.col(TIME).alias("origin"), "f_last", mean(24).alias("f_mean_24"), mean(params.INPUT_CHUNK).alias("f_mean_168")
    )
    steps = forecast_targets(origins.select(ID, "origin"), horizon, step_hours)
    season = dense.select(
        ID, (F.col(TIME) + tu.hours(season_steps * step_hours)).alias("time"), F.col(TARGET).cast("double").alias("f_season")
    )
    now = dense.select(
        ID, F.col(TIME).alias("time"), F.col(TARGET).cast("double").alias("y"),
        *[F.col(c).cast("double").alias(f"f_{c}") for c in covariates],
    )
    rows = steps.join(at_origin, [ID, "origin"], "left").join(season, [ID, "time"], "left").join(now, [ID, "time"], "left")
    hour = 2 * math.pi * tu.hour_of_day("time") / 24
    return rows.withColumns({
        **{f"f_{c}": F.coalesce(f"f_{c}", F.lit(0.0)) for c in covariates},
        **{f"f_{c}_missing": F.col(f"f_{c}").isNull().cast("double") for c in covariates},
        "f_month": tu.month_of("time").cast("double"),
        "f_weekday": tu.day_of_week("time").cast("double"),
        "f_hour_sin": F.sin(hour), "f_hour_cos": F.cos(hour),
    })


def linear_features(covariates: Sequence[str]) -> list[str]:
    """A missing covariate counts 0 and sets its flag, so no row is dropped for it."""
    both = [name for c in covariates for name in (f"f_{c}", f"f_{c}_missing")]
    return ["f_last", "f_mean_24", "f_mean_168", "f_season", *both, "f_month", "f_weekday", "f_hour_sin", "f_hour_cos"]


def linear_training_rows(
    dense: DataFrame, origins: DataFrame, horizon: int = params.HORIZON, covariates: Sequence[str] = (), season_steps: int = SEASON_HOURS, step_hours: int = 1,
) -> DataFrame:
    """Feature rows of every (series, origin, horizon) with a known outcome."""
    rows = _linear_rows(dense, origins, horizon, covariates, season_steps, step_hours)
    return rows.where(F.col("y").isNotNull() & F.col("f_last").isNotNull() & F.col("f_season").isNotNull())


def fit_linear(
    dense: DataFrame, origins: DataFrame, horizon: int = params.HORIZON, covariates: Sequence[str] = (),
    levels: Sequence[float] = tuple(params.QUANTILE_LEVELS), season_steps: int = SEASON_HOURS, step_hours: int = 1,
    regularization: float = 0.01, pooled_rows: float = POOLED_ROWS,
) -> LinearMember:
    """Fit a regression a horizon on every (series, origin, horizon) with a known outcome.

    The sums of products by horizon are one aggregation of the rows (see ``leastsquares``). Residual quantiles are taken per
    horizon over all series, a pool that grows with the data, so the exact distributed quantile is used.
    """
    names = linear_features(covariates)
    rows = materialize(linear_training_rows(dense, origins, horizon, covariates, season_steps, step_hours), "linear-rows")
    fitted = leastsquares.fit(leastsquares.moments(rows, names, "y", ["horizon"]), "horizon", (regularization,), pooled_rows)
    listed = F.array(*[F.lit(c) for c in covariates]).cast("array<string>")
    coefficients = materialize(fitted.select("horizon", "coefficients", listed.alias("covariates"), F.lit(season_steps).alias("season_steps")), "linear")
    errors = rows.join(coefficients.select("horizon", "coefficients"), "horizon").select(
        "horizon", (F.col("y") - leastsquares.predicted("coefficients", names)).alias("residual")
    )
    residuals = exact_quantiles(errors, ["horizon"], "residual", levels).groupBy("horizon").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("level", "quantile"))), lambda r: r["quantile"]
        ).alias("residual_q")
    )
    return LinearMember(coefficients, residuals, tuple(covariates), season_steps)


def predict_linear(
    member: LinearMember, dense: DataFrame, origins: DataFrame, horizon: int = params.HORIZON, step_hours: int = 1
) -> DataFrame:
    """Every (series, origin, horizon); null where the last or the seasonal value is unknown, or the horizon was not fitted."""
    rows = _linear_rows(dense, origins, horizon, member.covariates, member.season_steps, step_hours)
    scored = rows.join(member.coefficients.select("horizon", "coefficients"), "horizon", "left").join(member.residuals, "horizon", "left")
    point = leastsquares.predicted("coefficients", linear_features(member.covariates))
    return scored.withColumn("_point", point).select(
        ID, "origin", "horizon", "time", F.when(F.col("_point").isNotNull(), F.transform("residual_q", lambda r: r + F.col("_point"))).alias("q")
    )


# --- ensemble and samples ------------------------------------------------------

def ensemble_mean(
    members: Sequence[DataFrame], n_levels: int = len(params.QUANTILE_LEVELS),
    keys: Sequence[str] = (ID, "origin", "horizon", "time"),
) -> DataFrame:
    """Plain average of the members per quantile level; one aggregation, nothing exploded.

    Members without a value are left out of a row's average; ``n_members`` says how many were in it. A
    row that no member has a value for stays, with a null ``q``.
    """
    stacked = reduce(lambda a, b: a.unionByName(b), [m.select(*keys, "q") for m in members])
    means = F.array(*[F.avg(F.col("q")[i]) for i in range(n_levels)])
    found = stacked.groupBy(*keys).agg(F.count("q").cast("int").alias("n_members"), means.alias("q"))
    return found.withColumn("q", F.when(F.col("n_members") > 0, F.col("q")))


def _uniform(seed: int, *keys: str | Column) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only, never on partitioning."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def sample_paths(
    forecast: DataFrame, n_samples: int = params.SAMPLES_REQUEST, levels: Sequence[float] = tuple(params.QUANTILE_LEVELS),
    seed: int = 0, ids: Sequence[str] = (ID,), time: str = "time",
) -> DataFrame:
    """Rows (..., sample_id, value) drawn from the quantile function of each forecast hour.

    The quantile function is piecewise linear through (level, q) and flat outside the
    levels.
    """
    drawn = forecast.withColumn("sample_id", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    drawn = drawn.withColumn("_u", _uniform(seed, *ids, F.col(time).cast("string"), "sample_id"))
    passed = reduce(lambda a, b: a + b, [(F.col("_u") >= float(v)).cast("int") for v in levels])
    drawn = drawn.withColumn("_i", F.least(F.greatest(passed, F.lit(1)), F.lit(len(levels) - 1)))
    grid = F.array(*[F.lit(float(v)) for v in levels])
    at = lambda values, i: F.element_at(values, i)
    i, low = F.col("_i"), at(F.col("q"), F.col("_i"))
    share = (F.col("_u") - at(grid, i)) / (at(grid, i + 1) - at(grid, i))
    share = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    return drawn.withColumn("value", low + (at(F.col("q"), i + 1) - low) * share).drop("q", "_u", "_i")


def unpivot_samples(wide: DataFrame, keys: Sequence[str], samples: str = "samples") -> DataFrame:
    """Array of samples to rows (keys, sample_id, value)."""
    return wide.select(*keys, F.posexplode(samples).alias("sample_id", "value"))


def discover_members(artifacts: DataFrame, name: str = "artifact") -> DataFrame:
    """Artifacts that are ensemble members, with their kind; companions and other files are left out."""
    n = F.col(name)
    kind = F.coalesce(*[F.when(n.contains(p), F.lit(k)) for p, k in MEMBER_PATTERNS.items()])
    model_file = n.contains(".pt") & ~n.contains(".ckpt") & ~n.contains("TRAIN_TIMESTAMP.pkl")
    return artifacts.withColumn("member_kind", kind).where(model_file & F.col("member_kind").isNotNull())


def predict_members(
    history: DataFrame, targets: DataFrame, levels: Sequence[float] = tuple(params.QUANTILE_LEVELS),
    season_hours: int = SEASON_HOURS, fit_on: DataFrame | None = None, step_hours: int = 1, by_hour: bool = True,
) -> dict[str, DataFrame]:
    """Profile and seasonal-naive forecasts of all targets. Fits on ``fit_on`` or the history."""
    train = fit_on if fit_on is not None else history
    profile = fit_profile(train, levels, by_hour=by_hour)
    naive = fit_seasonal_naive(train, levels, season_hours)
    return {
        "profile": predict_profile(profile, targets),
        "seasonal_naive": predict_seasonal_naive(naive, history, targets, season_hours, step_hours=step_hours),
    }
