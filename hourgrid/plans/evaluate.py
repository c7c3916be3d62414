"""Accuracy and coverage of probabilistic forecasts, backtests, reports, promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid import params
from hourgrid.functions.measures import display_round
from hourgrid.operators.quantile import quantile_columns, small_group_quantiles
from hourgrid.operators.training import with_step_index
from hourgrid.plans.forecast import SEASON_HOURS, ensemble_mean, predict_members

ID, TIME, TARGET = params.ID, params.TIME, params.TARGET
REPORT_NAMES = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


def sample_summary(samples: DataFrame, keys: Sequence[str] = ("node", "time"), value: str = "value") -> DataFrame:
    """Mean and report quantiles of the samples of each forecast hour, in one aggregation.

    A forecast hour has a fixed number of samples.
    """
    q = small_group_quantiles(value, params.REPORT_QUANTILES)
    out = samples.groupBy(*keys).agg(F.avg(value).alias("mean_fcast"), q.alias("_q"))
    return out.select(*keys, "mean_fcast", *[F.col("_q")[i].alias(n) for i, n in enumerate(REPORT_NAMES)])


def pooled_quantiles(samples: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Report quantiles of groups of any size."""
    return quantile_columns(samples, list(keys), value, REPORT_NAMES)


def mae(actual: str | Column, forecast: str | Column) -> Column:
    return F.avg(F.abs(_c(actual) - _c(forecast)))


def bias(actual: str | Column, forecast: str | Column) -> Column:
    """Mean of forecast minus actual."""
    return F.avg(_c(forecast) - _c(actual))


def rmse(actual: str | Column, forecast: str | Column) -> Column:
    gap = _c(actual) - _c(forecast)
    return F.sqrt(F.avg(gap * gap))


def outside_interval(actual: str | Column, low: str | Column, high: str | Column) -> Column:
    """The report's flag: an actual on the boundary is not an error."""
    return (_c(actual) < _c(low)) | (_c(actual) > _c(high))


def report_coverage(actual: str | Column, low: str | Column, high: str | Column) -> Column:
    return 1 - F.avg(outside_interval(actual, low, high).cast("int"))


def coverage_error(actual: str | Column, low: str | Column, high: str | Column, target: float = params.TARGET_COVERAGE) -> Column:
    """100 * |share strictly inside - target|; an actual on the boundary is not covered."""
    inside = (_c(high) > _c(actual)) & (_c(low) < _c(actual))
    return 100 * F.abs(F.avg(inside.cast("int")) - F.lit(target))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report_metrics(
    display: DataFrame, keys: Sequence[str] = ("node",), actual: str = "LMP_HOURLY", forecast: str = "mean_fcast"
) -> DataFrame:
    """MAE, bias and coverage over the rows that have both a forecast and an actual.

    Groups without such rows stay, with ``-`` for MAE and bias as in the report title.
    """
    both = F.col(actual).isNotNull() & F.col(forecast).isNotNull()
    a, f = F.when(both, F.col(actual)), F.when(both, F.col(forecast))
    wrong = F.when(both, outside_interval(actual, "q10", "q90").cast("int"))
    numbers = display.groupBy(*keys).agg(
        F.count_if(both).alias("n_hours"), mae(a, f).alias("_mae"), bias(a, f).alias("_bias"),
        (1 - F.avg(wrong)).alias("ci_coverage"),
    )
    text = lambda c: F.coalesce(display_round(c).cast("string"), F.lit("-"))
    return numbers.select(*keys, "n_hours", text("_mae").alias("mae"), text("_bias").alias("bias"), "ci_coverage")


def model_report(scored: DataFrame, node: str = ID, actual: str = "actual") -> DataFrame:
    """MAE and RMSE of the median and coverage error per node, plus the row of node
    averages (null node): every node counts the same, whatever its number of hours."""
    per_node = scored.where(F.col(actual).isNotNull() & F.col("q50").isNotNull()).groupBy(node).agg(
        mae(actual, "q50").alias("mae"), rmse(actual, "q50").alias("rmse"),
        coverage_error(actual, "q10", "q90").alias("ci_coverage_error"),
        F.count(F.lit(1)).alias("n_hours"),
    )
    return per_node.rollup(node).agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
        F.avg("ci_coverage_error").alias("ci_coverage_error"), F.sum("n_hours").alias("n_hours"),
    )


def backtest_targets(
    test: DataFrame, horizon: int = params.HORIZON, stride: int = params.BACKTEST_STRIDE,
    input_chunk: int = params.INPUT_CHUNK, step_hours: int = 1,
) -> DataFrame:
    """Rows (unique_id, origin, horizon, time, actual) of every rolling origin.

    Origins start after one input chunk and move by ``stride`` while a full horizon
    fits. Each row is sent to the origins that forecast it.
    """
    last = F.max("step").over(Window.partitionBy(ID))
    rows = with_step_index(test.select(ID, TIME, TARGET), (ID,), TIME, step_hours).withColumn("_last", last)
    step, first = F.col("step"), input_chunk - 1
    low = F.greatest(step - horizon, F.lit(first))
    start = (first + F.ceil((low - first) / stride) * stride).cast("int")
    stop = F.least(step - 1, F.col("_last") - horizon).cast("int")
    sent = rows.where(start <= stop).withColumn("_o", F.explode(F.sequence(start, stop, F.lit(stride))))
    gap = step - F.col("_o")
    return sent.select(
        ID, (F.col(TIME) - F.make_dt_interval(F.lit(0), gap * step_hours)).alias("origin"),
        gap.alias("horizon"), F.col(TIME).alias("time"), F.col(TARGET).cast("double").alias("actual"),
    )


def backtest(
    train: DataFrame, test: DataFrame, horizon: int = params.HORIZON, stride: int = params.BACKTEST_STRIDE,
    input_chunk: int = params.INPUT_CHUNK, season_hours: int = SEASON_HOURS, step_hours: int = 1, by_hour: bool = True,
) -> DataFrame:
    """Rows (unique_id, origin, mae, ci_error, n_hours) of the ensemble; members are fitted
    once on ``train`` and not refitted. Aggregate over origins with :func:`backtest_summary`."""
    targets = backtest_targets(test, horizon, stride, input_chunk, step_hours)
    history = train.select(ID, TIME, TARGET).unionByName(test.select(ID, TIME, TARGET)).dropDuplicates([ID, TIME])
    members = predict_members(
        history, targets.drop("actual"), params.REPORT_QUANTILES, season_hours, train, step_hours, by_hour
    )
    q = ensemble_mean(list(members.values()), len(params.REPORT_QUANTILES))
    keys = [ID, "origin", "horizon", "time"]
    scored = targets.join(q, keys).where(F.col("actual").isNotNull())
    low, mid, high = (F.col("q")[i] for i in range(3))
    return scored.groupBy(ID, "origin").agg(
        mae("actual", mid).alias("mae"), coverage_error("actual", low, high).alias("ci_error"),
        F.count(F.lit(1)).alias("n_hours"),
    )


def backtest_summary(per_origin: DataFrame) -> DataFrame:
    """Mean over origins of each node, then usable as the two objectives of a trial."""
    return per_origin.groupBy(ID).agg(
        F.avg("mae").alias("mae"), F.avg("ci_error").alias("ci_error"), F.count(F.lit(1)).alias("n_origins")
    )


def promotion_decision(new: DataFrame, champion: DataFrame, key: str = "evaluation", force: Column | bool = False) -> DataFrame:
    """Whether a retrained model replaces the champion, and why.

    Both frames hold ``key`` and ``avg_mae`` measured on the same data. No champion
    metrics: promote. No new metrics: never promote, unless forced.
    """
    force = F.lit(force) if isinstance(force, bool) else force
    both = new.select(key, F.col("avg_mae").alias("new_mae")).join(
        champion.select(key, F.col("avg_mae").alias("champion_mae")), key, "left"
    )
    promoted = (
        F.when(force, True)
        .when(F.col("new_mae").isNull() | F.isnan("new_mae"), False)
        .when(F.col("champion_mae").isNull(), True)
        .otherwise(F.col("new_mae") < F.col("champion_mae"))
    )
    reason = (
        F.when(force, "force promoted")
        .when(F.col("new_mae").isNull() | F.isnan("new_mae"), "new metrics missing")
        .when(F.col("champion_mae").isNull(), "no champion")
        .when(F.col("new_mae") < F.col("champion_mae"), "new MAE is lower")
        .otherwise("champion MAE is not higher")
    )
    return both.withColumns({"promoted": promoted, "promotion_reason": reason})


def smoke_test(forecast: DataFrame, minimum_rows: int = 1) -> None:
    """Fail unless the forecast returns rows; run before a promotion."""
    if len(forecast.take(minimum_rows)) < minimum_rows:
        raise ValueError("the forecast returned no rows; not promoting")


def compare_reports(new: DataFrame, champion: DataFrame, node: str = ID) -> DataFrame:
    """Metrics of both models side by side per node, and the averages (null node)."""
    metrics = ["mae", "rmse", "ci_coverage_error"]
    side = lambda df, name: df.select(
        F.col(node).alias(f"_{name}"), *[F.col(m).alias(f"{name}_{m}") for m in metrics]
    )
    both = side(new, "new").join(side(champion, "champion"), F.col("_new").eqNullSafe(F.col("_champion")), "full")
    return both.select(F.coalesce("_new", "_champion").alias(node), *[c for c in both.columns if not c.startswith("_")])
