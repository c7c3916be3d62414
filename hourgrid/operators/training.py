"""Fixed-length training windows around forecast origins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.operators.quantile import quantile_columns


def with_step_index(
    df: DataFrame, ids: Sequence[str] = (params.ID,), time: str = params.TIME, step_hours: int = 1, out: str = "step"
) -> DataFrame:
    """Steps since the series' first stamp; on a dense grid this is the row number."""
    marked = df.withColumn("_start", F.min(time).over(Window.partitionBy(*ids)))
    return marked.withColumn(out, (tu.hours_between(time, "_start") / step_hours).cast("int")).drop("_start")


def training_windows(
    df: DataFrame,
    past: Sequence[str],
    future: Sequence[str],
    ids: Sequence[str] = (params.ID,),
    time: str = params.TIME,
    input_chunk: int = params.INPUT_CHUNK,
    horizon: int = params.HORIZON,
    stride: int = params.BACKTEST_STRIDE,
    step_hours: int = 1,
) -> DataFrame:
    """Rows (ids, origin, past, future): the last ``input_chunk`` rows up to the origin
    and the ``horizon`` rows after it, as arrays; only full windows, every ``stride`` steps.

    The input must be dense. Each row is copied to the few origins whose window covers
    it, so a group (series, origin) has exactly ``input_chunk + horizon`` rows. The
    copies are made where the series already lies and do not travel again.
    """
    ids = list(ids)
    step = F.col("step")
    covering = origin_steps(step, input_chunk, horizon, stride)
    rows = with_step_index(df, ids, time, step_hours).select(*ids, time, "step", *dict.fromkeys([*past, *future]))
    sent = rows.withColumn("origin_step", F.explode(covering))
    is_past = step <= F.col("origin_step")
    out = sent.groupBy(*ids, "origin_step").agg(
        F.max(F.when(step == F.col("origin_step"), F.col(time))).alias("origin"),
        F.sort_array(F.collect_list(F.when(is_past, F.struct(time, *past)))).alias("past"),
        F.sort_array(F.collect_list(F.when(~is_past, F.struct(time, *future)))).alias("future"),
    )
    full = (F.size("past") == input_chunk) & (F.size("future") == horizon)
    return out.where(full).select(*ids, "origin", "past", "future")


def training_origins(
    df: DataFrame, ids: Sequence[str] = (params.ID,), time: str = params.TIME, input_chunk: int = params.INPUT_CHUNK,
    horizon: int = params.HORIZON, stride: int = params.BACKTEST_STRIDE, step_hours: int = 1,
) -> DataFrame:
    """Rows (ids, origin) of every full window, without building the windows."""
    last = F.max("step").over(Window.partitionBy(*ids))
    rows = with_step_index(df.select(*ids, time), ids, time, step_hours).withColumn("_last", last)
    first = input_chunk - 1
    step = F.col("step")
    kept = rows.where((step >= first) & ((step - first) % stride == 0) & (step <= F.col("_last") - horizon))
    return kept.select(*ids, F.col(time).alias("origin"))


def origin_steps(step: Column, input_chunk: int, horizon: int, stride: int) -> Column:
    """Origin steps whose window covers ``step``: input_chunk - 1, then every stride."""
    first = input_chunk - 1
    low = F.greatest(step - horizon, F.lit(first))
    high = step + input_chunk - 1
    aligned = (first + F.ceil((low - first) / stride) * stride).cast("int")
    return F.when(aligned <= high, F.sequence(aligned, high.cast("int"), F.lit(stride))).otherwise(
        F.array().cast("array<int>")
    )


def frame_windows(
    df: DataFrame,
    past: Sequence[str],
    future: Sequence[str],
    ids: Sequence[str] = (params.ID,),
    time: str = params.TIME,
    input_chunk: int = params.INPUT_CHUNK,
    horizon: int = params.HORIZON,
) -> DataFrame:
    """A window at every row (stride 1), by row frames on one exchange.

    Use it when every origin is wanted; with a stride, :func:`training_windows`
    builds only the windows that are kept.
    """
    order = Window.partitionBy(*ids).orderBy(time)
    back = order.rowsBetween(-(input_chunk - 1), 0)
    ahead = order.rowsBetween(1, horizon)
    out = df.select(
        *ids,
        F.col(time).alias("origin"),
        F.collect_list(F.struct(time, *past)).over(back).alias("past"),
        F.collect_list(F.struct(time, *future)).over(ahead).alias("future"),
    )
    return out.where((F.size("past") == input_chunk) & (F.size("future") == horizon))


def window_scale(past: str | Column, field: str) -> tuple[Column, Column]:
    """Mean and population standard deviation of one field over the past rows."""
    past = F.col(past) if isinstance(past, str) else past
    values = F.transform(past, lambda r: r[field].cast("double"))
    # One pass (Welford's updates), so that nothing is computed again for every element.
    begin = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("square"))

    def add(state, v):
        n = state["n"] + 1
        mean = state["mean"] + (v - state["mean"]) / n
        square = state["square"] + (v - state["mean"]) * (v - mean)
        return F.struct(n.alias("n"), mean.alias("mean"), square.alias("square"))

    scale = F.aggregate(values, begin, add)
    return scale["mean"], F.sqrt(scale["square"] / scale["n"])


def normalize(value: Column, mean: Column, std: Column, eps: float = 1e-5) -> Column:
    return (value - mean) / F.sqrt(std * std + eps)


def denormalize(value: Column, mean: Column, std: Column, eps: float = 1e-5) -> Column:
    """Inverse of :func:`normalize`."""
    return value * F.sqrt(std * std + eps) + mean


def with_instance_norm(
    windows: DataFrame, field: str = params.TARGET, eps: float = 1e-5
) -> DataFrame:
    """Add the window's scale and its normalised past values; the scale stays with the
    origin so that forecasts can be turned back."""
    mean, std = window_scale("past", field)
    # One aggregate serves both numbers: it is a column of its own, which is not merged into its two users.
    out = windows.withColumn("_scale", F.struct(mean.alias("mean"), std.alias("std")))
    out = out.withColumns({"norm_mean": F.col("_scale.mean"), "norm_std": F.col("_scale.std")}).drop("_scale")
    return out.withColumn(
        "past_norm",
        F.transform("past", lambda r: normalize(r[field].cast("double"), F.col("norm_mean"), F.col("norm_std"), eps)),
    )


def robust_scale(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """(value - median) / (p75 - p25), the statistics pooled over all series.

    The columns are read together, once for the counts of their values.
    """
    levels = {"lo": 0.25, "mid": 0.5, "hi": 0.75}
    columns = list(columns)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    stats = quantile_columns(long, ["column_name"], "value", levels, accuracy=accuracy)
    # One row with a struct per column: as many as there are columns.
    row = stats.agg(*[F.max(F.when(F.col("column_name") == c, F.struct("lo", "mid", "hi"))).alias(c) for c in columns])
    out = df.withColumn("_stats", row.select(F.struct(*columns)).scalar())
    scaled = {
        c: F.try_divide(F.col(c).cast("double") - F.col("_stats")[c]["mid"], F.col("_stats")[c]["hi"] - F.col("_stats")[c]["lo"])
        for c in columns
    }
    return out.withColumns(scaled).drop("_stats")
