"""Series operators: hourly grid, interpolation, splits, packing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid import params
from hourgrid.functions import timeutil as tu

HOUR = "INTERVAL '1' HOUR"


def fill_grid(
    df: DataFrame, ids: Sequence[str] = (params.ID,), time: str = params.TIME, step: str = HOUR
) -> DataFrame:
    """Insert the missing steps of each series between its own first and last stamp.

    Each row brings the steps up to the next row of its series, so the input is read once and
    nothing is joined. Stamps between steps start from the row before them.
    """
    ids = list(ids)
    rest = [c for c in df.columns if c not in (*ids, time)]
    following = F.lead(time).over(Window.partitionBy(*ids).orderBy(time))
    one = F.expr(step)
    gap = F.when(F.col("_next") > F.col(time) + one, F.sequence(F.col(time), F.col("_next") - F.expr("INTERVAL 1 MICROSECOND"), one))
    steps = df.withColumn("_next", following).withColumn("_steps", F.coalesce(gap, F.array(time))).drop("_next")
    rows = steps.select(*ids, F.posexplode("_steps").alias("_pos", "_at"), *rest)
    return rows.select(*ids, F.col("_at").alias(time), *[F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in rest])


def interpolate(
    df: DataFrame,
    columns: Sequence[str],
    ids: Sequence[str] = (params.ID,),
    time: str = params.TIME,
    measure: str | None = None,
) -> DataFrame:
    """Linear interpolation in time; both ends take the nearest known value.

    The next known value is found by a running ``last`` over descending time: a
    frame that reaches forward to the end would be evaluated anew for every row.
    Both orders share one exchange on the series id.
    """
    ids = list(ids)
    back = Window.partitionBy(*ids).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*ids).orderBy(F.col(time).desc()).rowsBetween(Window.unboundedPreceding, 0)
    seconds = _seconds(time)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(seconds.alias("t"), F.col(c).cast("double").alias("y"))) for c in columns}
    prev = {f"_p_{c}": F.last(known[c], ignorenulls=True).over(back) for c in columns}
    following = {f"_n_{c}": F.last(known[c], ignorenulls=True).over(ahead) for c in columns}
    out = df.withColumns(prev).withColumns(following)
    filled = {}
    for c in columns:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        between = p["y"] + (n["y"] - p["y"]) * (seconds - p["t"]) / (n["t"] - p["t"])
        value = F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(
            p.isNotNull() & n.isNotNull(), between
        ).otherwise(F.coalesce(p["y"], n["y"]))
        filled[c] = value.cast(measure) if measure else value
    return out.withColumns(filled).drop(*prev, *following)


def _seconds(time: str) -> Column:
    """Seconds since a fixed day, from interval parts (no session zone involved)."""
    gap = F.col(time) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    part = lambda unit: F.date_part(F.lit(unit), gap)
    return (part("DAY") * 86400.0 + part("HOUR") * 3600.0 + part("MINUTE") * 60.0 + part("SECOND").cast("double"))


def filled_series(
    df: DataFrame,
    columns: Sequence[str],
    ids: Sequence[str] = (params.ID,),
    time: str = params.TIME,
    step: str = HOUR,
    measure: str | None = None,
) -> DataFrame:
    """Dense hourly series without nulls: grid, then interpolation."""
    kept = df.select(*ids, time, *columns)
    return interpolate(fill_grid(kept, ids, time, step), columns, ids, time, measure)


def split_cuts(
    df: DataFrame,
    time: str = params.TIME,
    input_chunk: int = params.INPUT_CHUNK,
    buffer_hours: int = params.REVISION_BUFFER_HOURS,
    unit: str = "hour",
) -> DataFrame:
    """One row: train start, train/test split and test end over all series."""
    step = tu.hours if unit == "hour" else tu.days
    return df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).select(
        (F.col("lo") + step(2 * input_chunk)).alias("train_start"),
        (F.col("hi") - step(buffer_hours + 2 * input_chunk)).alias("split"),
        (F.col("hi") - step(buffer_hours)).alias("test_end"),
    )


def temporal_split(
    df: DataFrame,
    time: str = params.TIME,
    input_chunk: int = params.INPUT_CHUNK,
    buffer_hours: int = params.REVISION_BUFFER_HOURS,
    unit: str = "hour",
) -> dict[str, DataFrame]:
    """Frames ``all``, ``train``, ``test`` and ``train_test``.

    All comparisons are strict, so the split row is only in ``train_test``; the
    newest hours stay out of every split because prices get revised.
    """
    cuts = split_cuts(df, time, input_chunk, buffer_hours, unit)
    cut = cuts.select(F.struct("train_start", "split", "test_end").alias("c")).scalar()
    marked = df.withColumn("_c", cut)
    t, c = F.col(time), F.col("_c")
    pick = lambda cond: marked.where(cond).drop("_c")
    return {
        "all": df,
        "train": pick((t > c["train_start"]) & (t < c["split"])),
        "test": pick((t > c["split"]) & (t < c["test_end"])),
        "train_test": pick((t > c["train_start"]) & (t < c["test_end"])),
    }


def truncate_history(df: DataFrame, origin: str | Column, time: str = params.TIME) -> DataFrame:
    """History before the forecast origin; the origin itself is cut."""
    return df.where(F.col(time) < (F.col(origin) if isinstance(origin, str) else origin))


def select_series(df: DataFrame, ids: Sequence[str], column: str = params.ID) -> DataFrame:
    return df.where(F.col(column).isin(*ids))


def pack_series(
    df: DataFrame, columns: Sequence[str], ids: Sequence[str] = (params.ID,), time: str = params.TIME
) -> DataFrame:
    """One JSON text per series, times ascending, for scoring requests.

    A packed series is as long as the hours of its history.
    """
    point = F.struct(F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("time"), *columns)
    return df.groupBy(*ids).agg(F.to_json(F.sort_array(F.collect_list(point))).alias("series"))


def unpack_series(
    df: DataFrame, columns: Sequence[str], packed: str = "series", time: str = params.TIME, measure: str = "double"
) -> DataFrame:
    """Rows of packed series."""
    fields = ", ".join(f"{c}: {measure}" for c in columns)
    points = F.from_json(packed, f"array<struct<time: string, {fields}>>")
    out = df.withColumn("_p", F.explode(points))
    others = [c for c in df.columns if c != packed]
    return out.select(*others, F.to_timestamp_ntz("_p.time").alias(time), *[f"_p.{c}" for c in columns])


def ratio_after_fill(
    df: DataFrame, wind: str = "Wind_Forecast_MW", solar: str = "Solar_Forecast_MW", load: str = "MTLF"
) -> DataFrame:
    """Renewable share recomputed from filled covariates rather than interpolated."""
    return df.withColumn("Ratio", F.try_divide(F.col(wind) + F.col(solar), F.col(load)))


def origins(df: DataFrame, ids: Sequence[str] = (params.ID,), time: str = params.TIME, days: int = params.ORIGIN_DAYS) -> DataFrame:
    """Daily forecast origins of each series: its last stamp and the days before it."""
    last = df.groupBy(*ids).agg(F.max(time).alias("_hi"))
    return last.select(
        *ids,
        F.explode(F.sequence(F.col("_hi") - tu.days(days - 1), F.col("_hi"), F.expr("INTERVAL '1' DAY"))).alias("origin"),
    )
