"""Table preparation and the node x hour feature panel."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourgrid import params
from hourgrid.functions.measures import add_columns, guard_small, matches, mean_of, ratio, replace_outside
from hourgrid.operators.quantile import quantile_columns
from hourgrid.operators.windows import lag_diff, series_window, with_diff_and_rolling_sums

TimeArg = str | datetime | None


def _stamp(value: str | datetime):
    return F.lit(str(value)).cast("timestamp_ntz")


def _default_start(start: TimeArg) -> str | datetime:
    return start if start is not None else datetime.now() - timedelta(days=params.TRAIN_LOOKBACK_DAYS)


def time_range(df: DataFrame, time: str, start: TimeArg = None, end: TimeArg = None) -> DataFrame:
    """Rows with start <= time <= end; literals, so the filter reaches the scan."""
    df = df.where(F.col(time) >= _stamp(_default_start(start)))
    return df.where(F.col(time) <= _stamp(end)) if end is not None else df


def select_locations(df: DataFrame, pattern: str, exclude: str | None, column: str = "Settlement_Location_Name") -> DataFrame:
    df = df.where(matches(column, pattern))
    return df.where(~F.col(column).contains(exclude)) if exclude else df


def clip_outliers(
    df: DataFrame, column: str = params.TARGET, quantiles=params.CLIP_QUANTILES, accuracy: int | None = None
) -> DataFrame:
    """Replace values outside two nearest-rank quantiles of the whole frame by those quantiles.

    The quantiles are exact; with an ``accuracy`` they come from a sketch, off by at most a rank
    in ``accuracy``, without a shuffle of the values.
    """
    low, high = quantiles
    bounds = quantile_columns(df, [], column, {"low": low, "high": high}, "nearest", accuracy)
    pair = bounds.select(F.struct("low", "high")).scalar()
    marked = df.withColumn("_b", pair)
    kind = df.schema[column].dataType
    limits = [F.col(f"_b.{side}").cast(kind) for side in ("low", "high")]
    return marked.withColumn(column, replace_outside(column, *limits)).drop("_b")


def hourly_node_price(
    lmp: DataFrame,
    start: TimeArg = None,
    end: TimeArg = None,
    pattern: str = params.LOCATION_PATTERN,
    exclude: str | None = params.LOCATION_EXCLUDE,
    clip: bool = False,
    measure: str = "float",
    decimals: int | None = None,
) -> DataFrame:
    """Mean price per (unique_id, timestamp_mst).

    Clip bounds are taken after the location and start filters but before the end
    filter and the exclusion, over all nodes at once.
    """
    time = "timestamp_mst_HE"
    picked = time_range(lmp.where(matches("Settlement_Location_Name", pattern)), time, start)
    if clip:
        picked = clip_outliers(picked)
    if end is not None:
        picked = picked.where(F.col(time) <= _stamp(end))
    picked = picked.dropna(subset=["Settlement_Location_Name"])
    if exclude:
        picked = picked.where(~F.col("Settlement_Location_Name").contains(exclude))
    return picked.groupBy(
        F.col("Settlement_Location_Name").alias(params.ID), F.col(time).alias(params.TIME)
    ).agg(mean_of(F.col(params.TARGET).cast(measure), decimals).cast(measure).alias(params.TARGET))


def prep_price(lmp: DataFrame, **options) -> DataFrame:
    """Hourly node price with the change from the previous price row of the node."""
    measure = options.get("measure", "float")
    price = hourly_node_price(lmp, **options)
    return price.withColumn("lmp_diff", lag_diff(params.TARGET, series_window(params.ID)).cast(measure))


def _prep_hourly(df: DataFrame, columns: list[str], start: TimeArg, end: TimeArg, measure: str, decimals: int | None) -> DataFrame:
    picked = time_range(df, params.TIME, start, end)
    return picked.groupBy(params.TIME).agg(
        *[mean_of(F.col(c).cast(measure), decimals).cast(measure).alias(c) for c in columns]
    )


def prep_load(mtlf: DataFrame, start: TimeArg = None, end: TimeArg = None, measure: str = "float", decimals: int | None = None) -> DataFrame:
    """Mean load forecast and actual per hour."""
    return _prep_hourly(mtlf, ["MTLF", "Averaged_Actual"], start, end, measure, decimals)


def prep_renewable(mtrf: DataFrame, start: TimeArg = None, end: TimeArg = None, measure: str = "float", decimals: int | None = None) -> DataFrame:
    """Mean wind and solar forecast per hour."""
    return _prep_hourly(mtrf, ["Wind_Forecast_MW", "Solar_Forecast_MW"], start, end, measure, decimals)


def prep_generation(gen_cap: DataFrame, start: TimeArg = None, end: TimeArg = None, measure: str = "float") -> DataFrame:
    """Generation by fuel per hour; the two coal columns become one."""
    picked = time_range(gen_cap, params.TIME, start, end)
    plain = ["Hydro", "Natural_Gas", "Nuclear", "Solar", "Wind"]
    return picked.select(
        params.TIME,
        add_columns("Coal_Market", "Coal_Self").cast(measure).alias("Coal"),
        *[F.col(c).cast(measure).alias(c) for c in plain],
    )


def prep_weather(weather: DataFrame, start: TimeArg = None, end: TimeArg = None, measure: str = "float") -> DataFrame:
    """Temperature per panel hour."""
    picked = time_range(weather, params.TIME, start, end)
    return picked.select(params.TIME, F.col("temperature").cast(measure).alias("temperature"))


def node_hours(nodes: DataFrame, hours: DataFrame) -> DataFrame:
    """Every node at every hour of ``hours``.

    Nodes are first spread over the calendar days in range and then meet the hours of
    each day by key, so the grid is built evenly per (node, day) and neither side has
    to be copied to every executor.
    """
    bounds = hours.agg(F.struct(F.to_date(F.min(params.TIME)).alias("lo"), F.to_date(F.max(params.TIME)).alias("hi")))
    days = (
        nodes.select(params.ID).distinct()
        .withColumn("_b", bounds.scalar())
        .where(F.col("_b.lo").isNotNull())
        .select(params.ID, F.explode(F.sequence("_b.lo", "_b.hi", F.expr("INTERVAL '1' DAY"))).alias("_day"))
    )
    by_day = hours.select(params.TIME).distinct().withColumn("_day", F.to_date(params.TIME))
    return days.join(by_day, "_day").drop("_day")


def hour_features(load: DataFrame, renewable: DataFrame, cutoff: str = params.DATA_CUTOFF, measure: str = "float") -> DataFrame:
    """Load and renewable features of each hour; the same for every node.

    They are computed once per hour instead of once per (node, hour). The table has
    one row per hour of the calendar (8,760 a year), so its single ordered pass is
    small at any number of nodes or raw rows.
    """
    order = Window.partitionBy(F.lit(1)).orderBy(params.TIME)
    base = load.join(renewable, params.TIME, "left").where(F.col(params.TIME) >= _stamp(cutoff))
    renewables = F.col("Wind_Forecast_MW") + F.col("Solar_Forecast_MW")
    net = F.col("MTLF") - F.col("Wind_Forecast_MW") - F.col("Solar_Forecast_MW")
    out = base.withColumns({
        "re_ratio": ratio(renewables, F.col("MTLF")).cast(measure),
        "load_net_re": guard_small(net.cast(measure)).cast(measure),
    }).withColumns({
        "re_diff": lag_diff("re_ratio", order).cast(measure),
        "mtlf_diff": lag_diff("MTLF", order).cast(measure),
        "wind_diff": lag_diff("Wind_Forecast_MW", order).cast(measure),
        "solar_diff": lag_diff("Solar_Forecast_MW", order).cast(measure),
    })
    return with_diff_and_rolling_sums(out, "load_net_re", "load_net_re_diff", order, measure=measure)


def price_panel(price: DataFrame, nodes: DataFrame, hours: DataFrame, measure: str = "float") -> DataFrame:
    """Grid of nodes and hours with price, its change and rolling sums over the dense grid."""
    grid = node_hours(nodes, hours).join(price.select(params.ID, params.TIME, params.TARGET), [params.ID, params.TIME], "left")
    return with_diff_and_rolling_sums(grid, params.TARGET, "lmp_diff", series_window(params.ID), measure=measure)


def build_features(
    lmp: DataFrame,
    mtlf: DataFrame,
    mtrf: DataFrame,
    start: TimeArg = None,
    end: TimeArg = None,
    pattern: str = params.LOCATION_PATTERN,
    exclude: str | None = params.LOCATION_EXCLUDE,
    clip: bool = False,
    cutoff: str = params.DATA_CUTOFF,
    measure: str = "float",
    decimals: int | None = None,
) -> DataFrame:
    """The feature panel: one row per (unique_id, timestamp_mst).

    Hours come from the load forecast; price hours without one vanish, future hours
    stay with a null price. Only (node, hour, price) rows are shuffled by node for the
    windows; the wide hour features are joined last.
    """
    start = _default_start(start)
    load = prep_load(mtlf, start, end, measure, decimals)
    renewable = prep_renewable(mtrf, start, end, measure, decimals)
    hours = hour_features(load, renewable, cutoff, measure)
    price = hourly_node_price(lmp, start, end, pattern, exclude, clip, measure, decimals)
    nodes = select_locations(time_range(lmp, "timestamp_mst_HE", start, end), pattern, exclude).select(
        F.col("Settlement_Location_Name").alias(params.ID)
    ).dropna()
    panel = price_panel(price, nodes, load.where(F.col(params.TIME) >= _stamp(cutoff)), measure)
    features = panel.join(hours, params.TIME)
    return features.withColumn(
        "lmp_load_net_re", ratio(F.col(params.TARGET), F.col("load_net_re")).cast(measure)
    )


def model_columns(features: DataFrame) -> DataFrame:
    """Id, time, target, past and future covariates."""
    return features.select(params.TIME, params.ID, params.TARGET, *params.PAST_COLS, *params.FUTURE_COLS)
