"""Request manifests: which interval files should exist, their stamps and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.functions import timeutil as tu
from hourgrid.schemas import FEEDS, SOURCE, Feed

STEPS = {"D": "INTERVAL '1' DAY", "h": "INTERVAL '1' HOUR", "5min": "INTERVAL '5' MINUTE"}


def expand_manifest(
    bounds: DataFrame, end: str, periods: str | int, frequency: str, out: str = "local_time"
) -> DataFrame:
    """For each row of ``bounds``: ``periods`` stamps ending at ``end``, one row each."""
    step = F.expr(STEPS[frequency])
    count = F.col(periods) if isinstance(periods, str) else F.lit(periods)
    start = F.col(end) - step * (count - 1)
    return bounds.withColumn(out, F.explode(F.sequence(start, F.col(end), step)))


def request_manifest(spark: SparkSession, end: str, periods: int, frequency: str) -> DataFrame:
    """A manifest for one feed given as text end stamp and number of periods."""
    bounds = spark.range(1).select(F.lit(end).cast("timestamp_ntz").alias("end"))
    return expand_manifest(bounds, "end", periods, frequency).drop("end")


def with_time_components(
    df: DataFrame, local_time: str = "local_time", five_min: bool = False, zone: str = params.LOCAL_ZONE
) -> DataFrame:
    """Add the zero-padded parts of the ceiled local stamp, and the stamp in UTC.

    Stamps that a daylight-saving change skips or repeats are dropped.
    """
    stamp = tu.ceil_minutes(local_time, 5 if five_min else 60)
    out = df.withColumn("timestamp_local", stamp)
    out = out.where(tu.local_time_exists_once("timestamp_local", zone))
    # COMBINED is formatted once; the other parts are pieces of it.
    pieces = {
        "YEAR": (1, 4), "MONTH": (5, 2), "DAY": (7, 2), "HOUR": (9, 2), "MINUTE": (11, 2), "YM": (1, 6), "YMD": (1, 8),
    }
    out = out.withColumn("COMBINED", F.date_format("timestamp_local", "yyyyMMddHHmm"))
    return out.withColumns(
        {name: F.substring("COMBINED", start, length) for name, (start, length) in pieces.items()}
        | {"timestamp_utc": tu.local_to_utc("timestamp_local", zone)}
    )


def fill_template(template: str, **fixed: str) -> Column:
    """Template text with ``{NAME}`` fields filled from fixed values or columns."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{"):
            name = piece[1:-1]
            pieces.append(F.lit(fixed[name]) if name in fixed else F.col(name))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def source_path(feed: Feed, prefix: str, base: str = "") -> Column:
    """Path of the source file for each manifest row with time components."""
    return fill_template(base + feed.path, prefix=prefix)


def feed_manifest(
    spark: SparkSession, feed: str | Feed, end: str, periods: int, prefix: str, base: str = ""
) -> DataFrame:
    """Manifest rows of one feed with components, UTC stamp and source path."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    rows = request_manifest(spark, end, periods, feed.frequency)
    rows = with_time_components(rows, five_min=feed.frequency == "5min")
    return rows.withColumn(SOURCE, source_path(feed, prefix, base))


def file_name(path: str | Column) -> Column:
    """Last part of a path; ``%2F`` counts as a separator."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(F.regexp_replace(path, "%2F", "/"), r"([^/]+)$", 1)


def output_name(path: str | Column, prefix: str) -> Column:
    """Bronze name of a source file: the part after the market prefix, as parquet."""
    return F.regexp_replace(
        F.regexp_extract(path, rf"{re.escape(prefix)}-([^/]+)$", 1), r"\.csv$", ".parquet"
    )


def file_stamp(path: str | Column, feed: Feed, stamp_hour: int = 0, zone: str = params.LOCAL_ZONE) -> Column:
    """UTC creation stamp read from the digits that end a file name.

    Daily files carry a date only; ``stamp_hour`` is the local hour at which the
    collector asked for them.
    """
    digits = F.regexp_extract(path, r"(\d+)\.\w+$", 1)
    local = F.try_to_timestamp(digits, F.lit(feed.stamp_format)).cast("timestamp_ntz")
    if feed.frequency == "D":
        local = local + tu.hours(stamp_hour)
    return tu.local_to_utc(local, zone)


def landed(manifest: DataFrame, files: DataFrame, on: str | list[str]) -> DataFrame:
    """Manifest rows whose file has arrived."""
    return manifest.join(files, on=on, how="left_semi")


def missing(manifest: DataFrame, files: DataFrame, on: str | list[str]) -> DataFrame:
    """Manifest rows whose file has not arrived."""
    return manifest.join(files, on=on, how="left_anti")
