"""Collection jobs: landed files to bronze to consolidated table, incremental or backfill."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators.upsert import upsert_table
from hourgrid.schemas import HOUR_ENDING_COLS, INTERVALS, LOCATION_COLS, SOURCE
from hourgrid.session import materialize
from hourgrid.sources import feeds, manifest, tables

# Periods each scheduled run asks for, per feed.
INCREMENTAL_PERIODS = {"load_forecast": 24, "renewable_forecast": 24, "price_5min": 288, "price_daily": 7, "generation_by_fuel": 7}
BACKFILL_PERIODS = {"load_forecast": 17520, "renewable_forecast": 17520, "price_5min": 288, "price_daily": 730, "generation_by_fuel": 730}


@dataclass
class Staged:
    """New rows of landed files, those set aside, a verdict on each file, and what bronze and the logs hold of the same dates."""

    rows: DataFrame
    rejected: DataFrame
    verdicts: DataFrame
    held: DataFrame | None
    logs: dict[str, DataFrame | None]


def read_logs(spark: SparkSession, base: str, feed: str) -> dict[str, DataFrame | None]:
    return {log: tables.read_table(spark, feeds.log_path(base, log, feed)) for log in (feeds.REJECTED, feeds.VERDICTS)}


def judged(lines: DataFrame, feed: str, stamp_hour: int, held: DataFrame | None, logs: dict[str, DataFrame | None]) -> Staged:
    """Rows, rejected rows and verdicts of new lines; a file whose header does not fit is set aside, the others go on."""
    raw, faults = feeds.split_files(lines, feed)
    rows = materialize(feeds.process_feed(raw, feed, stamp_hour, with_counts=True), "ingest")
    rejected = feeds.rejected_rows(raw, feed).unionByName(faults)
    stamp = F.to_date(manifest.file_stamp(F.col(SOURCE), feeds.get_feed(feed), stamp_hour))
    rejected = materialize(rejected.withColumn("file_date", stamp), "rejected")
    return Staged(rows, rejected, materialize(feeds.verdicts(lines, rows, rejected, feed, stamp_hour), "verdicts"), held, logs)


def stage(
    spark: SparkSession, feed: str, landing: str, base: str, requested: DataFrame | None = None, stamp_hour: int = 0,
) -> Staged:
    """Read landed files whose version neither bronze nor the verdicts hold yet.

    With a ``requested`` manifest only its files are opened, and only bronze and logs of the dates of their stamps are read, so
    a run costs what its manifest costs. A file that was written again since is taken again.
    """
    spec = feeds.get_feed(feed)
    held = tables.read_table(spark, feeds.bronze_path(base, feed))
    logs = read_logs(spark, base, feed)
    names = None
    if requested is not None:
        wanted = requested.select(manifest.file_name(SOURCE).alias("file")).distinct()
        names = [r.file for r in wanted.collect()]
        day = F.to_date(manifest.file_stamp(F.col("file"), spec, stamp_hour))
        # Stamps of daily files move with the hour of the run, so a day to either side.
        first, last = wanted.agg(F.date_sub(F.min(day), 1), F.date_add(F.max(day), 1)).first()
        held, logs = _dated(held, first, last), {log: _dated(df, first, last) for log, df in logs.items()}
    lines = feeds.csv_lines(spark.read, spec, landing, feeds.name_glob(names, spec) if names else None)
    if requested is not None:
        lines = manifest.landed(lines.withColumn("file", manifest.file_name(SOURCE)), wanted, on="file").drop("file")
    if held is not None:
        lines = feeds.only_new_files(lines, held)
    if logs[feeds.VERDICTS] is not None:
        lines = feeds.only_new_files(lines, logs[feeds.VERDICTS])
    return judged(materialize(lines, "landed"), feed, stamp_hour, held, logs)


def _dated(df: DataFrame | None, first, last) -> DataFrame | None:
    return None if df is None else feeds.dated(df, first, last)


def store(staged: Staged, base: str, feed: str) -> None:
    """Rejected rows, then bronze, then verdicts: a run that dies between is repeated and adds only what is lacking.

    A file with stored rows is not taken again once bronze has it; its rejected rows are there before. One without
    is not taken again once its verdict is there.
    """
    if not staged.rejected.isEmpty():
        feeds.append_once(staged.rejected, feeds.log_path(base, feeds.REJECTED, feed), staged.logs[feeds.REJECTED])
    if not staged.rows.isEmpty():
        feeds.write_bronze(staged.rows, base, feed)
    if not staged.verdicts.isEmpty():
        feeds.append_once(staged.verdicts, feeds.log_path(base, feeds.VERDICTS, feed), staged.logs[feeds.VERDICTS])


def batch_for_table(staged: Staged, hourly_method: str = "per_file") -> DataFrame:
    """What the consolidated table takes from a staged batch.

    With ``mean``, the hours the batch touches are computed anew from all their files: those of
    the batch and those that bronze holds.
    """
    rows = staged.rows
    if hourly_method == "mean" and INTERVALS in rows.columns and staged.held is not None:
        keys = [*HOUR_ENDING_COLS, *LOCATION_COLS]
        earlier = staged.held.drop("file_date").join(rows.select(*keys).distinct(), keys, "left_semi")
        rows = rows.unionByName(earlier.select(*rows.columns))
    return feeds.table_rows(rows, hourly_method)


def ingest(
    spark: SparkSession,
    feed: str,
    landing: str,
    base: str,
    requested: DataFrame | None = None,
    stamp_hour: int = 0,
) -> DataFrame | None:
    """Append new landed files to bronze; the new rows as stored, or None when there were none."""
    staged = stage(spark, feed, landing, base, requested, stamp_hour)
    store(staged, base, feed)
    return None if staged.rows.isEmpty() else staged.rows


def collect(
    spark: SparkSession,
    feed: str,
    landing: str,
    base: str,
    end: str,
    periods: int | None = None,
    prefix: str = "MKT",
    stamp_hour: int = 0,
    hourly_method: str = "per_file",
) -> dict[str, DataFrame | None]:
    """One scheduled run of a feed: manifest, new files, upsert, what is missing, what was set aside, and the files' verdicts.

    A backfill is the same run with ``BACKFILL_PERIODS``. The table is merged before bronze is
    appended: a run that dies between takes the same files again and changes nothing.
    """
    spec = feeds.get_feed(feed)
    periods = periods or INCREMENTAL_PERIODS[feed]
    requested = manifest.feed_manifest(spark, spec, end, periods, prefix)
    staged = stage(spark, feed, landing, base, requested, stamp_hour)
    stats = None
    if not staged.rows.isEmpty():
        stats = upsert_table(spark, batch_for_table(staged, hourly_method), spec.target, base)
    store(staged, base, feed)
    seen = staged.rows.select(SOURCE)
    if staged.held is not None:
        seen = seen.unionByName(staged.held.select(SOURCE))
    absent = feeds.file_report(requested, seen)
    return {"stats": stats, "missing": absent.where(~F.col("landed")), "rejected": staged.rejected.drop("file_date"), "verdicts": staged.verdicts}


def scheduled_runs(now: datetime, backfill: bool = False) -> list[tuple[str, str, int, int]]:
    """(feed, end stamp, periods, stamp hour) of one collection round.

    Forecasts and interval prices end at the current hour or 5 minutes; daily prices and generation
    end two days ago, when their files are settled, and carry the hour of the run.
    """
    hour = now.replace(minute=0, second=0, microsecond=0)
    hour = hour if hour == now else hour + timedelta(hours=1)
    five = now - timedelta(minutes=now.minute % 5, seconds=now.second, microseconds=now.microsecond)
    five = five if five == now else five + timedelta(minutes=5)
    day = (now - timedelta(days=2)).replace(hour=0, minute=0, second=0, microsecond=0)
    ends = {"load_forecast": hour, "renewable_forecast": hour, "price_5min": five, "price_daily": day, "generation_by_fuel": day}
    periods = BACKFILL_PERIODS if backfill else INCREMENTAL_PERIODS
    return [(feed, str(end), periods[feed], hour.hour if feeds.get_feed(feed).frequency == "D" else 0) for feed, end in ends.items()]
