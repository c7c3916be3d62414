from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import timeutil as tu
from hourgrid.functions.measures import clamp, display_round, drop_suffixes, guard_small, matches, normalize_columns, ratio
from hourgrid.sources import manifest


def times(df, column):
    return [r[0].strftime("%Y-%m-%d %H:%M:%S") for r in df.select(column).collect()]


def test_hour_ending_keeps_exact_hours(ts):
    df = ts([("2024-01-01 13:05:00",), ("2024-01-01 13:55:00",), ("2024-01-01 14:00:00",)], "t ntz")
    assert times(df, tu.hour_ending("t")) == ["2024-01-01 14:00:00"] * 3


def test_five_minute_ceiling(ts):
    df = ts([("2023-04-01 07:03:00",), ("2023-04-01 07:05:00",), ("2023-04-01 07:59:59",)], "t ntz")
    assert times(df, tu.ceil_minutes("t", 5)) == ["2023-04-01 07:05:00", "2023-04-01 07:05:00", "2023-04-01 08:00:00"]


def test_fixed_offset_and_forecast_start(ts):
    df = ts([("2024-01-01 13:00:00",)], "t ntz")
    assert times(df, tu.fixed_offset("t")) == ["2024-01-01 06:00:00"]
    assert times(df, tu.forecast_start(F.lit("2026-03-01"), F.lit("04"))) == ["2026-03-01 05:00:00"]


def test_results_do_not_depend_on_session_zone(spark, ts):
    df = ts([("2024-03-10 02:30:00",)], "t ntz")  # skipped hour in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert times(df, tu.hour_ending("t")) == ["2024-03-10 03:00:00"]
        assert times(df, tu.fixed_offset("t")) == ["2024-03-09 19:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_components(ts):
    df = ts([("2023-04-01 07:00:00",)], "local_time ntz")
    row = manifest.with_time_components(df).first()
    assert (row.YEAR, row.MONTH, row.DAY, row.HOUR, row.MINUTE) == ("2023", "04", "01", "07", "00")
    assert (row.YM, row.YMD, row.COMBINED) == ("202304", "20230401", "202304010700")
    assert row.timestamp_utc == datetime(2023, 4, 1, 12)


def test_components_ceil_to_hour(ts):
    row = manifest.with_time_components(ts([("2023-04-01 07:30:00",)], "local_time ntz")).first()
    assert (row.HOUR, row.MINUTE) == ("08", "00")


def test_daylight_saving_changes_are_dropped(ts):
    rows = [("2023-03-12 02:00:00",), ("2023-11-05 01:00:00",), ("2023-11-05 02:00:00",)]
    kept = manifest.with_time_components(ts(rows, "local_time ntz")).collect()
    assert [(r.COMBINED, r.timestamp_utc) for r in kept] == [("202311050200", datetime(2023, 11, 5, 8))]


@pytest.mark.parametrize("frequency,periods,first", [("h", 24, "2024-01-01 01:00:00"), ("5min", 288, "2024-01-01 00:05:00"), ("D", 7, "2023-12-27 00:00:00")])
def test_request_manifest_length_and_start(spark, frequency, periods, first):
    stamps = times(manifest.request_manifest(spark, "2024-01-02 00:00:00", periods, frequency).orderBy("local_time"), "local_time")
    assert len(stamps) == periods and stamps[0] == first and stamps[-1] == "2024-01-02 00:00:00"


def test_feed_manifest_paths(spark):
    row = manifest.feed_manifest(spark, "price_5min", "2025-01-16 19:25:00", 1, "MKT", "https://x.example/?").first()
    assert row.url == "https://x.example/?path=%2F2025%2F01%2FBy_Interval%2F16%2FMKT-RTBM-LMP-SL-202501161925.csv"
    daily = manifest.feed_manifest(spark, "price_daily", "2025-01-16 00:00:00", 1, "MKT").first()
    assert daily.url == "path=%2F2025%2F01%2FBy_Day%2FMKT-RTBM-LMP-DAILY-SL-20250116.csv"


def test_measures(spark):
    df = spark.createDataFrame([(v,) for v in (-500.0, -100.0, 0.0, 50.0, 100.0, 300.0, 500.0, None)], "v double")
    assert [r[0] for r in df.select(clamp("v")).collect()] == [-200, -100, 0, 50, 100, 200, 200, None]
    one = spark.createDataFrame([(0.125, 0.0, -0.5)], "a double, z double, s double")
    got = one.select(display_round("a"), ratio(F.col("a"), F.col("z")), guard_small(F.col("s"))).first()
    assert tuple(got) == (0.12, None, 1.0)


def test_matches_uses_substring_for_plain_patterns(spark):
    df = spark.createDataFrame([("PSCO_A",), ("XPSCO_B",), ("C",), (None,)], "n string")
    assert df.where(matches("n", "PSCO_")).count() == 2
    assert df.where(matches("n", "^PSCO_")).count() == 1


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], " Averaged Actual int, b_right int, c int".replace(" Averaged Actual", "` Averaged Actual `"))
    assert drop_suffixes(normalize_columns(df), "_right", "_lmp").columns == ["Averaged_Actual", "c"]
