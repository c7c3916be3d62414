from __future__ import annotations

import os
from datetime import date, datetime

import pytest

from hourgrid.operators.upsert import rebuild_table
from hourgrid.schemas import FEEDS
from hourgrid.sources import export, feeds, jobs, tables
from hourgrid.streaming import streams

LOAD = """Interval,GMTIntervalEnd,MTLF,Averaged Actual
04/01/2023 07:00:00,04/01/2023 13:00:00,{a},90
04/01/2023 08:00:00,04/01/2023 14:00:00,{b},
"""
PRICE5 = """Interval,GMTIntervalEnd,Settlement Location,Pnode,LMP,MLC,MCC,MEC
04/01/2023 07:05:00,04/01/2023 12:05:00,PSCO_A,PA,{a},1,2,3
04/01/2023 07:05:00,04/01/2023 12:05:00,PSCO_B,PB,30,1,2,3
"""
DAILY = """Interval,GMT Interval,Settlement_Location_Name,PNODE_Name,LMP,MLC,MCC,MEC
04/01/2023 07:05:00,04/01/2023 12:05:00,PSCO_A,PA,25.0,1,2,3
04/01/2023 07:10:00,04/01/2023 12:10:00,PSCO_A,PA,26.0,1,2,3
"""
FUEL = """GMT_TIME,Coal_Market,Coal_Self,Hydro,Natural_Gas,Nuclear,Solar,Wind
2023-04-01T12:00:00Z,1,2,3,4,5,6,7
"""


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def put(name, text):
        (folder / name).write_text(text)
        return str(folder)

    return put


def processed(spark, feed, folder, **options):
    return feeds.process_feed(feeds.read_landed(spark, feed, folder), feed, **options)


def test_load_feed(spark, landing):
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=100, b=110))
    rows = processed(spark, "load_forecast", folder).orderBy("GMTIntervalEnd").collect()
    assert [r.MTLF for r in rows] == [100.0, 110.0] and rows[1].Averaged_Actual is None
    assert rows[0].timestamp_mst == datetime(2023, 4, 1, 6) and rows[0].file_create_time_utc == datetime(2023, 4, 1, 12)
    assert rows[0].url.endswith("MKT-OP-MTLF-202304010700.csv")
    kinds = dict(processed(spark, "load_forecast", folder).dtypes)
    assert kinds["MTLF"] == "float" and kinds["Interval"] == "timestamp_ntz"


def test_bad_rows_are_set_aside(spark, landing):
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=1, b=2) + "not a time,04/01/2023 15:00:00,3,4\n")
    raw = feeds.read_landed(spark, "load_forecast", folder)
    assert feeds.process_feed(raw, "load_forecast").count() == 2
    assert [r.Interval_text for r in feeds.rejected_rows(raw, "load_forecast").collect()] == ["not a time"]


def test_price_feeds_share_one_layout(spark, landing):
    folder = landing("MKT-RTBM-LMP-SL-202304010705.csv", PRICE5.format(a=20))
    landing("MKT-RTBM-LMP-DAILY-SL-20230401.csv", DAILY)
    five = processed(spark, "price_5min", folder)
    daily = processed(spark, "price_daily", folder, stamp_hour=15)
    assert five.dtypes == daily.dtypes
    assert sorted((r.Settlement_Location_Name, r.LMP) for r in five.collect()) == [("PSCO_A", 20.0), ("PSCO_B", 30.0)]
    row = daily.first()
    assert row.LMP == 25.5 and row.GMTIntervalEnd_HE == datetime(2023, 4, 1, 13)
    assert row.file_create_time_utc == datetime(2023, 4, 1, 20)


def test_hourly_mean_over_files(spark, landing):
    folder = landing("MKT-RTBM-LMP-SL-202304010705.csv", PRICE5.format(a=20))
    landing("MKT-RTBM-LMP-SL-202304010710.csv", PRICE5.format(a=22))
    assert processed(spark, "price_5min", folder).count() == 4
    mean = processed(spark, "price_5min", folder, hourly_method="mean").where("PNODE_Name = 'PA'").first()
    assert mean.LMP == 21.0 and mean.url.endswith("202304010710.csv")
    with pytest.raises(ValueError):
        processed(spark, "price_5min", folder, hourly_method="median")


def test_generation_feed(spark, landing):
    folder = landing("MKT-HRLY-GEN-CAP-BY-FUEL-TYPE-20230401.csv", FUEL)
    row = processed(spark, "generation_by_fuel", folder).first()
    assert row.GMTIntervalEnd == datetime(2023, 4, 1, 12) and row.Wind == 7.0


def test_collect_is_incremental_and_reports_missing_files(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=100, b=110))
    first = jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 08:00:00", 2)
    assert [r.COMBINED for r in first["missing"].collect()] == ["202304010800"]
    assert first["stats"].first().rows_inserted == 2
    landing("MKT-OP-MTLF-202304010800.csv", LOAD.format(a=101, b=111))
    second = jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 08:00:00", 2)
    assert second["missing"].count() == 0
    stats = second["stats"].first()
    assert (stats.rows_inserted, stats.rows_updated) == (0, 2)
    table = tables.read_table(spark, tables.table_path(base, "mtlf"))
    assert sorted(r.MTLF for r in table.collect()) == [101.0, 111.0]
    third = jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 08:00:00", 2)
    assert third["stats"] is None
    assert feeds.read_bronze(spark, base, "load_forecast").count() == 4


def test_daily_file_and_later_interval_stamps(spark, landing, tmp_path):
    """A daily file stamped earlier than an interval file loses; settled rank reverses it."""
    base = str(tmp_path / "base")
    folder = landing("MKT-RTBM-LMP-SL-202304010705.csv", PRICE5.format(a=20))
    landing("MKT-RTBM-LMP-DAILY-SL-20230401.csv", DAILY)
    jobs.collect(spark, "price_daily", folder, base, "2023-04-01 00:00:00", 1, stamp_hour=6)
    jobs.collect(spark, "price_5min", folder, base, "2023-04-01 07:05:00", 1)
    price = lambda path: {r.PNODE_Name: r.LMP for r in spark.read.parquet(path).collect()}
    assert price(f"{base}/lmp") == {"PA": 20.0, "PB": 30.0}
    rebuild_table(spark, "lmp", base, f"{base}/rebuilt")
    assert price(f"{base}/rebuilt/lmp") == {"PA": 20.0, "PB": 30.0}


def test_continuous_ingest(spark, landing, tmp_path):
    base, check = str(tmp_path / "base"), str(tmp_path / "check")
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=100, b=110))
    streams.continuous_ingest(spark, "load_forecast", folder, base, check).awaitTermination()
    landing("MKT-OP-MTLF-202304010800.csv", LOAD.format(a=101, b=111))
    streams.continuous_ingest(spark, "load_forecast", folder, base, check, max_files=1).awaitTermination()
    assert sorted(r.MTLF for r in spark.read.parquet(f"{base}/mtlf").collect()) == [101.0, 111.0]


def test_continuous_mean_across_midnight(spark, landing, tmp_path):
    """The hour ending at 00:00 UTC has intervals stamped on two dates, whichever comes last."""
    row = "{a},{g},PSCO_A,PA,{p},1,2,3\n"
    head = PRICE5.splitlines()[0] + "\n"
    files = {
        "202304011855": row.format(a="04/01/2023 18:55:00", g="04/01/2023 23:55:00", p=20), "202304011900": row.format(a="04/01/2023 19:00:00", g="04/02/2023 00:00:00", p=50),
    }
    for order in (sorted(files), sorted(files, reverse=True)):
        base, check = str(tmp_path / f"base{order[0]}"), str(tmp_path / f"check{order[0]}")
        folder = str(tmp_path / f"landing{order[0]}")
        os.mkdir(folder)
        for stamp in order:
            with open(f"{folder}/MKT-RTBM-LMP-SL-{stamp}.csv", "w") as sink:
                sink.write(head + files[stamp])
            streams.continuous_ingest(spark, "price_5min", folder, base, check, max_files=1, hourly_method="mean").awaitTermination()
        assert [(r.GMTIntervalEnd_HE, r.LMP) for r in spark.read.parquet(f"{base}/lmp").collect()] == [(datetime(2023, 4, 2), 35.0)]


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    spark.range(3).write.parquet(path)
    assert tables.table_exists(spark, path)
    tables.load_tables(spark, str(tmp_path), ["t"])
    assert spark.table("t").count() == 3
    assert tables.read_files(spark, path, glob="*.parquet").count() == 3


def test_csv_export_names(spark, ts, tmp_path):
    rows = [("N", "2026-03-01 05:00:00", "2026-03-01 06:00:00", 1.25)]
    df = ts(rows, "node string, origin ntz, time ntz, q50 double")
    assert df.select(export.export_name("node", "origin")).first()[0] == "price-forecast-N-2026-03-01T05-00.csv"
    export.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.first().forecast == "price-forecast-N-2026-03-01T05-00.csv" and back.first().q50 == "1.25"


def test_every_feed_has_a_file_tag_in_its_path():
    assert all(f.file_tag in f.path for f in FEEDS.values())


def put_time(path, when):
    os.utime(path, (when, when))


def test_revised_file_is_collected_again(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    name = "MKT-OP-MTLF-202304010700.csv"
    folder = landing(name, LOAD.format(a=10, b=11))
    run = lambda: jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 07:00:00", 1)
    put_time(f"{folder}/{name}", 1_700_000_000)
    run()
    landing(name, LOAD.format(a=99, b=11))
    put_time(f"{folder}/{name}", 1_700_000_100)
    assert run()["stats"].first().rows_updated == 2
    values = lambda path: sorted(r.MTLF for r in spark.read.parquet(path).collect())
    assert values(f"{base}/mtlf") == [11.0, 99.0]
    assert run()["stats"] is None
    rebuild_table(spark, "mtlf", base, f"{base}/again")
    assert values(f"{base}/again/mtlf") == [11.0, 99.0]


def test_hourly_mean_over_runs(spark, landing, tmp_path):
    """Files of an hour that arrive in different runs, one of them revised."""
    base = str(tmp_path / "base")
    for k, a in enumerate((20, 22, 90)):
        folder = landing(f"MKT-RTBM-LMP-SL-2023040107{5 * k + 5:02d}.csv", PRICE5.format(a=a))
        put_time(f"{folder}/MKT-RTBM-LMP-SL-2023040107{5 * k + 5:02d}.csv", 1_700_000_000 + k)
        jobs.collect(spark, "price_5min", folder, base, f"2023-04-01 07:{5 * k + 5:02d}:00", k + 1, hourly_method="mean")
    price = lambda at=base: {r.PNODE_Name: round(r.LMP, 4) for r in spark.read.parquet(f"{at}/lmp").collect()}
    assert price() == {"PA": 44.0, "PB": 30.0}
    landing("MKT-RTBM-LMP-SL-202304010715.csv", PRICE5.format(a=24))
    put_time(f"{folder}/MKT-RTBM-LMP-SL-202304010715.csv", 1_700_009_000)
    out = jobs.collect(spark, "price_5min", folder, base, "2023-04-01 07:15:00", 3, hourly_method="mean")
    assert price() == {"PA": 22.0, "PB": 30.0} and out["missing"].count() == 0
    rebuild_table(spark, "lmp", base, f"{base}/again", hourly_method="mean")
    assert price(f"{base}/again") == price()


def test_rejected_rows_are_stored_with_a_reason(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    text = LOAD.format(a="12x", b=2) + "not a time,04/01/2023 15:00:00,3,4\none,two\n"
    folder = landing("MKT-OP-MTLF-202304010700.csv", text)
    out = jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 07:00:00", 1)
    assert sorted(r.reason for r in out["rejected"].collect()) == ["columns", "number", "time"]
    assert spark.read.parquet(f"{base}/rejected/mtlf").count() == 3
    assert sorted((r.MTLF or 0) for r in spark.read.parquet(f"{base}/mtlf").collect()) == [0, 2.0]


def test_headers_are_compared_by_name(spark, landing):
    swapped = "Interval,GMTIntervalEnd,Solar Forecast MW,Wind Forecast MW\n04/01/2023 07:00:00,04/01/2023 13:00:00,1,2\n"
    folder = landing("MKT-OP-MTRF-202304010700.csv", swapped)
    with pytest.raises(ValueError, match="columns of renewable_forecast"):
        feeds.read_landed(spark, "renewable_forecast", folder)
    landing("MKT-OP-MTRF-202304010700.csv", swapped.split("\n", 1)[1])
    with pytest.raises(ValueError):
        feeds.read_landed(spark, "renewable_forecast", folder)


SWAPPED = "Interval,GMTIntervalEnd,Averaged Actual,MTLF\n04/01/2023 07:00:00,04/01/2023 13:00:00,1,2\n"


def run_load(spark, folder, base):
    return jobs.collect(spark, "load_forecast", folder, base, "2023-04-01 08:00:00", 2)


def test_a_file_without_a_good_row_is_read_once(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.split("\n", 1)[0] + "\nnot a time,x,3,4\n")
    assert [run_load(spark, folder, base)["verdicts"].count() for _ in range(3)] == [1, 0, 0]
    assert spark.read.parquet(f"{base}/rejected/mtlf").count() == 1
    assert [(r.verdict, r.n_rows, r.n_rejected) for r in spark.read.parquet(f"{base}/verdicts/mtlf").collect()] == [("no rows", 0, 1)]


def test_a_bad_header_stops_nobody(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    landing("MKT-OP-MTLF-202304010800.csv", SWAPPED)
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=1, b=2))
    out = run_load(spark, folder, base)
    assert [(r.reason, r.url[-16:]) for r in out["rejected"].collect()] == [("header", "202304010800.csv")]
    assert [r.file[-16:] for r in out["missing"].collect()] == ["202304010800.csv"]
    assert sorted(r.MTLF for r in spark.read.parquet(f"{base}/mtlf").collect()) == [1.0, 2.0]
    assert run_load(spark, folder, base)["verdicts"].isEmpty()
    # Delivered again with the right columns it is a new version, and taken.
    landing("MKT-OP-MTLF-202304010800.csv", LOAD.format(a=5, b=6))
    put_time(f"{folder}/MKT-OP-MTLF-202304010800.csv", 1_800_000_000)
    assert run_load(spark, folder, base)["missing"].isEmpty()
    assert sorted(r.MTLF for r in spark.read.parquet(f"{base}/mtlf").collect()) == [5.0, 6.0]


@pytest.mark.parametrize("died", ["after rejected", "after bronze"])
def test_a_run_that_died_is_repeated_without_doubles(spark, landing, tmp_path, monkeypatch, died):
    base = str(tmp_path / "base")
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a="12x", b=2) + "not a time,04/01/2023 15:00:00,3,4\n")
    name = "write_bronze" if died == "after rejected" else "append_once"
    original = getattr(feeds, name)

    def dies(*args):
        if name == "write_bronze" or "verdicts" in args[1]:
            raise RuntimeError("died")
        return original(*args)

    monkeypatch.setattr(feeds, name, dies)
    with pytest.raises(RuntimeError):
        run_load(spark, folder, base)
    monkeypatch.setattr(feeds, name, original)
    run_load(spark, folder, base)
    assert spark.read.parquet(f"{base}/rejected/mtlf").count() == 2
    assert spark.read.parquet(f"{base}/bronze/mtlf").count() == 2
    assert sorted((r.MTLF or 0) for r in spark.read.parquet(f"{base}/mtlf").collect()) == [0, 2.0]


def test_stream_sets_bad_files_aside(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    landing("MKT-OP-MTLF-202304010800.csv", SWAPPED)
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a="12x", b=2))
    for k in range(2):
        streams.continuous_ingest(spark, "load_forecast", folder, base, str(tmp_path / f"checkpoint{k}"), max_files=1).awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(f"{base}/rejected/mtlf").collect()) == ["header", "number"]
    assert sorted(r.verdict for r in spark.read.parquet(f"{base}/verdicts/mtlf").collect()) == ["header", "rows"]
    assert spark.read.parquet(f"{base}/bronze/mtlf").count() == 2


def test_generation_is_consolidated(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    folder = landing("MKT-HRLY-GEN-CAP-BY-FUEL-TYPE-20230401.csv", FUEL)
    out = jobs.collect(spark, "generation_by_fuel", folder, base, "2023-04-01 00:00:00", stamp_hour=3)
    assert out["stats"].first().rows_inserted == 1 and out["missing"].count() == 6
    assert spark.read.parquet(f"{base}/gen_cap").first().Wind == 7.0


def test_streamed_rows_reach_bronze_once(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    folder = landing("MKT-OP-MTLF-202304010700.csv", LOAD.format(a=100, b=110))
    landing("MKT-OP-MTLF-202304010800.csv", LOAD.format(a=101, b=111))
    for check in ("one", "two"):        # a second query without the first one's checkpoint replays everything
        streams.continuous_ingest(spark, "load_forecast", folder, base, str(tmp_path / check), max_files=1).awaitTermination()
    assert feeds.read_bronze(spark, base, "load_forecast").count() == 4
    rebuild_table(spark, "mtlf", base, f"{base}/again")
    assert sorted(r.MTLF for r in spark.read.parquet(f"{base}/again/mtlf").collect()) == [101.0, 111.0]


def test_a_run_opens_its_own_files_and_dates_only(spark, landing, tmp_path):
    base = str(tmp_path / "base")
    for day in ("0401", "0402", "0403"):
        folder = landing(f"MKT-OP-MTLF-2023{day}0700.csv", LOAD.format(a=1, b=2))
        jobs.collect(spark, "load_forecast", folder, base, f"2023-04-{day[2:]} 07:00:00", 1)
    names = feeds.name_glob(["MKT-OP-MTLF-202304020700.csv"], FEEDS["load_forecast"])
    assert [f.rsplit("/", 1)[1] for f in feeds.read_landed(spark, "load_forecast", folder, names).inputFiles()] == ["MKT-OP-MTLF-202304020700.csv"]
    held = feeds.dated(spark.read.parquet(feeds.bronze_path(base, "load_forecast")), date(2023, 4, 3), date(2023, 4, 3))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in plan and held.count() == 2
