from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourgrid import params
from hourgrid.operators.windows import series_window, with_diff_and_rolling_sums, with_rolling_sums
from hourgrid.plans import features

START = datetime(2023, 5, 20)
OPTIONS = {"start": "2023-05-01 00:00:00", "pattern": "PSCO_"}


def hours(n, start=START):
    return [start + timedelta(hours=i) for i in range(n)]


@pytest.fixture
def market(spark):
    """Two nodes x 200 hours after the cutoff, with load and renewable forecasts."""
    def make(n=200, start=START, nodes=("PSCO_A", "PSCO_B")):
        lmp = [(t, node, node, float(i % 17 + 3 * k), "u", t) for k, node in enumerate(nodes) for i, t in enumerate(hours(n, start))]
        load = [(t, 1000 + i % 24, 990.0 + i) for i, t in enumerate(hours(n, start))]
        renewable = [(t, 100.0 + i % 13, 50.0 + i % 7) for i, t in enumerate(hours(n, start))]
        ntz = lambda df, *c: df.withColumns({x: F.col(x).cast("timestamp_ntz") for x in c})
        return (
            ntz(spark.createDataFrame(lmp, "timestamp_mst_HE timestamp_ntz, Settlement_Location_Name string, PNODE_Name string, LMP double, url string, file_create_time_utc timestamp_ntz")),
            ntz(spark.createDataFrame(load, "timestamp_mst timestamp_ntz, MTLF int, Averaged_Actual double")),
            ntz(spark.createDataFrame(renewable, "timestamp_mst timestamp_ntz, Wind_Forecast_MW double, Solar_Forecast_MW double")),
        )
    return make


def test_prep_price_nulls_only_on_first_rows(market):
    lmp, _, _ = market(100)
    out = features.prep_price(lmp, **OPTIONS)
    assert out.count() == 200 and out.where("lmp_diff IS NULL").count() == 2
    assert dict(out.dtypes)["LMP"] == "float"


def test_prep_price_filters_locations_and_range(market, spark):
    lmp, _, _ = market(50, nodes=("PSCO_A", "PSCO_ARPA_X", "OTHER"))
    lmp = lmp.withColumn("Settlement_Location_Name", F.when(F.col("Settlement_Location_Name") == "PSCO_ARPA_X", "PSCO_B_ARPA").otherwise(F.col("Settlement_Location_Name")))
    end = str(START + timedelta(hours=9))
    out = features.prep_price(lmp, end=end, **OPTIONS)
    assert {r.unique_id for r in out.collect()} == {"PSCO_A"} and out.count() == 10


def test_price_nodes_of_one_location_are_averaged(spark, ts):
    rows = [("2023-06-01 01:00:00", "PSCO_A", 10.0), ("2023-06-01 01:00:00", "PSCO_A", 20.0)]
    lmp = ts(rows, "timestamp_mst_HE ntz, Settlement_Location_Name string, LMP double")
    assert features.prep_price(lmp, **OPTIONS).first().LMP == 15.0


def test_clip_keeps_rows_and_bounds_come_before_the_end_filter(market):
    lmp, _, _ = market(200)
    spiked = lmp.withColumn("LMP", F.when(F.col("timestamp_mst_HE") == F.lit(str(START)).cast("timestamp_ntz"), 5000.0).otherwise(F.col("LMP")))
    clipped = features.prep_price(spiked, clip=True, **OPTIONS)
    assert clipped.count() == 400
    # 400 values: nearest rank of 99.75 % is rank 398, the second spike's place is 399.
    assert clipped.agg(F.max("LMP")).first()[0] == 5000.0
    one = spiked.where("Settlement_Location_Name = 'PSCO_A' OR LMP < 5000")
    assert features.prep_price(one, clip=True, **OPTIONS).agg(F.max("LMP")).first()[0] < 5000.0


def test_default_start_is_a_year_back(market):
    lmp, _, _ = market(10)
    assert features.prep_price(lmp, pattern="PSCO_").count() == 0


def test_feature_panel_rows_and_nulls(market):
    out = features.build_features(*market(200), **OPTIONS).cache()
    assert out.count() == 400
    assert out.where("lmp_diff IS NULL").count() == 2
    for i in params.ROLLING_STEPS:
        assert out.where(f"lmp_diff_rolling_{i} IS NULL").count() == 2 * (i + 1)
        assert out.where(f"load_net_re_diff_rolling_{i} IS NULL").count() == 2 * (i + 1)
    row = out.where("unique_id = 'PSCO_B'").orderBy("timestamp_mst").collect()[8]
    assert row.re_ratio == pytest.approx((108 + 51) / 1008, rel=1e-6)
    assert row.load_net_re == 1008 - 108 - 51
    assert row.lmp_load_net_re == pytest.approx(11 / 849, rel=1e-6)
    assert set(params.PAST_COLS + params.FUTURE_COLS) <= set(out.columns)
    assert features.model_columns(out).columns[:3] == ["timestamp_mst", "unique_id", "LMP"]
    out.unpersist()


def test_panel_follows_load_hours_and_cutoff(market):
    lmp, load, renewable = market(100, start=datetime(2023, 5, 13))
    later = load.withColumn("timestamp_mst", F.col("timestamp_mst") + F.expr("INTERVAL 24 HOURS"))
    out = features.build_features(lmp, later, renewable, **OPTIONS)
    bounds = out.agg(F.min("timestamp_mst").alias("lo"), F.max("timestamp_mst").alias("hi"), F.count("*").alias("n")).first()
    assert bounds.lo == datetime(2023, 5, 15) and bounds.hi == datetime(2023, 5, 18, 3)
    assert bounds.n == 2 * 76
    future = out.where(F.col("timestamp_mst") > F.lit("2023-05-17 03:00:00").cast("timestamp_ntz"))
    assert future.where("LMP IS NOT NULL OR Wind_Forecast_MW IS NOT NULL").count() == 0 and future.count() == 48


def test_guard_and_zero_load(spark, ts):
    load = ts([("2023-06-01 01:00:00", 10.0, 1.0), ("2023-06-01 02:00:00", 0.0, 1.0)], "timestamp_mst ntz, MTLF double, Averaged_Actual double")
    renewable = ts([("2023-06-01 01:00:00", 10.0, 0.5), ("2023-06-01 02:00:00", 1.0, 1.0)], "timestamp_mst ntz, Wind_Forecast_MW double, Solar_Forecast_MW double")
    rows = features.hour_features(load, renewable).orderBy("timestamp_mst").collect()
    assert rows[0].load_net_re == 1.0 and rows[1].re_ratio is None and rows[1].load_net_re == -2.0


def test_diff_on_dense_grid_is_null_on_both_sides_of_a_gap(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0])], "unique_id string, timestamp_mst int, LMP double")
    out = with_diff_and_rolling_sums(df, "LMP", "d", series_window("unique_id"), (2,), "double").orderBy("timestamp_mst")
    assert [r.d for r in out.collect()] == [None, 1.0, None, None, 1.0]


def test_rolling_sum_needs_every_value(spark):
    values = [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "unique_id string, timestamp_mst int, x double")
    out = with_rolling_sums(df, "x", series_window("unique_id"), (2,), "double").orderBy("timestamp_mst")
    assert [r.x_rolling_2 for r in out.collect()] == [None, None, 6.0, None, None, None, 18.0]


def test_generation_and_weather(spark, ts):
    fuel = ts([("2023-06-01 01:00:00", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)], "timestamp_mst ntz, Coal_Market double, Coal_Self double, Hydro double, Natural_Gas double, Nuclear double, Solar double, Wind double")
    assert features.prep_generation(fuel, "2023-01-01").first().Coal == 3.0
    weather = ts([("2023-06-01 01:00:00", "2023-06-01 08:00:00", 21.5)], "timestamp_mst ntz, timestamp ntz, temperature double")
    assert features.prep_weather(weather, "2023-01-01").columns == ["timestamp_mst", "temperature"]
