"""Plans that must hold at scale: what is pushed down, shuffled and kept out of Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks import base, panel
from hourgrid.operators import training, upsert
from hourgrid.operators.series import interpolate
from hourgrid.plans import features

SF = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    o = base.table(spark, SF, "orders").select("o_orderkey", "o_orderdate")
    text = plan(features.time_range(o, "o_orderdate", "1996-03-01 00:00:00", "1999-06-30 00:00:00"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    named = features.select_locations(base.table(spark, SF, "part").select("p_name"), "red", None, "p_name")
    assert "StringContains(p_name,red)" in plan(named)


def test_all_price_windows_share_one_exchange(spark):
    nodes = base.table(spark, SF, "events").select(F.col("event_type").alias("unique_id"))
    hours = base.intervals(spark, SF).select("timestamp_mst")
    text = plan(features.price_panel(base.hourly_price(spark, SF), nodes, hours))
    assert len(re.findall(r"hashpartitioning\(unique_id#\d+, \d+\)", text)) <= 2  # windows, distinct nodes
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_interpolation_orders_share_one_exchange(spark):
    df = base.hourly_price(spark, SF).withColumn("x", F.col("LMP") * 2)
    text = plan(interpolate(df, ["LMP", "x"]))
    assert len(re.findall(r"Exchange hashpartitioning\(unique_id#\d+, \d+\)", text)) == 1
    assert "UnboundedFollowing" not in text and "unboundedfollowing" not in text


def test_latest_wins_combines_before_the_shuffle(spark):
    df = base.intervals(spark, SF)
    text = plan(upsert.latest_wins(df, ["event_type", "he"], ["ts", "event_id"]))
    assert "partial_max_by" in text


def test_merge_reads_only_the_dates_of_the_batch(spark, ts, tmp_path):
    rows = [(f"2024-01-0{d} 01:00:00", "2024-01-01 00:00:00", "a", d) for d in range(1, 6)]
    df = ts(rows, "GMTIntervalEnd ntz, file_create_time_utc ntz, url string, value int")
    upsert.upsert_table(spark, df, "mtlf", str(tmp_path))
    current = spark.read.parquet(str(tmp_path / "mtlf"))
    batch = df.where("value = 3").withColumn(upsert.PARTITION, F.to_date("GMTIntervalEnd"))
    touched = upsert.touched_partitions(current, batch)
    assert touched.count() == 1 and "2024-01-03" in plan(touched).split("PartitionFilters")[1].split("PushedFilters")[0]


def test_training_windows_reuse_the_series_partitioning(spark):
    dense = base.hourly_price(spark, SF)
    text = plan(training.training_windows(dense, ["LMP"], ["LMP"], input_chunk=48, horizon=24))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2  # hourly means, series
    assert "origin_step" in text and "partial_collect_list" in text


@pytest.mark.parametrize("name", ["feature_panel", "backtest", "display_table", "ensemble_mean", "quantile_grid", "pareto_front", "training_windows"])
def test_no_python_in_core_plans(spark, name):
    from checks.catalog import QUERIES

    text = plan(QUERIES[name][0](spark, SF))
    for marker in ("Python", "MapInPandas", "CartesianProduct"):
        assert marker not in text
    assert panel.Q
