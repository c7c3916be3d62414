from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import asof, upsert
from hourgrid.plans import profile, registry
from hourgrid.session import materialize, shared_dir

SCHEMA = "GMTIntervalEnd ntz, file_create_time_utc ntz, url string, value int"


def batch(ts, *rows):
    return ts(list(rows), SCHEMA)


def test_latest_stamp_wins_and_url_breaks_ties(ts):
    h = "2024-01-01 01:00:00"
    df = batch(ts, (h, "2024-01-01 00:00:00", "z", 1), (h, "2024-01-02 00:00:00", "a", 2), (h, "2024-01-02 00:00:00", "b", 3))
    assert [r.value for r in upsert.latest_wins(df, ["GMTIntervalEnd"]).collect()] == [3]


def test_settled_source_beats_a_later_stamp(ts):
    h = "2024-01-01 01:00:00"
    df = batch(ts, (h, "2024-01-01 00:00:00", "daily", 1), (h, "2024-01-02 00:00:00", "interval", 2))
    order = [upsert.settled_rank("url", ["daily"]), "file_create_time_utc", "url"]
    assert upsert.latest_wins(df, ["GMTIntervalEnd"], order).first().value == 1
    assert upsert.latest_wins(df, ["GMTIntervalEnd"]).first().value == 2


def test_upsert_is_idempotent_and_touches_only_batch_dates(spark, ts, tmp_path):
    base = str(tmp_path)
    first = batch(ts, ("2024-01-01 01:00:00", "2024-01-01 00:00:00", "a", 1), ("2024-01-02 01:00:00", "2024-01-01 00:00:00", "a", 2))
    stats = upsert.upsert_table(spark, first, "mtlf", base).first()
    assert (stats.rows_inserted, stats.rows_updated, stats.rows_after) == (2, 0, 2)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "mtlf" / "key_date=2024-01-01").iterdir()}
    second = batch(ts, ("2024-01-02 01:00:00", "2024-01-02 00:00:00", "b", 5), ("2024-01-02 02:00:00", "2024-01-02 00:00:00", "b", 6))
    stats = upsert.upsert_table(spark, second, "mtlf", base).first()
    assert (stats.rows_inserted, stats.rows_updated) == (1, 1)
    once = sorted(tuple(r) for r in spark.read.parquet(f"{base}/mtlf").collect())
    stats = upsert.upsert_table(spark, second, "mtlf", base).first()
    assert (stats.rows_inserted, stats.rows_updated) == (0, 2)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{base}/mtlf").collect()) == once
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "mtlf" / "key_date=2024-01-01").iterdir()}
    assert before == after


def test_upsert_does_not_depend_on_batch_order(spark, ts, tmp_path):
    a = batch(ts, ("2024-01-01 01:00:00", "2024-01-01 00:00:00", "a", 1), ("2024-01-01 02:00:00", "2024-01-03 00:00:00", "a", 2))
    b = batch(ts, ("2024-01-01 01:00:00", "2024-01-02 00:00:00", "b", 3), ("2024-01-01 02:00:00", "2024-01-02 00:00:00", "b", 4))
    results = []
    for name, order in (("ab", (a, b)), ("ba", (b, a))):
        for part in order:
            upsert.upsert_table(spark, part, "mtrf", str(tmp_path / name))
        results.append(sorted(r.value for r in spark.read.parquet(str(tmp_path / name / "mtrf")).collect()))
    assert results[0] == results[1] == [2, 3]


def test_unknown_target(spark, ts):
    with pytest.raises(ValueError):
        upsert.upsert_table(spark, batch(ts, ("2024-01-01 01:00:00", "2024-01-01 00:00:00", "a", 1)), "invalid", "/nowhere")


def test_union_checks_schemas(spark):
    with pytest.raises(ValueError):
        upsert.union_batches(spark.range(1), spark.range(1).select(F.col("id").cast("string")))


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in upsert.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        upsert.require_unique(df, ["k"], "t")


def test_as_of_takes_the_newest_known_vintage(ts):
    vintages = ts(
        [("h", "2024-01-01 01:00:00", 1.0), ("h", "2024-01-01 05:00:00", 2.0), ("h", "2024-01-04 05:00:00", 3.0), ("g", "2024-01-01 00:00:00", 9.0)],
        "k string, stamp ntz, v double",
    )
    asks = [("h", "2024-01-01 00:30:00"), ("h", "2024-01-01 05:00:00"), ("h", "2024-01-03 00:00:00"), ("h", "2024-01-04 06:00:00"), ("x", "2024-01-01 00:00:00")]
    out = asof.vintage_as_of(ts(asks, "k string, at ntz"), vintages, ["k"], "at", "stamp", ["v"])
    got = {(r.k, r.at.strftime("%d %H:%M")): r.v for r in out.collect()}
    assert got == {("h", "01 00:30"): None, ("h", "01 05:00"): 2.0, ("h", "03 00:00"): 2.0, ("h", "04 06:00"): 3.0, ("x", "01 00:00"): None}


def test_profile_counts_missing_values(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (None, 7), (4.0, 8)], "a double, b int")
    rows = {r.column_name: r for r in profile.numeric_profile(df).collect()}
    assert (rows["a"].row_count, rows["a"].missing_count, rows["a"].median, rows["a"].p25) == (4, 1, 2.0, 1.5)
    assert rows["b"].max == 8.0 and abs(rows["b"].avg - 20 / 3) < 1e-12


def test_registry_promote_and_revert(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.read_champion(spark, path) is None
    from datetime import datetime

    for folder, day in (("runs/1", 1), ("runs/2", 8)):
        registry.promote(spark, path, {"model": "price", "artifact_folder": folder, "promoted_at": datetime(2026, 3, day), "avg_mae": 1.0})
    assert registry.read_champion(spark, path).first().artifact_folder == "runs/2"
    registry.revert(spark, path, "price", "runs/1", "2026-03-09T00:00:00")
    assert registry.read_champion(spark, path).first().artifact_folder == "runs/1"
    with pytest.raises(ValueError):
        registry.revert(spark, path, "price", "runs/9", "2026-03-10T00:00:00")


def test_snapshot_is_a_versioned_copy(spark, tmp_path):
    base = str(tmp_path)
    spark.range(4).write.parquet(f"{base}/lmp")
    folder = registry.snapshot_tables(spark, base, ["lmp"], "2026-03-02_20-00-00")
    assert spark.read.parquet(f"{folder}/lmp").count() == 4
    assert spark.read.parquet(f"{base}/snapshot_log").first().version == "2026-03-02_20-00-00"
    with pytest.raises(Exception):
        registry.snapshot_tables(spark, base, ["lmp"], "2026-03-02_20-00-00")


def test_shared_dir_and_materialize(spark):
    assert shared_dir(spark) == shared_dir(spark)
    df = materialize(spark.range(5))
    assert df.count() == 5 and "Scan parquet" in df._jdf.queryExecution().toString()


def test_as_of_keeps_every_request_and_breaks_ties(spark, ts):
    asks = ts([("a", "2024-01-02 00:00:00"), (None, "2024-01-02 00:00:00"), ("a", None), ("a", "2023-01-01 00:00:00"), ("b", "2024-01-05 00:00:00")], "k string, at ntz")
    held = ts([("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-01 10:00:00", 3.0), ("a", "2024-01-01 10:00:00", 2.0), (None, "2024-01-01 10:00:00", 9.0), ("b", None, 5.0)], "k string, stamp ntz, v double")
    out = asof.vintage_as_of(asks, held.repartition(4), ["k"], "at", "stamp", ["v"])
    got = sorted((r.k or "", str(r.at), r.v) for r in out.collect())
    assert got == [("", "2024-01-02 00:00:00", None), ("a", "2023-01-01 00:00:00", None), ("a", "2024-01-02 00:00:00", 3.0), ("a", "None", None), ("b", "2024-01-05 00:00:00", None)]
