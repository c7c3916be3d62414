from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.plans import features, registry, training_job
from hourgrid.sources import jobs

T0 = datetime(2024, 1, 1)
OPTIONS = {"start": "2024-01-01 00:00:00", "pattern": "PSCO_"}


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    rows = [
        (T0 + timedelta(hours=i), n, n, float(30 + 10 * k + 8 * np.sin(i % 168 / 168 * 6.283) + rng.normal()))
        for k, n in enumerate(["PSCO_A", "PSCO_B"]) for i in range(60 * 24)
    ]
    path = str(tmp_path_factory.mktemp("base"))
    spark.createDataFrame(rows, "timestamp_mst_HE timestamp_ntz, Settlement_Location_Name string, PNODE_Name string, LMP double").write.parquet(f"{path}/lmp")
    return path


def test_retrain_promotes_only_the_better_model_and_scoring_uses_it(spark, base):
    with pytest.raises(ValueError):
        training_job.score(spark, base, features.prep_price(spark.read.parquet(f"{base}/lmp"), **OPTIONS))
    run = lambda version, day, **kw: training_job.retrain(
        spark, base, version, horizon=48, promoted_at=datetime(2024, 3, day), **OPTIONS, **kw)
    first = run("v1", 1)
    assert first.promoted and first.decision.first().promotion_reason == "no champion"
    assert first.report.count() == 3 and first.report.where("unique_id IS NULL").first().mae < 5
    again = run("v2", 8)
    assert not again.promoted  # the same data gives the same error, which is not lower
    forced = run("v3", 9, force=True)
    assert forced.promoted
    champion = registry.read_champion(spark, f"{base}/registry").first()
    assert champion.artifact_folder.endswith("v3") and champion.data_snapshot_path.endswith("v3")
    assert spark.read.parquet(f"{base}/snapshots/v1/data_metrics").where("column_name = 'LMP'").first().row_count == 2880

    price = features.prep_price(spark.read.parquet(f"{base}/lmp"), **OPTIONS)
    out = training_job.score(spark, base, price, "2024-02-20 00:00:00", horizon=24)
    assert out.count() == 48 and out.agg(F.min("time"), F.max("time")).first()[0] == datetime(2024, 2, 20)
    training_job.score(spark, base, price, "2024-02-21 00:00:00", horizon=24)
    assert spark.read.parquet(f"{base}/forecasts").count() == 96
    training_job.score(spark, base, price, "2024-02-21 00:00:00", horizon=24)
    assert spark.read.parquet(f"{base}/forecasts").count() == 96


def test_scores_of_other_origins_and_nodes_stay(spark, base, tmp_path):
    """Two origins of a date, one node alone, a node whose feed lags, three days of history."""
    home = str(tmp_path)
    rows = spark.read.parquet(f"{base}/lmp")
    rows.write.parquet(f"{home}/lmp")
    training_job.retrain(spark, home, "v1", horizon=48, promoted_at=datetime(2024, 3, 1), **OPTIONS)
    price = features.prep_price(rows, **OPTIONS)
    read = lambda: spark.read.parquet(f"{home}/forecasts")
    run = lambda df, origin=None, **kw: training_job.score(spark, home, df, origin, horizon=24, **kw)
    assert run(price, "2024-02-20 05:00:00").count() == 48
    assert run(price, "2024-02-20 06:00:00").count() == 48
    assert read().count() == 96
    assert run(price, "2024-02-20 06:00:00", nodes=["PSCO_A"]).count() == 24
    assert read().count() == 96 and read().select("unique_id", "origin", "horizon").distinct().count() == 96

    late = price.where("unique_id = 'PSCO_A' OR timestamp_mst <= timestamp_ntz '2024-02-01 00:00:00'")
    out = run(late)
    assert out.count() == 48 and out.select("origin").distinct().count() == 1
    assert out.where("q IS NULL").count() == 0 and read().count() == 144

    short = price.where("timestamp_mst >= timestamp_ntz '2024-02-26 00:00:00'").where("unique_id = 'PSCO_A'")
    new = short.withColumn("unique_id", F.lit("PSCO_NEW"))
    out = training_job.score(spark, home, short.unionByName(new), horizon=120)
    assert out.count() == 240 and out.where("q IS NULL OR size(q) <> 21").count() == 0
    kinds = {(r.unique_id, r.n_members, r.fallback) for r in out.select("unique_id", "n_members", "fallback").distinct().collect()}
    assert ("PSCO_NEW", 0, True) in kinds and all(n >= 1 for u, n, _ in kinds if u == "PSCO_A")


def test_scheduled_runs():
    runs = {r[0]: r[1:] for r in jobs.scheduled_runs(datetime(2026, 3, 10, 14, 3))}
    assert runs["load_forecast"] == ("2026-03-10 15:00:00", 24, 0)
    assert runs["price_5min"] == ("2026-03-10 14:05:00", 288, 0)
    assert runs["price_daily"] == ("2026-03-08 00:00:00", 7, 15)
    assert dict((r[0], r[2]) for r in jobs.scheduled_runs(datetime(2026, 3, 10), True))["load_forecast"] == 17520
