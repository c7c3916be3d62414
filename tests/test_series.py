from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import ranking, series, training
from hourgrid.operators.quantile import exact_quantiles, quantile_columns

T0 = datetime(2023, 1, 1)


def panel(spark, values_by_id, start=T0):
    rows = [(k, start + timedelta(hours=i), v) for k, vs in values_by_id.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, timestamp_mst timestamp_ntz, LMP double")


def test_interpolate_fills_inside_and_both_ends(spark):
    df = panel(spark, {"a": [1.0, 2.0, None, 4.0, None, None], "b": [None, 5.0, None, None, 8.0, None], "c": [None, None]})
    out = series.interpolate(df, ["LMP"]).orderBy("unique_id", "timestamp_mst").collect()
    assert [r.LMP for r in out] == [1, 2, 3, 4, 4, 4, 5, 5, 6, 7, 8, 8, None, None]


def test_fill_grid_stays_within_each_series(spark):
    df = panel(spark, {"a": [1.0] * 10}).where("hour(timestamp_mst) NOT IN (3, 4)").unionByName(panel(spark, {"b": [2.0] * 3}))
    out = series.fill_grid(df)
    assert out.groupBy("unique_id").count().orderBy("unique_id").collect()[0]["count"] == 10
    dense = series.filled_series(df, ["LMP"], measure="float")
    assert dense.where("LMP IS NULL").count() == 0 and dense.count() == 13 and dict(dense.dtypes)["LMP"] == "float"


def test_interpolation_matches_pandas(spark):
    rng = np.random.default_rng(3)
    values = [float(v) if rng.random() > 0.4 else None for v in rng.normal(size=200).round(3)]
    expected = pd.Series(values, dtype=float).interpolate(limit_direction="both")
    got = [r.LMP for r in series.interpolate(panel(spark, {"a": values}), ["LMP"]).orderBy("timestamp_mst").collect()]
    np.testing.assert_allclose(got, expected, atol=1e-9)


def test_split_boundaries(spark):
    df = panel(spark, {"a": [1.0] * 1000, "b": [1.0] * 1000})
    parts = series.temporal_split(df)
    index = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2023-01-01 00:00:00', timestamp_mst)")
    spans = {n: p.where("unique_id = 'a'").agg(F.min(index), F.max(index), F.count("*")).first() for n, p in parts.items()}
    assert tuple(spans["train"]) == (337, 494, 158)
    assert tuple(spans["test"]) == (496, 830, 335)
    assert tuple(spans["train_test"]) == (337, 830, 494)
    assert tuple(spans["all"]) == (0, 999, 1000)
    assert parts["train"].join(parts["test"], ["unique_id", "timestamp_mst"]).count() == 0


def test_truncate_excludes_the_origin(spark):
    out = series.truncate_history(panel(spark, {"a": [1.0] * 5}), F.lit("2023-01-01 03:00:00").cast("timestamp_ntz"))
    assert out.count() == 3


def test_pack_and_unpack(spark):
    df = panel(spark, {"a": [1.5, None, 3.25], "b": [2.0]})
    back = series.unpack_series(series.pack_series(df, ["LMP"]), ["LMP"])
    key = lambda d: sorted((r.unique_id, r.timestamp_mst, r.LMP or -1) for r in d.collect())
    assert key(back) == key(df)


def test_origins(spark):
    out = series.origins(panel(spark, {"a": [1.0] * 400})).orderBy("origin").collect()
    assert len(out) == 10 and out[-1].origin == T0 + timedelta(hours=399) and out[0].origin == out[-1].origin - timedelta(days=9)


@pytest.mark.parametrize("stride", [1, 3, 7, 50])
def test_training_windows_match_brute_force(spark, stride):
    values = {"a": [float(i) for i in range(60)], "b": [float(-i) for i in range(23)], "c": [1.0] * 5}
    out = training.training_windows(panel(spark, values), ["LMP"], ["LMP"], input_chunk=8, horizon=4, stride=stride)
    got = {(r.unique_id, r.origin): ([p.LMP for p in r.past], [f.LMP for f in r.future]) for r in out.collect()}
    want = {}
    for k, vs in values.items():
        for o in range(7, len(vs) - 4, stride):
            want[(k, T0 + timedelta(hours=o))] = (vs[o - 7: o + 1], vs[o + 1: o + 5])
    assert got == want
    origins = training.training_origins(panel(spark, values), input_chunk=8, horizon=4, stride=stride)
    assert {(r.unique_id, r.origin) for r in origins.collect()} == set(want)
    if stride == 1:
        frames = training.frame_windows(panel(spark, values), ["LMP"], ["LMP"], input_chunk=8, horizon=4)
        assert {(r.unique_id, r.origin): ([p.LMP for p in r.past], [f.LMP for f in r.future]) for r in frames.collect()} == want


def test_instance_norm_round_trip(spark):
    w = training.training_windows(panel(spark, {"a": [float(i * i) for i in range(20)]}), ["LMP"], ["LMP"], input_chunk=8, horizon=4)
    row = training.with_instance_norm(w).select(
        "past", "norm_mean", "norm_std", "past_norm", training.denormalize(F.col("past_norm")[3], F.col("norm_mean"), F.col("norm_std")).alias("back")
    ).first()
    past = np.array([p.LMP for p in row.past])
    assert row.norm_mean == pytest.approx(past.mean()) and row.norm_std == pytest.approx(past.std())
    assert row.back == pytest.approx(past[3]) and abs(np.mean(row.past_norm)) < 1e-9


def quantiles_of(df, groups, levels, method):
    rows = exact_quantiles(df, groups, "v", levels, method).collect()
    return {(tuple(r[g] for g in groups), r.level): r.quantile for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy_on_skewed_groups(spark, seed):
    """One group holds most rows, one has a single value, one repeats one value, some values are null."""
    rng = np.random.default_rng(seed)
    data = {
        "hot": rng.lognormal(3, 2, 4000).round(2), "one": np.array([7.5]), "flat": np.full(300, 3.0),
        "wide": rng.normal(0, 1e6, 50), None: rng.integers(-5, 5, 40).astype(float),
    }
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("hot", None), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    levels = [0.0, 0.0025, 0.1, 0.5, 0.9, 0.9975, 1.0]
    linear, nearest = quantiles_of(df, ["g"], levels, "linear"), quantiles_of(df, ["g"], levels, "nearest")
    assert {k[0][0] for k in linear} == set(data)
    for k, vs in data.items():
        ordered = np.sort(vs)
        for q in levels:
            assert linear[((k,), q)] == pytest.approx(np.quantile(vs, q), rel=1e-12, abs=1e-12)
            assert nearest[((k,), q)] == ordered[int(np.floor((len(vs) - 1) * q + 0.5))]


def test_exact_quantiles_over_everything(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)], "v double")
    assert [round(exact, 9) for _, exact in sorted((r.level, r.quantile) for r in exact_quantiles(df, [], "v", [0.1, 0.5, 0.9]).collect())] == [0.9, 4.5, 8.1]
    row = quantile_columns(df, [], "v", {"lo": 0.25, "hi": 0.75}).first()
    assert (row.lo, row.hi) == (2.25, 6.75)


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), [], "v", [0.5]).count() == 0


def dominated(rows):
    return [a for a in rows if not any(b[0] <= a[0] and b[1] <= a[1] and b != a for b in rows)]


@pytest.mark.parametrize("kind", ["random", "chain", "ties"])
def test_pareto_front_matches_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    rows = {
        "random": [(float(a), float(b)) for a, b in rng.random((500, 2)).round(2)],
        "chain": [(float(i), float(300 - i)) for i in range(300)],
        "ties": [(1.0, 2.0), (1.0, 2.0), (1.0, 3.0), (2.0, 2.0), (0.5, 9.0), (float("inf"), 0.0)],
    }[kind]
    front = ranking.pareto_front(spark.createDataFrame(rows, "x double, y double"), "x", "y")
    assert sorted(tuple(r) for r in front.collect()) == sorted(dominated(rows))


def test_ranking_helpers(spark):
    t = spark.createDataFrame([(1, "p", 3.0), (2, "p", 1.0), (3, "q", None), (4, "r", float("nan"))], "number int, params string, v double")
    scored = t.withColumn("v", ranking.or_infinity("v"))
    assert [r.v for r in scored.orderBy("number").collect()] == [3.0, 1.0, float("inf"), float("inf")]
    assert sorted(r.number for r in ranking.first_per_key(t, ["params"], ["number"]).collect()) == [1, 3, 4]
    assert ranking.best_row(scored, "v", ["number"]).first().number == 2
    assert [r.number for r in ranking.top_rows(scored, "v", 3, ["number"]).collect()] == [2, 1, 3]


def test_robust_scale(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert training.robust_scale(df, ["v"]).orderBy("v").collect()[7].v == pytest.approx(0.4)
