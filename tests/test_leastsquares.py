from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import leastsquares as ls


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3)) * [1, 10, 1000] + [0, 5, 0]
    y = x @ [2.0, -0.5, 0.01] + 7 + rng.normal(size=600)
    key = rng.integers(0, 4, 600)
    return key, x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    key, x, y = data
    return spark.createDataFrame([(int(k), *map(float, a), float(b), int(k) % 2) for k, a, b in zip(key, x, y)], "h int, a double, b double, c double, y double, part long").repartition(5)


def test_coefficients_equal_least_squares(rows, data):
    key, x, y = data
    for r in ls.fit(ls.moments(rows, ["a", "b", "c"], "y", ["h"]), "h", (0.0,)).collect():
        own = key == r.h
        want = np.linalg.lstsq(np.column_stack([np.ones(own.sum()), x[own]]), y[own], rcond=None)[0]
        assert r.coefficients == pytest.approx(want, rel=1e-7) and r.n == own.sum()


def test_moments_can_be_added(rows):
    whole = {r.h: r for r in ls.moments(rows, ["a", "b", "c"], "y", ["h"]).collect()}
    parts = ls.moments(rows, ["a", "b", "c"], "y", ["h", "part"])
    for r in ls.added(parts, ["h"]).collect():
        assert r.n == whole[r.h].n and r.m == pytest.approx(whole[r.h].m, rel=1e-12)


def test_regularisations_at_once_and_constant_features(rows):
    flat = rows.withColumn("d", F.lit(3.0))
    found = {r.regularisation: r.coefficients for r in ls.fit(ls.moments(flat, ["a", "d"], "y", ["part"]), "part", (0.0, 1.0, 1e9)).filter("part = 0").collect()}
    assert abs(found[1.0][1]) < abs(found[0.0][1]) and abs(found[1e9][1]) < 1e-6
    assert all(c[2] == 0 for c in found.values())


def test_pooled_rows_and_empty(spark, rows):
    few = rows.filter("h <> 0").unionByName(rows.filter("h = 0").limit(1))
    found = {r.h: r.coefficients for r in ls.fit(ls.moments(few, ["a", "b", "c"], "y", ["h"]), "h", (0.01,), 100.0).collect()}
    assert found[0][1] == pytest.approx(2.0, abs=0.3)
    assert ls.fit(ls.moments(rows.limit(0), ["a"], "y", ["h"]), "h").count() == 0
    nulls = rows.withColumn("a", F.when(F.col("h") != 1, F.col("a")))
    assert {r.h for r in ls.moments(nulls, ["a"], "y", ["h"]).collect()} == {0, 2, 3}


def test_stored_linear_member(spark, rows, tmp_path):
    """Read back it forecasts the same; a horizon that was not fitted has no value."""
    from datetime import datetime, timedelta

    from hourgrid.plans import forecast

    t0 = datetime(2024, 1, 1)
    dense = spark.createDataFrame([("a", t0 + timedelta(hours=k), float(k % 24 + k / 100)) for k in range(500)], "unique_id string, timestamp_mst timestamp_ntz, LMP double")
    origins = spark.createDataFrame([("a", t0 + timedelta(hours=k)) for k in range(200, 400, 7)], "unique_id string, origin timestamp_ntz")
    member = forecast.fit_linear(dense, origins, 24)
    member.write(str(tmp_path))
    last = spark.createDataFrame([("a", t0 + timedelta(hours=450))], "unique_id string, origin timestamp_ntz")
    out = [sorted((r.horizon, tuple(r.q or ())) for r in forecast.predict_linear(m, dense, last, 30).collect()) for m in (member, forecast.read_linear(spark, str(tmp_path)))]
    assert out[0] == out[1] and [bool(q) for _, q in out[0]] == [True] * 24 + [False] * 6
    assert all(abs(q[10] - ((450 + h) % 24 + (450 + h) / 100)) < 3 for h, q in out[0][:24])
