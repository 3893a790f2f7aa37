"""Property tests: random inputs against plain Python / numpy references."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldwise.functions.columns import fold_of, round_half_up
from foldwise.operators.metrics import regression_metrics

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LONG_MAX = 9.223372036854776e18


def _jvm_round(x: float) -> float:
    if math.isnan(x):
        return 0.0
    y = math.floor(x + 0.5) if abs(x) < 1e18 else x
    return float(max(min(y, LONG_MAX), -LONG_MAX))


@SETTINGS
@given(st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=False, width=64),
                          st.integers(-10**6, 10**6).map(lambda i: i / 2)), min_size=1, max_size=40))
def test_round_half_up_matches_reference(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r.y for r in df.select(round_half_up("x").alias("y")).collect()]
    assert got == [_jvm_round(float(x)) for x in xs]


@SETTINGS
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=3, max_size=60))
def test_metrics_match_numpy(spark, pairs):
    y = np.array([a for a, _ in pairs])
    p = np.array([b for _, b in pairs])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    row = regression_metrics(df).collect()[0]
    assert row.n == len(y)
    assert row.mae == pytest.approx(np.abs(y - p).mean(), rel=1e-9, abs=1e-9)
    assert row.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()), rel=1e-9, abs=1e-9)
    if np.std(y) > 1e-9 * max(1.0, np.abs(y).max()) and np.std(p) > 1e-9 * max(1.0, np.abs(p).max()):
        assert row.corr == pytest.approx(np.corrcoef(y, p)[0, 1], rel=1e-6, abs=1e-9)


@SETTINGS
@given(st.lists(st.text(min_size=0, max_size=8), min_size=1, max_size=50), st.integers(2, 12))
def test_folds_in_range_and_stable(spark, ids, k):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    a = df.select("id", fold_of("id", k).alias("f")).collect()
    b = df.repartition(3).select("id", fold_of("id", k).alias("f")).collect()
    assert all(0 <= r.f < k for r in a)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    by_id = {}
    for r in a:
        assert by_id.setdefault(r.id, r.f) == r.f   # a repeated id keeps its fold


@SETTINGS
@given(st.integers(20, 200), st.integers(1, 4), st.integers(2, 6))
def test_fold_moments_add_up(spark, n, d, k):
    from foldwise.operators.moments import collect_summaries, fold_summaries, total
    from foldwise.operators.scale import Scaler

    rng = np.random.default_rng(n * 31 + d * 7 + k)
    X = rng.normal(size=(n, d)) * 100 + 50
    y = X @ rng.normal(size=d) + rng.normal(size=n)
    rows = [(str(i), float(y[i]), [float(v) for v in X[i]], int(i % k)) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, label double, f array<double>, fold int")
    sc = Scaler(X.mean(axis=0), X.std(axis=0, ddof=1), n, float(y.mean()))
    m = {f: s.moments(sc) for f, s in collect_summaries(fold_summaries(df, d)).items()}
    t = total(m, d)
    Z = (X - sc.means) / sc.stds
    U = np.c_[Z, np.ones(n)]
    assert np.allclose(t.G, U.T @ U, rtol=1e-9, atol=1e-6)
    for f, mf in m.items():
        sel = np.arange(n) % k != f
        assert np.allclose((t - mf).G, U[sel].T @ U[sel], rtol=1e-9, atol=1e-6)
