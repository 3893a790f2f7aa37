"""Dictionaries, coded designs and least squares for columns of many levels."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import coded as C
from foldwise.operators import dictionary as D
from foldwise.operators import encode as E
from foldwise.operators import wide as W
from foldwise.plans import programs as PR
from foldwise.plans import select as S
from foldwise.plans.training import prepare_coded, prepare_training
from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels
from foldwise.spec import FeatureSpec
from sample_tables import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL)


@pytest.fixture(scope="module")
def ct(inputs):
    return prepare_coded(*inputs, ORDER_SPEC)


@pytest.fixture(scope="module")
def tt(inputs):
    return prepare_training(*inputs, ORDER_SPEC)


def test_a_million_levels_without_a_collect(spark):
    n = 1_000_000
    df = spark.range(n).select(F.format_string("k%07d", (F.col("id") * 7919) % n).alias("a"),
                               F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("%d", F.col("id") % 1000)).alias("b"))
    d = D.build_dictionary(df, FeatureSpec("a", ("a", "b"), (), "a"))
    assert d.sizes == {"a": n, "b": 1001} and d.width == n - 1 + 1000
    got = d.with_codes(df)
    bad = got.filter(F.col("codes")[0] != F.substring("a", 2, 7).cast("bigint")).count()
    assert bad == 0 and got.count() == n
    assert got.filter((F.col("b") == "hot") & (F.col("codes")[1] != 1000)).count() == 0


def test_ranks_equal_the_literal_form(spark, inputs):
    enc = E.fit_encoder(inputs[0], ORDER_SPEC)
    d = D.build_dictionary(inputs[0], ORDER_SPEC)
    want = sorted((r["col"], r["level"], r["idx"]) for r in enc.level_frame(spark).collect())
    for rows in (d.table, E.level_index(E.distinct_levels(inputs[0].repartition(7), ORDER_SPEC.nominal))):
        assert sorted((r["col"], r["level"], r["idx"]) for r in rows.collect()) == want
    assert d.width == enc.width and d.dummy_width == enc.dummy_width


def test_codes_of_unknown_null_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(D, "HOT_ROWS", 2)
    spec = FeatureSpec("id", ("c", "e"), ("x",), "y")
    rows = [(i % 4, "b" if i % 2 else None, "same", 1.0) for i in range(40)] + [(9, "a", "same", 2.0)]
    df = spark.createDataFrame(rows, "id int, c string, e string, x double")
    d = D.build_dictionary(df, spec)
    assert d.sizes == {"c": 3, "e": 1} and d.width == 3
    new = spark.createDataFrame([*rows, (7, "zz", "other", 3.0)], df.schema)
    got = C.coded_rows(new, d, ("id",)).collect()
    assert len(got) == len(rows) + 1
    by = {(r["id"], tuple(r["slots"]), r["unseen_levels"]) for r in got}
    # levels of c in order: empty, a, b
    assert by == {(0, (-1, -1), 0), (2, (-1, -1), 0), (1, (1, -1), 0), (3, (1, -1), 0), (9, (0, -1), 0), (7, (-1, -1), 2)}
    empty = D.build_dictionary(df.filter("id < 0"), spec)
    assert empty.width == 1 and C.coded_rows(df, empty).count() == len(rows)


def test_rows_move_for_columns_of_many_levels_alone(spark, monkeypatch):
    n = 400
    df = spark.range(n).select("id", (F.col("id") % 5).cast("string").alias("few"), F.col("id").cast("string").alias("key"),
                               F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("skewed"))
    monkeypatch.setattr(D, "BROADCAST_LEVELS", 10)
    monkeypatch.setattr(D, "HOT_ROWS", 50)
    spec = FeatureSpec("id", ("few", "key", "skewed"), (), "y")
    d = D.build_dictionary(df, spec)
    assert d.most == {"few": 80, "key": 1, "skewed": 200}
    want = {c: {v: i for i, v in enumerate(sorted({str(r[c]) for r in df.collect()}))} for c in spec.nominal}
    got = d.with_codes(df).collect()
    assert sorted(r["id"] for r in got) == list(range(n))
    assert all(list(r["codes"]) == [want[c][r[c]] for c in spec.nominal] for r in got)
    # no exchange of the rows for few levels, no salt where no level is hot
    monkeypatch.setattr(D, "HOT_ROWS", 1000)
    plan = d.with_codes(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan
    few = D.build_dictionary(df, FeatureSpec("id", ("few",), (), "y")).with_codes(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = few._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_coded_rows_expand_to_the_dense_form(ct, tt):
    nd, width = ct.dictionary.dummy_width, ct.dictionary.width
    dense = {r["id"]: r["f"] for r in tt.df.collect()}
    sparse = {r["id"]: r["features"] for r in C.sparse_vectors(ct.df, ct.dictionary).collect()}
    for r in ct.df.collect():
        f = np.zeros(width)
        f[[s for s in r["slots"] if s >= 0]] = 1.0
        f[nd:] = r["x"]
        assert f.tolist() == dense[r["id"]] == sparse[r["id"]].toArray().tolist()
    assert ct.df.columns == ["id", "label", "slots", "x", "fold"]


def test_contingency_moments_equal_the_dense_ones(ct, tt):
    scaler, got = ct.moments().standardised()
    want = S.fold_moments(tt)
    assert scaler.means == pytest.approx(tt.scaler.means, rel=1e-9) and scaler.stds == pytest.approx(tt.scaler.stds, rel=1e-9)
    for k, m in want.items():
        assert got[k].G == pytest.approx(m.G, rel=1e-9, abs=1e-9 * m.n)
        assert got[k].h == pytest.approx(m.h, rel=1e-9, abs=1e-9 * np.abs(m.h).max())


def test_conjugate_gradients_equal_the_moments_form(ct, tt):
    models = W.wide_least_squares(ct.df, ct.moments())
    for (_, k), m in S.ols_fold_models(tt).models.items():
        assert models[k].coef == pytest.approx(m.coef, rel=1e-6, abs=1e-4)
    a, b = PR.wide_least_squares_program(ct), PR.least_squares_program(tt)
    for x, y in ((a.cv, b.cv), (a.training, b.training)):
        x, y = x.collect()[0], y.collect()[0]
        assert all(x[c] == pytest.approx(y[c], rel=1e-7) for c in ("corr", "mae", "rmse"))


def test_five_thousand_slots(spark):
    rnd = np.random.default_rng(0)
    n, levels = 20_000, 5_000
    a, b = rnd.integers(0, levels, n), rnd.integers(0, 3, n)
    x = rnd.normal(1e6, 3.0, n)
    effect = rnd.normal(size=levels)
    y = effect[a] + 2.0 * b + .5 * (x - 1e6) + 10 + rnd.normal(0, 1e-3, n)
    rows = [(i, f"l{p:05d}", f"m{q}", float(v), float(w)) for i, (p, q, v, w) in enumerate(zip(a, b, x, y))]
    df = spark.createDataFrame(rows, "id long, c string, e string, v double, label double")
    ct = prepare_coded(df, None, FeatureSpec("id", ("c", "e"), ("v",), "label"), n_folds=2)
    assert ct.dictionary.width > 4_800
    res = PR.wide_least_squares_program(ct)
    assert res.model.coef[-1] == pytest.approx(.5, abs=1e-4)
    used = np.unique(a)
    want = effect[used[1:]] - effect[used[0]]
    assert np.abs(res.model.coef[:len(want)] - want).max() < .02
    assert res.training.collect()[0]["rmse"] < 2e-3
    with pytest.raises(ValueError):
        ct.moments().summaries()


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, c string, v double, label double")
    ct = prepare_coded(df, None, FeatureSpec("id", ("c",), ("v",), "label"), n_folds=3)
    assert W.wide_least_squares(ct.df, ct.moments()) == {}
    assert PR.wide_least_squares_program(ct).cv.collect()[0]["n"] == 0
