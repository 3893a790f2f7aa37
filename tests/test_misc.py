"""Metrics guards, rounding, folds, inspection, sinks, plans and the driver contract."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sample_tables import SF_SMALL
from foldwise.functions.columns import fold_of, round_half_up
from foldwise.operators import folds as K
from foldwise.operators.inspect import first_rows
from foldwise.operators.metrics import macro_average, regression_metrics
from foldwise.session import scratch_path
from foldwise.sources import sinks as SK


def test_round_half_up(spark):
    df = spark.createDataFrame([(-2.5,), (-0.5,), (0.5,), (2.5,), (1.49,), (float("nan"),)], "x double")
    got = [r.y for r in df.select(round_half_up("x").alias("y")).collect()]
    assert got == [-2.0, 0.0, 1.0, 3.0, 1.0, 0.0]


def test_constant_prediction_gives_null_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "label double, prediction double")
    row = regression_metrics(df).collect()[0]
    assert row.corr is None and row.mae == pytest.approx(3.0)


def test_macro_average_null_propagates(spark):
    per_fold = spark.createDataFrame([(0, 0.5, 1.0, 1.0), (1, None, 1.0, 1.0)],
                                     "fold int, corr double, mae double, rmse double")
    row = macro_average(per_fold).collect()[0]
    assert row.corr is None and row.mae == 1.0 and row.folds == 2


def test_folds_are_deterministic_and_balanced(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    a = [r.fold for r in df.select(fold_of("id", 10).alias("fold")).orderBy("id").collect()]
    b = [r.fold for r in df.repartition(7).select("id", fold_of("id", 10).alias("fold")).orderBy("id").collect()]
    assert a == b
    counts = np.bincount(a, minlength=10)
    assert counts.min() > 1800 and counts.max() < 2200
    seeded = [r.fold for r in df.select(fold_of("id", 10, seed=1).alias("fold")).orderBy("id").collect()]
    assert seeded != a


def test_fold_split_covers_all_rows(spark):
    df = K.assign_folds(spark.range(500).select(F.col("id").cast("string").alias("id")), 5)
    for k in range(5):
        tr, va = K.fold_split(df, k)
        assert tr.count() + va.count() == 500
        assert va.filter(F.col("fold") != k).count() == 0


def test_fold_inspection_is_bounded_per_group(spark):
    df = K.assign_folds(spark.range(3000).select(F.col("id").cast("string").alias("id")), 10)
    out = K.inspect_fold_rows(df, 10, 10)
    assert out.count() == 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan   # top-n per fold is cut before the shuffle


def test_first_rows_without_bound_are_all_rows_in_order(spark):
    assert [r.id for r in first_rows(spark.range(30).orderBy(F.desc("id")), -1).collect()] == list(range(30))


def test_prediction_sink_round_trip_and_existing_path(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -2.0)], "id string, prediction double")
    path = scratch_path(spark, "pred-test")
    SK.write_predictions(df, path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["a,1.0", "b,-2.0"]
    back = sorted(tuple(r) for r in SK.read_predictions(spark, path).collect())
    assert back == [("a", 1.0), ("b", -2.0)]
    with pytest.raises(Exception):
        SK.write_predictions(df, path)


def test_linear_model_save_load(spark):
    from foldwise.operators.linear import LinearModel

    m = LinearModel(np.array([1.5, -2.0]), 0.25)
    path = scratch_path(spark, "model-test")
    assert SK.save_linear_model(spark, m, ["a", "b"], path)
    assert not SK.save_linear_model(spark, m, ["a", "b"], path)   # exists: reported, not raised
    back, enc = SK.load_linear_model(spark, path)
    assert enc is None and back.intercept == 0.25 and list(back.coef) == [1.5, -2.0]


def test_ml_model_save_existing(spark):
    from pyspark.ml.functions import array_to_vector
    from foldwise.operators.trees import tree_estimator

    df = spark.createDataFrame([([1.0], 1.0), ([2.0], 2.0)], "f array<double>, label double")
    model = tree_estimator(2, 4).fit(df.select(array_to_vector("f").alias("features"), "label"))
    path = scratch_path(spark, "tree-test")
    assert SK.save_ml_model(model, path)
    assert not SK.save_ml_model(model, path)


def test_scoring_reuses_training_encoder(spark):
    from foldwise.plans.score import score_table
    from foldwise.plans.select import fold_moments
    from foldwise.operators.linear import fit_ols
    from foldwise.operators.moments import total
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, SCORING_CUTOFF, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL, before=SCORING_CUTOFF),
                          order_labels(spark, SF_SMALL), ORDER_SPEC)
    model = fit_ols(total(fold_moments(tt), tt.width), tt.scaler)
    scored = score_table(order_features(spark, SF_SMALL, since=SCORING_CUTOFF), tt.encoder, model)
    assert scored.columns == ["id", "prediction", "unseen_levels"]
    n = order_features(spark, SF_SMALL, since=SCORING_CUTOFF).count()
    assert scored.count() == n
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_linear_program_with_grid(spark):
    from foldwise.plans import programs as PR
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import order_features, order_labels
    from foldwise.spec import FeatureSpec

    spec = FeatureSpec(id="id", nominal=(), numeric=("n1", "n2"))
    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), spec)
    res = PR.linear_sgd_program(tt, model_selection=True, grid_iterations=[50, 100],
                                grid_steps=[0.1, 1.0])
    rep = res.grid_report.orderBy("rank").collect()
    assert len(rep) == 4 and rep[0]["rank"] == 1
    assert (res.params["iterations"], res.params["step"]) == (rep[0]["iterations"], rep[0]["step"])
    report = res.report().collect()
    assert [r.stage for r in report] == ["cv", "training"]
    again = PR.linear_sgd_program(tt, iterations=res.params["iterations"], step=res.params["step"])
    a, b = res.cv.collect()[0], again.cv.collect()[0]
    assert (a.corr, a.mae, a.rmse) == pytest.approx((b.corr, b.mae, b.rmse), rel=1e-12)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and rows[0].corr > 0.99
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70


def test_fold_api_helpers(spark):
    df = K.assign_folds(spark.range(400).select(F.col("id").cast("string").alias("id")), 4)
    pairs = K.fold_pairs(df, 4)
    assert len(pairs) == 4 and all(t.count() + v.count() == 400 for t, v in pairs)
    from foldwise.operators.inspect import show_folds
    out = show_folds(df, 4, rows=3)
    assert out.count() == 4 * 2 * 3
    rnd = K.assign_random_folds(spark.range(2000), 5, seed=3)
    counts = [r["count"] for r in rnd.groupBy("fold").count().collect()]
    assert len(counts) == 5 and min(counts) > 300


def test_split_ranking_on_array(spark):
    from foldwise.operators import splits as SP
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC)
    ranked = SP.best_splits(SP.long_features(tt.df, tt.feature_names)).orderBy(F.desc("gain_ratio")).collect()
    assert ranked[0].feature == "n2" and len(ranked) == tt.width


def test_direct_scaler_equals_one_pass_scaler(spark):
    from foldwise.operators.scale import column_stats
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC)
    row = column_stats(tt.df, tt.width, "f", "label").collect()[0]
    means = [row[f"mean_{i}"] for i in range(tt.width)]
    stds = [row[f"std_{i}"] for i in range(tt.width)]
    assert np.allclose(means, tt.scaler.means, rtol=1e-10, atol=1e-10)
    assert np.allclose(stds, tt.scaler.stds, rtol=1e-9, atol=1e-12)
    assert row["n"] == tt.scaler.n


def test_identical_grid_models_tie_exactly_and_first_wins(spark):
    from foldwise.plans import programs as PR
    from foldwise.plans import select as S
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC)
    fm = S.sgd_fold_models(tt, [100, 200, 300], [1.0], True)
    canon = S.canonical_points(fm)
    assert canon == {0: 0, 1: 0, 2: 0}          # stopped before 100 iterations: one model
    res = PR.linear_sgd_program(tt, model_selection=True, grid_iterations=[100, 200, 300],
                                grid_steps=[1.0])
    rows = res.grid_report.orderBy("grid_pos").collect()
    assert len({(r.corr, r.mae, r.rmse) for r in rows}) == 1
    assert res.params["iterations"] == 100


def test_fold_filters_reach_the_parquet_scan(spark):
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC,
                          skew="salt")
    val = tt.df.filter(F.col("fold") == 3).select("label")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(fold), EqualTo(fold,3)]" in plan
    assert val.count() == tt.df.filter(F.col("fold") == 3).count() > 0


def test_training_table_layout_is_one_file_per_task_clustered_by_fold(spark):
    import os

    from foldwise.session import write_table

    df = K.assign_folds(spark.range(5000).select(F.col("id").cast("string").alias("id")), 10).repartition(4)
    out = write_table(df, "layout-test", cluster_by=("fold",))
    files = [f for f in out.inputFiles()]
    assert files and all("fold=" not in f for f in files)          # no directory per fold
    assert len(files) <= 4                                          # one file per writing task
    path = files[0].replace("file:", "")
    rows = spark.read.parquet(os.path.dirname(path)).count()
    assert rows == 5000


def test_salted_and_default_training_tables_are_equal(spark):
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    def rows(skew):
        tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC,
                              skew=skew)
        return sorted((r.id, r.label, r.fold, tuple(r.f)) for r in tt.df.collect())

    assert rows("salt") == rows("auto")


def test_model_with_encoder_round_trip_scores_identically(spark):
    from foldwise.operators.linear import fit_ols
    from foldwise.operators.moments import total
    from foldwise.plans.score import score_table
    from foldwise.plans.select import fold_moments
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, SCORING_CUTOFF, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL, before=SCORING_CUTOFF),
                          order_labels(spark, SF_SMALL), ORDER_SPEC)
    model = fit_ols(total(fold_moments(tt), tt.width), tt.scaler)
    path = scratch_path(spark, "model-enc")
    assert SK.save_linear_model(spark, model, tt.feature_names, path, tt.encoder.to_json())
    back, enc = SK.load_linear_model(spark, path)
    assert enc.feature_names == tt.feature_names
    later = order_features(spark, SF_SMALL, since=SCORING_CUTOFF)
    a = sorted(tuple(r) for r in score_table(later, tt.encoder, model).collect())
    b = sorted(tuple(r) for r in score_table(later, enc, back).collect())
    assert a == b


def test_scaled_tree_scores_like_its_training_predictions(spark):
    from foldwise.plans import programs as PR
    from foldwise.plans.score import score_table
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    feats = order_features(spark, SF_SMALL)
    tt = prepare_training(feats, order_labels(spark, SF_SMALL), ORDER_SPEC)
    run = PR.tree_program(tt, max_depth=4, max_bins=16, scaled=True)
    trained = {r.id: r.prediction for r in PR.training_predictions(tt, run.model, scaler=tt.scaler).collect()}
    scored = {r.id: r.prediction for r in score_table(feats, tt.encoder, run.model, scaler=tt.scaler).collect()}
    common = set(trained) & set(scored)
    assert len(common) == len(trained) and all(trained[i] == scored[i] for i in common)


@pytest.mark.parametrize("scaled", [False, True])
@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_ml_bundle_round_trip(spark, scaled, kind):
    from foldwise.plans import programs as PR
    from foldwise.plans.score import score_table
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, SCORING_CUTOFF, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL, before=SCORING_CUTOFF),
                          order_labels(spark, SF_SMALL), ORDER_SPEC, n_folds=2)
    run = (PR.tree_program(tt, max_depth=4, max_bins=16, scaled=scaled) if kind == "tree" else
           PR.forest_program(tt, num_trees=3, max_depth=3, scaled=scaled))
    scaler = tt.scaler if scaled else None
    path = scratch_path(spark, "bundle")
    assert SK.save_ml_model(run.model, path, tt.encoder, scaler)
    model, enc, sc = SK.load_model(spark, path)
    assert (sc is not None) == scaled
    later = order_features(spark, SF_SMALL, since=SCORING_CUTOFF)
    a = sorted(map(tuple, score_table(later, tt.encoder, run.model, scaler=scaler).collect()))
    assert a == sorted(map(tuple, score_table(later, enc, model, scaler=sc).collect())) and a


def test_lasso_meets_its_optimality_conditions(spark):
    import numpy as np
    from foldwise.operators.linear import fit_regularised
    from foldwise.plans.training import prepare_training
    from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels

    tt = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC)
    lam = 500.0
    m = fit_regularised(tt.df, lam, 1.0, max_iter=1000)
    pdf = tt.df.toPandas()
    X, y = np.stack(pdf.f.values), pdf.label.values
    sd = X.std(axis=0, ddof=1)
    # gradient of the squared loss in scaled units: lam * sign where a weight is used, less elsewhere
    g = ((X - X.mean(axis=0)) / sd).T @ (y - X @ m.coef - m.intercept) / len(y)
    used = m.coef != 0
    assert 0 < used.sum() < tt.width
    assert np.allclose(g[used], lam * np.sign(m.coef[used]), rtol=0.01, atol=2)
    assert (np.abs(g[~used]) <= lam * 1.01).all()


def test_a_written_table_is_dropped(spark):
    from pathlib import Path

    from foldwise.session import drop_table, write_table

    df = write_table(spark.range(10), "to-drop")
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert folder.is_dir()
    drop_table(df)
    assert not folder.exists()
    drop_table(spark.range(3))
