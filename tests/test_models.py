"""Models against independent implementations, and their properties."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sample_tables import SF_SMALL
from foldwise.operators import splits as SP
from foldwise.operators import trees as TR
from foldwise.operators.linear import fit_ols, fit_sgd, fit_sgd_grid, sgd_path
from foldwise.operators.moments import collect_summaries, fold_summaries, total
from foldwise.plans import programs as PR
from foldwise.plans import select as S
from foldwise.plans.training import prepare_training
from foldwise.sources.tables import ORDER_SPEC, order_features, order_labels
from foldwise.spec import FeatureSpec


@pytest.fixture(scope="module")
def tt(spark):
    return prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC)


def _numpy(tt):
    pdf = tt.df.toPandas()
    return np.stack(pdf.f.values), pdf.label.values, pdf.fold.values


def test_least_squares_matches_ml_normal_solver(spark, tt):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    model = fit_ols(total(S.fold_moments(tt), tt.width), tt.scaler)
    data = tt.df.select(array_to_vector("f").alias("features"), "label")
    ml = LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(data)
    X = np.stack(tt.df.toPandas().f.values)
    ours = X @ model.coef + model.intercept
    theirs = X @ ml.coefficients.toArray() + ml.intercept
    assert np.max(np.abs(ours - theirs)) < 1e-4 * np.max(np.abs(theirs))


def test_least_squares_cv_matches_numpy(spark, tt):
    X, y, fo = _numpy(tt)
    pred = S.score_fold_models(tt, S.ols_fold_models(tt))
    rep = S.point_report(S.fold_metrics(pred)).collect()[0]
    res = []
    for k in range(10):
        tr, va = fo != k, fo == k
        beta = np.linalg.lstsq(np.c_[X[tr], np.ones(tr.sum())], y[tr], rcond=None)[0]
        p = np.floor(np.c_[X[va], np.ones(va.sum())] @ beta + 0.5)
        res.append((np.corrcoef(y[va], p)[0, 1], np.abs(y[va] - p).mean(),
                    np.sqrt(((y[va] - p) ** 2).mean())))
    corr, mae, rmse = np.mean(res, axis=0)
    assert rep.corr == pytest.approx(corr, rel=1e-9)
    assert rep.mae == pytest.approx(mae, rel=1e-9)
    assert rep.rmse == pytest.approx(rmse, rel=1e-9)


def _moments(df, scaler):
    return {k: s.moments(scaler) for k, s in collect_summaries(fold_summaries(df, scaler.width)).items()}


def test_moments_and_partitioning_agree(spark, tt):
    base = _moments(tt.df, tt.scaler)
    X, y, fo = _numpy(tt)
    for k, m in base.items():
        Z = (X[fo == k] - tt.scaler.means) / np.where(tt.scaler.stds > 0, tt.scaler.stds, np.inf)
        U = np.c_[Z, np.ones(len(Z))]
        assert np.allclose(m.G, U.T @ U, rtol=1e-9, atol=1e-7)
    plan = fold_summaries(tt.df, tt.width)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    for df in (tt.df.repartition(1), tt.df.repartition(17)):
        other = _moments(df, tt.scaler)
        for k in base:
            assert np.allclose(base[k].G, other[k].G, rtol=1e-9, atol=1e-7)
            assert np.allclose(base[k].h, other[k].h, rtol=1e-9, atol=1e-4)


def _numpy_sgd(X, y, iterations, step):
    A = np.c_[X, np.ones(len(y))]
    w = np.zeros(A.shape[1]); w[-1] = 1.0
    prev = None
    for i in range(1, iterations + 1):
        g = A.T @ (A @ w - y) / len(y)
        w = w - step / np.sqrt(i) * g
        if prev is not None and np.linalg.norm(prev - w) < 1e-3 * max(np.linalg.norm(w), 1.0):
            return w, i
        prev = w.copy()
    return w, iterations


def test_sgd_matches_row_level_descent(spark, tt):
    """Moments-based descent equals descent over the rows (scaled features)."""
    pdf = tt.scaler.transform(tt.df).toPandas()
    Z, y = np.stack(pdf.f.values), pdf.label.values
    m = total(S.fold_moments(tt), tt.width)
    for its, step in ((200, 1.0), (50, 0.1), (30, 1e-3)):
        w, ran = _numpy_sgd(Z, y, its, step)
        model = fit_sgd(m, tt.scaler, its, step, scaled=True)
        assert model.iterations == ran
        X = np.stack(tt.df.toPandas().f.values)
        p_ours = X @ model.coef + model.intercept
        p_ref = np.c_[Z, np.ones(len(y))] @ w
        assert np.allclose(p_ours, p_ref, rtol=1e-8, atol=1e-6)


def test_sgd_grid_snapshots_equal_single_runs(spark, tt):
    m = total(S.fold_moments(tt), tt.width)
    grid = fit_sgd_grid(m, tt.scaler, [10, 20, 40], [0.01, 1.0], scaled=True)
    for (its, step), model in grid.items():
        one = fit_sgd(m, tt.scaler, its, step, scaled=True)
        assert np.allclose(model.coef, one.coef) and model.intercept == pytest.approx(one.intercept)


def test_sgd_path_stops_early():
    G = np.array([[30.0, 3.0], [3.0, 10.0]])
    h = np.array([5.0, 7.0])
    out = sgd_path(G, h, [5, 500], 0.2)
    stop = out[500][1]
    assert 5 < stop < 500 and out[5][1] == 5
    assert not np.allclose(out[5][0], out[500][0])


def test_sgd_matches_mllib(spark):
    """One small comparison with MLlib's own gradient descent (slow, so small data)."""
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 2))
    y = 3.0 + X @ np.array([2.0, -1.0]) + rng.normal(scale=0.1, size=400)
    rows = [(str(i), float(y[i]), [float(a) for a in X[i]]) for i in range(len(y))]
    df = spark.createDataFrame(rows, "id string, label double, f array<double>").withColumn("fold", F.lit(0))
    from foldwise.operators.scale import Scaler
    sc = Scaler(np.zeros(2), np.ones(2), len(y), 0.0)   # identity: descend on the raw columns
    m = _moments(df, sc)[0]
    ours = fit_sgd(m, sc, 60, 0.5, scaled=False)
    rdd = spark.sparkContext.parallelize([LabeledPoint(r[1], r[2]) for r in rows], 4)
    ref = LinearRegressionWithSGD.train(rdd, iterations=60, step=0.5, intercept=True)
    assert np.allclose(ours.coef, ref.weights.toArray(), atol=1e-9)
    assert ours.intercept == pytest.approx(ref.intercept, abs=1e-9)


def test_depth_one_tree_matches_best_split(spark, tt):
    from pyspark.ml.functions import array_to_vector

    j = tt.df.select(F.col("f")[tt.feature_names.index("n1")].alias("n1"), "label")
    long = SP.long_columns(j, ["n1"])
    best = SP.best_splits(long).collect()[0]
    est = TR.tree_estimator(1, 512)
    model = est.fit(j.select(array_to_vector(F.array("n1")).alias("features"), "label"))
    node = model._call_java("rootNode")
    thr = node.split().threshold()
    assert thr == pytest.approx(best.threshold)


def test_best_splits_blocked_equals_single_block(spark, tt):
    j = tt.df.select(F.col("f")[tt.feature_names.index("n2")].alias("n2"),
                     F.col("f")[tt.feature_names.index("n4")].alias("n4"), "label")
    long = SP.long_columns(j, ["n2", "n4"])
    one = {r.feature: r for r in SP.best_splits(long).collect()}
    many = {r.feature: r for r in SP.best_splits(long, rows_per_block=97).collect()}
    for f in one:
        assert one[f].threshold == pytest.approx(many[f].threshold)
        assert one[f].n_left == many[f].n_left
        assert one[f].gain == pytest.approx(many[f].gain, rel=1e-9)


def test_tree_properties(spark, tt):
    res = PR.tree_program(tt, max_depth=5, max_bins=16)
    again = PR.tree_program(tt, max_depth=5, max_bins=16)
    a = res.cv.collect()[0]
    b = again.cv.collect()[0]
    assert a.corr == pytest.approx(b.corr) and a.mae == pytest.approx(b.mae)
    assert res.model.depth <= 5
    tr = res.training.collect()[0]
    std = tt.df.agg(F.stddev_pop("label")).collect()[0][0]
    assert tr.rmse < std
    from foldwise.plans.score import predictions
    p = predictions(tt.df, res.model, rounded=False).agg(F.min("raw_prediction"), F.max("raw_prediction")).collect()[0]
    lo, hi = tt.df.agg(F.min("label"), F.max("label")).collect()[0]
    assert lo <= p[0] and p[1] <= hi


def test_forest_runs_and_is_seeded(spark, tt):
    a = PR.forest_program(tt, num_trees=3, max_depth=4).cv.collect()[0]
    b = PR.forest_program(tt, num_trees=3, max_depth=4).cv.collect()[0]
    assert a.rmse == pytest.approx(b.rmse)


def test_one_feature_spec_excludes_nominals(spark):
    spec = FeatureSpec(id="id", nominal=(), numeric=("n2",))
    t = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), spec,
                         materialize=False)
    assert t.width == 1


def test_cv_results_do_not_depend_on_partitioning(spark, tt):
    from foldwise.plans.training import TrainingTable

    def cv(table):
        pred = S.score_fold_models(table, S.ols_fold_models(table))
        return S.point_report(S.fold_metrics(pred)).collect()[0]

    base = cv(tt)
    for parts in (1, 17):
        other = TrainingTable(tt.df.repartition(parts), tt.encoder, tt.n_folds, tt.spec)
        got = cv(other)
        assert got.corr == pytest.approx(base.corr, rel=1e-9)
        assert got.mae == pytest.approx(base.mae, rel=1e-9)
        assert got.rmse == pytest.approx(base.rmse, rel=1e-9)


def _brute_tree(X, y, depth):
    """Exhaustive regression tree: every midpoint threshold, best variance reduction, first best wins."""
    def build(idx, level):
        ys = y[idx]
        if level == depth or len(idx) < 2 or np.all(ys == ys[0]):
            return ("leaf", ys.mean())
        n = len(idx)
        best = (0.0, None, None)
        for j in range(X.shape[1]):
            xs = X[idx, j]
            values = np.unique(xs)
            for a, b in zip(values[:-1], values[1:]):
                t = (a + b) / 2
                left = xs <= t
                nl, nr = left.sum(), n - left.sum()
                gain = nl * nr / (n * n) * (ys[left].mean() - ys[~left].mean()) ** 2
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, j, t)
        if best[1] is None:
            return ("leaf", ys.mean())
        _, j, t = best
        left = X[idx, j] <= t
        return ("split", j, t, build(idx[left], level + 1), build(idx[~left], level + 1))

    def predict(node, row):
        while node[0] == "split":
            node = node[3] if row[node[1]] <= node[2] else node[4]
        return node[1]

    root = build(np.arange(len(y)), 0)
    return np.array([predict(root, r) for r in X])


def test_tree_matches_brute_force(spark, tt):
    """Depth-3 tree on two order columns; every distinct value is a candidate for both."""
    from pyspark.ml.functions import array_to_vector

    i1, i3 = tt.feature_names.index("n1"), tt.feature_names.index("n3")
    df = tt.df.select(F.array(F.col("f")[i1], F.col("f")[i3]).alias("x"), "label").toPandas()
    X, y = np.stack(df.x.values), df.label.values
    assert max(len(np.unique(X[:, 0])), len(np.unique(X[:, 1]))) < 511
    data = spark.createDataFrame([(list(map(float, r)), float(v)) for r, v in zip(X, y)],
                                 "x array<double>, label double").repartition(1)
    model = TR.tree_estimator(3, 512).fit(data.select(array_to_vector("x").alias("features"), "label"))
    got = np.array([r.prediction for r in model.transform(
        data.select(array_to_vector("x").alias("features"), "label")).collect()])
    X2 = np.stack(data.toPandas().x.values)
    y2 = np.array([r.label for r in data.collect()])
    want = _brute_tree(X2, y2, 3)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-6)


def test_lasso_zeroes_weak_features(spark, tt):
    from foldwise.operators.linear import fit_regularised

    ridge = fit_regularised(tt.df, reg_param=1000.0, l1_ratio=0.0)
    lasso = fit_regularised(tt.df, reg_param=1000.0, l1_ratio=1.0)
    assert np.count_nonzero(ridge.coef) == tt.width
    assert 0 < np.count_nonzero(lasso.coef) < tt.width
    assert lasso.coef[tt.feature_names.index("n2")] != 0.0   # the informative column survives


def test_fused_pass_equals_separate_passes(spark, tt):
    """CV + training metrics from one scoring pass equal the separately computed ones."""
    from foldwise.operators.metrics import regression_metrics
    from foldwise.plans.score import training_error

    for rounded, average in ((False, "pooled"), (True, "macro")):
        res = PR.least_squares_program(tt, rounded=rounded, average=average)
        cv, tr = res.cv.collect()[0], res.training.collect()[0]
        pred = res.extras["predictions"]
        if average == "pooled":
            ref = regression_metrics(pred).collect()[0]
        else:
            ref = S.point_report(S.fold_metrics(pred)).collect()[0]
        ref_tr = training_error(tt, res.model, rounded).collect()[0]
        assert (cv.corr, cv.mae, cv.rmse) == pytest.approx((ref.corr, ref.mae, ref.rmse), rel=1e-12)
        assert (tr.corr, tr.mae, tr.rmse) == pytest.approx((ref_tr.corr, ref_tr.mae, ref_tr.rmse), rel=1e-12)


def test_scoring_pass_plan_shape(spark, tt):
    """One scan of (label, f, fold), a broadcast join on fold, partial aggregation, no Python."""
    fm = S.sgd_fold_models(tt, [100, 200], [0.1, 1.0], True)
    metrics = S.fold_metrics(S.score_fold_models(tt, fm))
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan
    assert "partial_covar_pop" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    read = scans[0][scans[0].index("[") + 1:scans[0].index("]")]
    assert sorted(c.split("#")[0] for c in read.split(",")) == ["f", "fold", "label"]


@pytest.mark.parametrize("width", [100, 300, 512, 513, 2000])
def test_linear_scoring_at_every_width(spark, width):
    """Predict, fold models, refit and training error with the one form, on default JVM settings."""
    from foldwise.operators.encode import Encoder
    from foldwise.operators.linear import LinearModel
    from foldwise.plans.score import linear_predictions, training_error
    from foldwise.plans.training import TrainingTable

    rng = np.random.default_rng(width)
    X = rng.normal(size=(12, width))
    coef = rng.normal(size=width)
    y = X @ coef + 3.0
    df = spark.createDataFrame([(str(i), float(y[i]), X[i].tolist(), i % 2) for i in range(12)],
                               "id string, label double, f array<double>, fold int")
    spec = FeatureSpec(id="id", nominal=(), numeric=tuple(f"x{i}" for i in range(width)), label="label")
    t = TrainingTable(df, Encoder(spec, {}), 2, spec)
    model = LinearModel(coef, 3.0)
    got = {r.id: r.raw_prediction for r in linear_predictions(df, model).collect()}
    assert np.allclose([got[str(i)] for i in range(12)], y)
    assert training_error(t, model, rounded=False).collect()[0].mae < 1e-9
    fm = S.FoldModels({(0, 0): model, (0, 1): LinearModel(2 * coef, 6.0)}, {0: ()}, width)
    raw = {r.id: r.raw_prediction for r in S.score_fold_models(t, fm, rounded=False).collect()}
    assert np.allclose([raw[str(i)] for i in range(12)], [y[i] * (1 + i % 2) for i in range(12)])
    both = S.score_with_refit(t, fm, model, rounded=False).filter(F.col("fold") == S.REFIT).collect()
    assert len(both) == 12 and np.allclose([r.raw_prediction for r in both], [r.label for r in both])


@pytest.mark.parametrize("width", [3, 12])
@pytest.mark.parametrize("single", [True, False])
@pytest.mark.parametrize("column", ["id", "label"])
def test_null_id_or_label_raises_alike(spark, width, single, column):
    spec = FeatureSpec(id="id", nominal=(), numeric=tuple(f"x{i}" for i in range(width)), label="label")
    rows = [(None if column == "id" and i % 4 == 0 else f"r{i}", *[float(i * k % 7) for k in range(width)],
             None if column == "label" and i % 4 == 0 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"x{i} double" for i in range(width))
                               + ", label double")
    with pytest.raises(Exception, match=f"column {column} holds a null"):
        t = (prepare_training(df, None, spec) if single else
             prepare_training(df.drop("label"), df.select("id", "label"), spec))
        S.fold_moments(t)


def test_tree_grid_by_depth_equals_separate_fits(spark, tt):
    depths, bins = [2, 4, 5, 9], [16, 24]
    make = lambda d, b, leaf="": TR.tree_estimator(d, b, leaf_col=leaf)
    one = S.tree_depth_metrics(tt, lambda d, b: make(d, b, "leaf"), depths, bins)
    points = {i * len(bins) + j: (d, b) for i, d in enumerate(depths) for j, b in enumerate(bins)}
    many = S.estimator_grid_metrics(tt, make, points)
    a, b = ({(r.grid_pos, r.fold): (r.n, r.corr, r.mae, r.rmse) for r in x.collect()} for x in (one, many))
    assert set(a) == set(b) and len(a) == len(points) * tt.n_folds
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9)


def test_trees_do_not_depend_on_layout_or_memory(spark, tt):
    import dataclasses

    other = dataclasses.replace(tt, df=tt.df.repartition(7).orderBy(F.desc("label")))
    for run in (lambda t, m: PR.tree_program(t, max_depth=5, max_bins=16, memory_mb=m),
                lambda t, m: PR.forest_program(t, num_trees=4, max_depth=4)):
        x, y = (run(t, m).report().collect() for t, m in ((tt, 64), (other, 8)))
        for r, s in zip(x, y):
            assert (r.corr, r.mae, r.rmse) == pytest.approx((s.corr, s.mae, s.rmse), rel=1e-9)


def test_fold_scope_scaling_uses_training_rows_only(spark, tt):
    X, y, fo = _numpy(tt)
    for k, (scaler, m) in tt.fold_scaled_training().items():
        tr = X[fo != k]
        assert np.allclose(scaler.means, tr.mean(axis=0)) and scaler.n == len(tr)
        assert np.allclose(scaler.stds, tr.std(axis=0, ddof=1), atol=1e-9)
        assert m.n == pytest.approx(len(tr))
    table = PR.linear_sgd_program(tt).report().collect()[0]
    fold = PR.linear_sgd_program(tt, scale_scope="fold").report().collect()[0]
    assert table.mae != fold.mae and table.mae == pytest.approx(fold.mae, rel=0.05)
    with pytest.raises(ValueError):
        PR.linear_sgd_program(tt, scale_scope="row")


def _walk(nodes, x, depth):
    """Prediction of a saved tree (rows by node id) cut at ``depth``."""
    at = 0
    for _ in range(depth):
        n = nodes[at]
        if n["leftChild"] < 0:
            break
        feature, threshold = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
        at = n["leftChild"] if x[feature] <= threshold else n["rightChild"]
    return nodes[at]["prediction"]


def test_forest_grid_points_are_first_trees_cut_at_a_depth(spark, tt, tmp_path):
    trees, depths = [2, 5], [2, 3, 6]
    make = lambda t, d, leaf="leaf": TR.forest_estimator(t, d, seed=7, leaf_col=leaf)
    got = {(r["grid_pos"], r["fold"]): r for r in S.forest_prefix_metrics(tt, make, trees, depths, rounded=False).collect()}
    assert len(got) == 6 * tt.n_folds
    with S.estimator_rows(tt) as data:
        model = make(5, 6).fit(data.filter("fold <> 3"))
        model.write().save(f"{tmp_path}/forest")
        val = [(r["label"], r["features"].toArray()) for r in data.filter("fold = 3").collect()]
    nodes = [{} for _ in range(5)]
    for r in spark.read.parquet(f"{tmp_path}/forest/data").collect():
        nodes[r["treeID"]][r["nodeData"]["id"]] = r["nodeData"]
    y = np.array([v[0] for v in val])
    for i, t in enumerate(trees):
        for j, d in enumerate(depths):
            p = np.array([np.mean([_walk(nodes[k], x, d) for k in range(t)]) for _, x in val])
            m = got[(i * len(depths) + j, 3)]
            assert m["n"] == len(y)
            assert m["mae"] == pytest.approx(np.abs(y - p).mean(), rel=1e-9)
            assert m["corr"] == pytest.approx(np.corrcoef(y, p)[0, 1], rel=1e-9)


def test_bag_weights_are_poisson_and_depend_on_the_id_alone(spark):
    ids = spark.range(20_000)
    rows = ids.select("id", *[TR.bag_weight("id", t, 5).alias(f"w{t}") for t in range(3)])
    a = sorted(tuple(r) for r in rows.collect())
    assert a == sorted(tuple(r) for r in rows.repartition(13).collect())
    w = np.array(a)[:, 1:]
    for k in range(3):
        assert abs(w[:, k].mean() - 1) < .03 and abs(w[:, k].var() - 1) < .06
        for n, want in enumerate((.3679, .3679, .1839, .0613)):
            assert abs((w[:, k] == n).mean() - want) < .015
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < .03


def test_partitions_of_large_tables_hold_more_rows():
    # as before up to 64 partitions; then at most 64 until one holds 400,000 rows
    assert [TR.layout_partitions(n) for n in (0, 1, 20_000, 20_001, 900_000, 1_280_000)] == [1, 1, 1, 2, 45, 64]
    assert [TR.layout_partitions(n) for n in (1_280_001, 9_000_000, 25_600_000, 54_000_000)] == [64, 64, 64, 135]


def test_deep_forests_of_large_tables_have_few_partitions():
    # every partition sends all nodes: up to 8 partitions as before, then 8 until one holds 400,000 rows
    rows = (0, 20_001, 160_000, 160_001, 883_416, 3_200_001, 54_000_000)
    assert [TR.forest_partitions(n, 18) for n in rows] == [1, 2, 8, 8, 8, 9, 135]
    assert all(TR.forest_partitions(n, d) == TR.layout_partitions(n) for n in rows for d in (3, 6))


def test_forest_fits_read_the_forest_layout(spark, tt, monkeypatch):
    seen = []
    monkeypatch.setattr(PR, "forest_partitions", lambda n, d: seen.append((n, d)) or 3)
    held = S.estimator_rows

    def rows(*args, **kwargs):
        seen.append(args[2:] or kwargs.get("partitions"))
        return held(*args, **kwargs)

    monkeypatch.setattr(S, "estimator_rows", rows)
    PR.forest_program(tt, num_trees=2, max_depth=4)
    assert seen == [(tt.n_rows, 4), (3,)]   # the refit is one of the fits on the same rows
    seen.clear()
    PR.forest_program(tt, model_selection=True, trees=[1, 2], depths=[2, 3])
    assert seen == [(tt.n_rows, 3), (3,), (3,)]


@pytest.mark.parametrize("parallelism", [1, 4])
def test_refit_beside_the_folds_is_the_model_of_all_rows(spark, tt, parallelism):
    make = lambda t, d: TR.forest_estimator(t, d, seed=7)
    per_fold, model = S.estimator_cv_and_refit(tt, make, (3, 4), parallelism)
    with S.estimator_rows(tt) as data:
        alone = make(3, 4).fit(data)
    assert model.toDebugString.split("\n")[1:] == alone.toDebugString.split("\n")[1:]
    want = S.estimator_grid_metrics(tt, make, {0: (3, 4)}, parallelism)
    assert sorted(map(tuple, per_fold.collect())) == sorted(map(tuple, want.collect()))


def test_forests_of_few_levels_cache_no_node_ids(spark, tt):
    assert [TR.forest_estimator(2, d).getCacheNodeIds() for d in (3, 6, 7, 18)] == [False, False, True, True]
    with S.estimator_rows(tt) as data:
        rows = data.filter("fold < 5")
        one, other = (TR.forest_estimator(3, 4, seed=5).setCacheNodeIds(c).fit(rows) for c in (False, True))
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]


def test_row_bags_do_not_depend_on_layout(spark, tt):
    with S.estimator_rows(tt) as data:
        rows = data.filter("fold < 5")
        one = TR.BaggedForest(3, 3, 512, subset="all").fit(rows)
        # the rows of an id in another order and in other partitions
        other = TR.BaggedForest(3, 3, 512, subset="all").fit(rows.repartition(9, "label"))
        p, q = ({r["id"]: r["prediction"] for r in m.transform(data).select("id", "prediction").collect()}
                for m in (one, other))
    assert p.keys() == q.keys() and all(p[k] == pytest.approx(q[k], rel=1e-9) for k in p)
    with pytest.raises(ValueError):
        PR.forest_program(tt, bags="row", model_selection=True)


@pytest.mark.parametrize("kind", ["ridge", "lasso"])
def test_penalised_descent_matches_mllib(spark, kind):
    from pyspark.mllib.regression import LabeledPoint, LassoWithSGD, RidgeRegressionWithSGD

    rnd = np.random.default_rng(3)
    X = rnd.normal(size=(300, 3))
    y = 4 * X[:, 0] - 2 * X[:, 1] + .01 * X[:, 2] + 7 + rnd.normal(size=300)
    rdd = spark.sparkContext.parallelize([LabeledPoint(b, a) for a, b in zip(X.tolist(), y.tolist())], 2)
    trainer = RidgeRegressionWithSGD if kind == "ridge" else LassoWithSGD
    want = trainer.train(rdd, iterations=60, step=0.5, regParam=0.2, intercept=True)
    u = np.column_stack([X, np.ones(300)])
    w, _ = sgd_path(u.T @ u, u.T @ y, [60], 0.5, penalty="l2" if kind == "ridge" else "l1", reg=0.2)[60]
    assert w[:3] == pytest.approx(want.weights.toArray(), abs=1e-9)
    assert w[3] == pytest.approx(want.intercept, abs=1e-9)
    if kind == "lasso":
        assert w[2] == 0.0


def test_penalty_arguments_are_checked(tt):
    for bad in ({"penalty": "l3", "reg": 1.0}, {"penalty": "l1", "reg": -1.0}, {"reg": 1.0}):
        with pytest.raises(ValueError):
            sgd_path(np.eye(2), np.ones(2), [1], 1.0, **bad)


def test_penalised_grid_refits_its_best_point(tt):
    res = PR.penalised_program(tt, [("l1", 1e7), (None, 0.0), ("l2", 0.3)])
    rows = {r["grid_pos"]: r for r in res.grid_report.collect()}
    assert rows[1]["penalty"] == "none" and rows[0]["corr"] is None and rows[0]["rank"] == 3
    best = min(rows.values(), key=lambda r: r["rank"])
    assert (res.params["penalty"] or "none") == best["penalty"]
    plain = PR.linear_sgd_program(tt)
    cv = plain.cv.collect()[0]
    assert rows[1]["mae"] == pytest.approx(cv["mae"], rel=1e-9)


def test_balanced_folds(spark, monkeypatch):
    from foldwise.operators import folds as K

    # an id with a third of the rows, groups of equal rows, a null id
    rows = [(7, f"x{i % 211}", i) for i in range(400)] + [(9, "same", 1)] * 150 + [(i + 100, "u", i) for i in range(700)]
    rows += [(None, "n", 1), (None, "m", 2), (7, "x1", 1)]
    df = spark.createDataFrame(rows, "id long, a string, n int")
    want = None
    for parts in (1, 4, 17):
        got = sorted(map(str, K.assign_balanced_folds(df.repartition(parts), 7).collect()))
        want = want or got
        assert got == want and len(got) == len(rows)
    out = K.assign_balanced_folds(df, 7)
    assert sorted(map(str, out.drop("fold").collect())) == sorted(map(str, df.collect()))
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    hot = [r["count"] for r in out.filter("id = 7").groupBy("fold").count().collect()]
    assert max(hot) - min(hot) <= 1
    assert sorted(map(str, K.assign_balanced_folds(df, 7, seed=2).collect())) != want
    monkeypatch.setattr(K, "ROW_BLOCKS", 3)
    monkeypatch.setattr(K, "BLOCK_DIGITS", 1)
    assert [r["count"] for r in K.assign_balanced_folds(df, 7).groupBy("fold").count().collect()].count(sizes[0]) > 0
    assert K.assign_balanced_folds(df.filter("n < 0"), 7).count() == 0


def test_training_table_with_balanced_folds(spark):
    t = prepare_training(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC, folds="balanced")
    sizes = [r["count"] for r in t.df.groupBy("fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    assert PR.least_squares_program(t).cv.collect()[0]["corr"] > .99


def test_bagged_forest_round_trip(spark, tt, tmp_path):
    from foldwise.plans.score import predictions
    from foldwise.sources.sinks import load_model, save_ml_model

    with S.estimator_rows(tt) as data:
        model = TR.BaggedForest(2, 3).fit(data)
    assert save_ml_model(model, f"{tmp_path}/bagged", tt.encoder)
    assert not save_ml_model(model, f"{tmp_path}/bagged", tt.encoder)
    back, enc, scaler = load_model(spark, f"{tmp_path}/bagged")
    assert scaler is None and enc.levels == tt.encoder.levels
    a, b = (sorted(map(str, predictions(tt.df, m, rounded=False).collect())) for m in (model, back))
    assert a == b


def test_deep_trees_cache_node_ids_and_stay_the_same(spark):
    """Beyond ROUTED_TREE_DEPTH a tree caches node ids; the tree is the one that routing grows."""
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(600).select(
        "id", (F.col("id") * 7919 % 601).cast("double").alias("label"),
        array_to_vector(F.array((F.col("id") * 31 % 97).cast("double"), (F.col("id") * 17 % 53).cast("double"),
                                (F.col("id") % 2).cast("double"))).alias("features")).repartition(3, "id").cache()
    assert not TR.tree_estimator(TR.ROUTED_TREE_DEPTH, 16).getCacheNodeIds()
    deep = TR.tree_estimator(TR.ROUTED_TREE_DEPTH + 4, 16)
    assert deep.getCacheNodeIds()
    a, b = deep.fit(rows), deep.copy().setCacheNodeIds(False).fit(rows)
    assert a.depth > TR.ROUTED_TREE_DEPTH and a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]
    rows.unpersist()


def test_registered_tree_grid_holds_every_bin_count(spark, monkeypatch):
    """The registered grid is the program's: each depth at each of its bin counts."""
    from foldwise import registry as R
    from foldwise.plans import grid as G

    rows = [(str(i), float(i % 7), float(i * 31 % 97), i * 13 % 89 + i % 7 * 5.0) for i in range(120)]
    tiny = prepare_training(spark.createDataFrame(rows, "id string, n1 double, n2 double, label double"), None,
                            FeatureSpec("id", (), ("n1", "n2"), "label"))
    monkeypatch.setattr(R, "_tt", lambda *a: tiny)
    monkeypatch.setattr(G, "TREE_DEPTHS", [1, 2])
    got = {(r.max_depth, r.max_bins) for r in R.m11_tree_grid(spark, "").collect()}
    assert got == {(d, b) for d in [1, 2] for b in G.TREE_BINS}


def test_trees_grown_in_a_task_are_the_estimators(spark, monkeypatch):
    """A table that a task can hold takes no estimator fit; the trees are the estimators', also where split
    candidates come from a sample (more than 10,000 training rows) and with repeated rows."""
    x = F.col("i")
    rows = spark.range(26_000).select((F.col("id") % 25_000).alias("i")).select(
        x.cast("string").alias("id"), (x * 7919 % 10_007).cast("double").alias("n1"), (x * 31 % 13).cast("double").alias("n2"),
        (x * 48_271 % 997 - 300.5).alias("n3"), (x * 613 % 4001 * (x % 5) + x * 7 % 311 / 7).alias("label"))
    tt = prepare_training(rows, None, FeatureSpec("id", (), ("n1", "n2", "n3"), "label"), n_folds=2)
    depths, bins = [1, 6, 17], [8, 33]
    make = lambda d, b: TR.tree_estimator(d, b, leaf_col="leaf")
    monkeypatch.setattr(S, "tree_rows", lambda df, n, **k: TR.tree_rows(df, n, partitions=1))
    want = S.tree_depth_metrics(tt, make, depths, bins, parallelism=2).collect()
    monkeypatch.setattr(S, "estimator_rows", None)
    got = S.tree_depth_metrics(tt, make, depths, bins).collect()
    a, b = ({(r.grid_pos, r.fold): (r.n, r.corr, r.mae, r.mse, r.rmse) for r in x} for x in (got, want))
    assert set(a) == set(b) and len(a) == len(depths) * len(bins) * 2
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9)


def test_row_bags_are_fitted_on_groups_of_equal_features(spark, monkeypatch):
    """Rows that agree in fold and features reach a bagged forest as one, with the trees of the rows."""
    from pyspark.ml.functions import array_to_vector

    x = F.col("id")
    rows = spark.range(4000).select(x.cast("string").alias("id"), (x % 4).cast("double").alias("n1"),
                                    (x * 7 % 5).cast("double").alias("n2"), (x % 4 * 50 + x * 7 % 5 * 9 + x * 31 % 17).alias("y"))
    tt = prepare_training(rows.withColumn("label", F.col("y").cast("double")).drop("y"), None,
                          FeatureSpec("id", (), ("n1", "n2"), "label"), n_folds=3)
    with S.estimator_rows(tt) as data:
        alone = TR.BaggedForest(3, 3, 64, subset="all").fit(data)
    sizes = []
    fit = TR.BaggedForest.fit
    monkeypatch.setattr(TR.BaggedForest, "fit", lambda self, df: sizes.append(df.count()) or fit(self, df))
    per_fold, model = S.estimator_cv_and_refit(tt, lambda t, d: TR.BaggedForest(t, d, 64, subset="all"), (3, 3))
    assert len(sizes) == 4 and max(sizes) <= 3 * 20
    every = tt.df.select("id", array_to_vector("f").alias("features"))
    a, b = ([r.prediction for r in m.transform(every).orderBy("id").collect()] for m in (alone, model))
    assert a == pytest.approx(b, rel=1e-9)
    assert {r.fold: r.n for r in per_fold.collect()} == {r.fold: r["count"] for r in tt.df.groupBy("fold").count().collect()}


def test_deep_forests_of_large_tables_grow_in_tasks(spark, monkeypatch):
    """Deep forests of large tables take a task per fold, no estimator fit, and predict as well as the estimator's."""
    x = F.col("id")
    rows = spark.range(6000).select(x.cast("string").alias("id"), (x * 7919 % 1009).cast("double").alias("n1"),
                                    (x * 31 % 13).cast("double").alias("n2"), (x * 613 % 97).cast("double").alias("n3"),
                                    (x * 7919 % 1009 + x * 31 % 13 * (x * 613 % 97) + x * 11 % 7).cast("double").alias("label"))
    tt = prepare_training(rows, None, FeatureSpec("id", (), ("n1", "n2", "n3"), "label"), n_folds=3)
    make = lambda t, d: TR.forest_estimator(t, d, leaf_col="leaf")
    trees, depths = [1, 3, 8], [4, 9]
    want = {(r.grid_pos, r.fold): r for r in S.forest_prefix_metrics(tt, make, trees, depths).collect()}
    cv = S.estimator_cv_and_refit(tt, make, (8, 9))[0].collect()
    monkeypatch.setattr(S, "layout_partitions", lambda n: 9)
    fits, fit = [], type(make(2, 9)).fit
    monkeypatch.setattr(type(make(2, 9)), "fit", lambda self, df: fits.append(1) or fit(self, df))
    got = {(r.grid_pos, r.fold): r for r in S.forest_prefix_metrics(tt, make, trees, depths, partitions=2).collect()}
    assert not fits and set(got) == set(want)
    again = S.forest_prefix_metrics(tt, make, trees, depths, partitions=2).collect()
    assert {(r.grid_pos, r.fold): r for r in again} == got
    assert all(got[k].n == r.n for k, r in want.items())
    one, other = (np.mean([x[(5, k)].rmse for k in range(3)]) for x in (got, want))  # eight trees of depth 9
    assert one == pytest.approx(other, rel=0.35)
    other, model = S.estimator_cv_and_refit(tt, make, (8, 9), partitions=2)
    assert len(fits) == 1 and model.getNumTrees == 8
    assert {r.fold: r.rmse for r in other.collect()} == {r.fold: got[(5, r.fold)].rmse for r in cv}
