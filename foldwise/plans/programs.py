"""The four end-to-end jobs: gradient-descent linear model, regression tree,
random forest, and least squares with pooled cross-validation.

Each returns DataFrames (grid report, cross-validated metrics, training
metrics, a ``stage, corr, mae, rmse`` report, per-id training predictions) and
the fitted model; printing and saving are left to the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..operators.linear import LinearModel, fit_ols, fit_sgd
from ..operators.metrics import macro_average, regression_metrics
from ..operators.moments import total
from ..operators.trees import (DEFAULT_SEED, FOREST_MEMORY_MB, TREE_MEMORY_MB, BaggedForest, forest_estimator,
                               forest_partitions, tree_estimator)
from ..operators.wide import REFIT, coded_predictions, wide_least_squares
from . import grid as G
from . import select as S
from .score import predictions, training_error
from .training import CodedTable, TrainingTable


@dataclass
class RunResult:
    params: dict
    cv: DataFrame                 # folds, corr, mae, rmse (one row)
    training: DataFrame           # n, corr, mae, mse, rmse (one row)
    model: object
    grid_report: DataFrame | None = None
    extras: dict = field(default_factory=dict)

    def report(self) -> DataFrame:
        """``stage, corr, mae, rmse`` for the cross-validation and the training rows."""
        cv = self.cv.select(F.lit("cv").alias("stage"), "corr", "mae", "rmse")
        tr = self.training.select(F.lit("training").alias("stage"), "corr", "mae", "rmse")
        return cv.unionByName(tr)


def _cv_row(per_fold: DataFrame) -> DataFrame:
    return macro_average(per_fold.drop("grid_pos"))


def _chosen_cv(spark, best: dict) -> DataFrame:
    """The cross-validated row of the chosen grid point, as a one-row frame."""
    return spark.createDataFrame([(best["folds"], best["corr"], best["mae"], best["rmse"])],
                                 "folds int, corr double, mae double, rmse double")


def linear_sgd_program(tt: TrainingTable, scaled: bool = True, model_selection: bool = False,
                       iterations: int = G.LINEAR_DEFAULT[0], step: float = G.LINEAR_DEFAULT[1],
                       grid_iterations: list[int] | None = None,
                       grid_steps: list[float] | None = None,
                       scale_scope: str = "table") -> RunResult:
    spark = tt.df.sparkSession
    per_fold = S.fold_moments(tt)
    report = None
    if model_selection:
        its = grid_iterations or G.LINEAR_ITERATIONS
        sts = grid_steps or G.LINEAR_STEPS
        fm = S.sgd_fold_models(tt, its, sts, scaled, per_fold, scale_scope)
        params = S.as_params_frame(spark, fm.params, ("iterations", "step"), ("int", "double"))
        report = S.point_report(S.grid_fold_metrics(tt, fm), params)
        best = S.best_point(report)
        iterations, step = int(best["iterations"]), float(best["step"])
        # same folds, deterministic fits: the chosen point's CV is already in the report
        cv = _chosen_cv(spark, best)
        model = fit_sgd(total(per_fold, tt.width), tt.scaler, iterations, step, scaled)
        training = training_error(tt, model)
    else:
        fm = S.sgd_fold_models(tt, [iterations], [step], scaled, per_fold, scale_scope)
        model = fit_sgd(total(per_fold, tt.width), tt.scaler, iterations, step, scaled)
        cv, training = _cv_and_training(tt, fm, model, rounded=True, average="macro")
    return RunResult({"iterations": iterations, "step": step, "scaled": scaled}, cv,
                     training, model, report)


def penalised_program(tt: TrainingTable, penalties: list[tuple[str | None, float]],
                      iterations: int = G.LINEAR_DEFAULT[0], step: float = G.LINEAR_DEFAULT[1],
                      scaled: bool = True) -> RunResult:
    """Ridge (``"l2"``) and lasso (``"l1"``) by descent: cross-validates every (penalty, strength) in
    one scoring pass and refits the best.

    ``grid_report``: ``rank, grid_pos, penalty, reg, folds, corr, mae, rmse``.
    """
    spark = tt.df.sparkSession
    per_fold = S.fold_moments(tt)
    fm = S.penalised_fold_models(tt, penalties, iterations, step, scaled, per_fold)
    names = spark.createDataFrame([(g, p or "none", float(r)) for g, (p, r) in enumerate(penalties)],
                                  "grid_pos int, penalty string, reg double")
    report = S.point_report(S.grid_fold_metrics(tt, fm), names)
    best = S.best_point(report)
    penalty, reg = penalties[best["grid_pos"]]
    model = fit_sgd(total(per_fold, tt.width), tt.scaler, iterations, step, scaled, penalty, reg)
    return RunResult({"penalty": penalty, "reg": reg, "iterations": iterations, "step": step, "scaled": scaled},
                     _chosen_cv(spark, best), training_error(tt, model), model, report)


def _cv_and_training(tt: TrainingTable, fm, model, rounded: bool, average: str):
    """Cross-validated and training metrics from one scoring pass (see ``score_with_refit``).

    The metric rows (folds + 1) come to the driver, so that reading the CV and the training result
    separately does not score the table twice.
    """
    def fetched(rows: DataFrame) -> DataFrame:
        return tt.df.sparkSession.createDataFrame(rows.collect(), rows.schema)

    pred = S.score_with_refit(tt, fm, model, rounded)
    if average == "pooled":
        per = fetched(regression_metrics(pred.withColumn("is_refit", F.col("fold") == S.REFIT), ["is_refit"]))
        cv = per.filter(~F.col("is_refit")).select(F.lit(tt.n_folds).alias("folds"), "corr", "mae", "rmse")
        training = per.filter(F.col("is_refit")).drop("is_refit")
    else:
        per = fetched(S.fold_metrics(pred))
        cv = _cv_row(per.filter(F.col("fold") != S.REFIT))
        training = per.filter(F.col("fold") == S.REFIT).drop("grid_pos", "fold")
    return cv, training


def least_squares_program(tt: TrainingTable, rounded: bool = False, average: str = "pooled") -> RunResult:
    """Least squares; metrics pooled over all held-out rows on raw predictions by default."""
    per_fold = S.fold_moments(tt)
    fm = S.ols_fold_models(tt, per_fold)
    model = fit_ols(total(per_fold, tt.width), tt.scaler)
    cv, training = _cv_and_training(tt, fm, model, rounded, average)
    return RunResult({"rounded": rounded, "average": average}, cv, training, model, None,
                     {"fold_models": fm, "predictions": S.score_fold_models(tt, fm, rounded=rounded)})


def wide_least_squares_program(ct: CodedTable, rounded: bool = False) -> RunResult:
    """Least squares on a coded table of any width (see :mod:`~foldwise.operators.wide`): pooled
    cross-validated metrics, training metrics and the refit."""
    models = wide_least_squares(ct.df, ct.moments())
    nd = ct.dictionary.dummy_width
    refit = models.get(REFIT) or LinearModel(np.zeros(ct.dictionary.width), float("nan"))

    def metrics(of: dict) -> DataFrame:
        pred = coded_predictions(ct.df, of, nd)
        return regression_metrics(pred.withColumn("prediction", round_half_up("raw_prediction") if rounded
                                                  else F.col("raw_prediction")))

    cv = metrics({k: m for k, m in models.items() if k != REFIT} or {0: refit})
    return RunResult({"rounded": rounded}, cv.withColumn("folds", F.lit(ct.n_folds)), metrics({REFIT: refit}), refit,
                     None, {"fold_models": models})


def _estimator_program(tt: TrainingTable, make, default: tuple, first: list, second: list,
                       names: tuple[str, str], model_selection: bool, parallelism: int | None,
                       scaled: bool, grid_metrics=None, partitions: int | None = None) -> RunResult:
    spark = tt.df.sparkSession
    report = None
    params = default
    if model_selection:
        points = {g: (a, b) for g, a, b in G.param_grid(first, second)}
        pf = S.as_params_frame(spark, points, names, ("int", "int"))
        per_fold = (grid_metrics() if grid_metrics else
                    S.estimator_grid_metrics(tt, make, points, parallelism, scale=scaled, partitions=partitions))
        report = S.point_report(per_fold, pf)
        best = S.best_point(report)
        params = (int(best[names[0]]), int(best[names[1]]))
        # seeded fits on the same folds: reuse the chosen point's CV instead of refitting
        cv = _chosen_cv(spark, best)
        with S.estimator_rows(tt, scaled, partitions) as rows:
            model = make(*params).fit(rows)
    else:
        per_fold, model = S.estimator_cv_and_refit(tt, make, params, parallelism, scale=scaled,
                                                   partitions=partitions)
        cv = _cv_row(per_fold)
    scaler = tt.scaler if scaled else None
    return RunResult(dict(zip(names, params)) | {"scaled": scaled}, cv,
                     training_error(tt, model, True, scaler), model, report)


def tree_program(tt: TrainingTable, model_selection: bool = False,
                 max_depth: int = G.TREE_DEFAULT[0], max_bins: int = G.TREE_DEFAULT[1],
                 depths: list[int] | None = None, bins: list[int] | None = None,
                 seed: int = DEFAULT_SEED, parallelism: int | None = None, scaled: bool = False,
                 memory_mb: int = TREE_MEMORY_MB) -> RunResult:
    """Regression tree; a grid search fits once per (bins, fold) and reads every depth."""
    def make(depth, nbins, leaf_col=""):
        return tree_estimator(depth, nbins, seed, memory_mb=memory_mb, leaf_col=leaf_col)

    depths, bins = depths or G.TREE_DEPTHS, bins or G.TREE_BINS
    return _estimator_program(
        tt, make, (max_depth, max_bins), depths, bins, ("max_depth", "max_bins"), model_selection,
        parallelism, scaled,
        lambda: S.tree_depth_metrics(tt, lambda d, b: make(d, b, "leaf"), depths, bins, parallelism,
                                     scale=scaled))


def forest_program(tt: TrainingTable, model_selection: bool = False,
                   num_trees: int = G.FOREST_DEFAULT[0], max_depth: int = G.FOREST_DEFAULT[1],
                   max_bins: int = G.FOREST_BINS, trees: list[int] | None = None,
                   depths: list[int] | None = None, seed: int = DEFAULT_SEED,
                   parallelism: int | None = None, scaled: bool = False,
                   memory_mb: int = FOREST_MEMORY_MB, subset: str = "auto",
                   bootstrap: bool = True, bags: str = "partition") -> RunResult:
    """Random forest; a grid search fits one forest per fold, whose first trees cut at each depth
    are the grid's points (see :func:`~foldwise.plans.select.forest_prefix_metrics`).

    ``bags="partition"``: the estimator's own bags, drawn by partition of the fixed layout (none with
    ``bootstrap=False``); ``bags="row"``: bags from a hash of the id
    (:class:`~foldwise.operators.trees.BaggedForest`), one fit a tree, no grid search.
    """
    if bags not in ("partition", "row"):
        raise ValueError(f"unknown bags {bags!r}")
    if bags == "row" and (model_selection or not bootstrap):
        raise ValueError("row bags are for one bootstrapped forest")

    def make(ntrees, depth, leaf_col=""):
        if bags == "row":
            return BaggedForest(ntrees, depth, max_bins, seed, subset, memory_mb)
        return forest_estimator(ntrees, depth, max_bins, seed, subset, memory_mb=memory_mb,
                                bootstrap=bootstrap, leaf_col=leaf_col)

    trees, depths = trees or G.FOREST_TREES, depths or G.FOREST_DEPTHS
    partitions = forest_partitions(tt.n_rows, max(depths) if model_selection else max_depth)
    return _estimator_program(
        tt, make, (num_trees, max_depth), trees, depths, ("num_trees", "max_depth"), model_selection,
        parallelism, scaled,
        lambda: S.forest_prefix_metrics(tt, lambda t, d: make(t, d, "leaf"), trees, depths, parallelism,
                                        scale=scaled, partitions=partitions),
        partitions)


def training_predictions(tt: TrainingTable, model, rounded: bool = True, scaler=None) -> DataFrame:
    """``id, prediction`` of the refitted model on every training row."""
    return predictions(tt.df, model, rounded, scaler).select("id", "prediction")
