"""Cross-validation and grid search.

Linear models: one moments aggregate gives every fold's training moments
(total minus own fold); all (point, fold) models are fitted on the driver from
those (d+1)-square matrices; then *one* scoring pass joins every validation row
to the models of its own fold (a broadcast equi-join on ``fold`` against a
table of points x folds rows whose byte size is checked) and aggregates
metrics per (point, fold) with map-side partial aggregation.

Trees and forests are fitted with ``pyspark.ml`` on rows laid out from the data
alone; each task scores its own validation rows and releases its model. A tree
grid takes one fit per (bins, fold), read at every depth; a forest grid takes one per
fold, read at every depth and every number of its first trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..operators import growth
from ..operators.linear import LinearModel, fit_ols, fit_sgd, fit_sgd_grid, prediction_from_columns
from ..operators.metrics import macro_average, regression_metrics
from ..operators.moments import Moments, total
from ..operators.trees import BaggedForest, depth_predictions, forest_leaves, layout_partitions, tree_rows
from ..session import delete_path, temporary_path
from .training import TrainingTable

# Upper bound for the model table that is broadcast to the scoring pass.
MAX_MODEL_BROADCAST_BYTES = 64 << 20


def fold_moments(tt: TrainingTable) -> dict[int, Moments]:
    """Standardised moments by fold (computed once per training table)."""
    return tt.fold_moments()


def train_moments(per_fold: dict[int, Moments], d: int) -> dict[int, Moments]:
    """Training-side moments of each fold: everything but the fold itself."""
    t = total(per_fold, d)
    return {k: t - m for k, m in per_fold.items()}


@dataclass
class FoldModels:
    """Models by (grid_pos, fold); fold -1 is a model fitted on all rows."""
    models: dict[tuple[int, int], LinearModel]
    params: dict[int, tuple]
    width: int

    def frame(self, spark: SparkSession) -> DataFrame:
        """``grid_pos, fold, b`` and the coefficients ``w0..``."""
        ordered = sorted(self.models.items())
        rows = [(g, k, float(m.intercept), *[float(x) for x in m.coef]) for (g, k), m in ordered]
        schema = ", ".join(["grid_pos int", "fold int", "b double"] +
                           [f"w{i} double" for i in range(self.width)])
        return spark.createDataFrame(rows, schema)

    def nbytes(self) -> int:
        return len(self.models) * (self.width + 4) * 8


def ols_fold_models(tt: TrainingTable, per_fold: dict[int, Moments] | None = None) -> FoldModels:
    per_fold = per_fold or fold_moments(tt)
    models = {(0, k): fit_ols(m, tt.scaler) for k, m in train_moments(per_fold, tt.width).items()}
    return FoldModels(models, {0: ()}, tt.width)


def sgd_fold_models(tt: TrainingTable, iterations: list[int], steps: list[float], scaled: bool,
                    per_fold: dict[int, Moments] | None = None,
                    scale_scope: str = "table") -> FoldModels:
    """Every (iterations, step) x fold model; grid order is iterations outer, step inner.

    ``scale_scope="table"`` scales by all rows (as the programs do), ``"fold"``
    by each fold's training rows only.
    """
    if scale_scope not in ("table", "fold"):
        raise ValueError(f"unknown scale_scope {scale_scope!r}")
    per_fold = per_fold or fold_moments(tt)
    params = {g: (it, st) for g, (it, st) in
              enumerate((it, st) for it in iterations for st in steps)}
    pos = {v: g for g, v in params.items()}
    models = {}
    train = ({k: (tt.scaler, m) for k, m in train_moments(per_fold, tt.width).items()}
             if scale_scope == "table" else tt.fold_scaled_training())
    for k, (scaler, m) in train.items():
        for key, model in fit_sgd_grid(m, scaler, iterations, steps, scaled).items():
            models[(pos[key], k)] = model
    return FoldModels(models, params, tt.width)


def penalised_fold_models(tt: TrainingTable, penalties: list[tuple[str | None, float]], iterations: int,
                          step: float, scaled: bool,
                          per_fold: dict[int, Moments] | None = None) -> FoldModels:
    """Every (penalty, strength) x fold model of penalised descent, from the same fold moments."""
    per_fold = per_fold or fold_moments(tt)
    models = {(g, k): fit_sgd(m, tt.scaler, iterations, step, scaled, penalty, reg)
              for k, m in train_moments(per_fold, tt.width).items()
              for g, (penalty, reg) in enumerate(penalties)}
    return FoldModels(models, dict(enumerate(penalties)), tt.width)


def score_fold_models(tt: TrainingTable, fm: FoldModels, rounded: bool = True) -> DataFrame:
    """Validation predictions of every (point, fold) model in one pass (one per chunk).

    ``grid_pos, fold, id, label, raw_prediction, prediction``. The model table
    is broadcast only under :data:`MAX_MODEL_BROADCAST_BYTES`; a larger grid is
    scored in chunks of points that each fit the bound.
    """
    spark = tt.df.sparkSession
    per_point = max(1, MAX_MODEL_BROADCAST_BYTES // max(1, (fm.width + 4) * 8 * tt.n_folds))
    points = sorted(fm.params)
    parts = []
    for start in range(0, len(points), per_point):
        chunk = set(points[start:start + per_point])
        sub = FoldModels({key: m for key, m in fm.models.items() if key[0] in chunk},
                         {g: fm.params[g] for g in chunk}, fm.width)
        assert sub.nbytes() <= MAX_MODEL_BROADCAST_BYTES + (fm.width + 4) * 8 * tt.n_folds
        models = F.broadcast(sub.frame(spark))
        scored = tt.df.join(models, "fold").select(
            "grid_pos", "fold", "id", "label",
            prediction_from_columns("w", "b", fm.width).alias("raw_prediction"))
        parts.append(scored)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    pred = round_half_up("raw_prediction") if rounded else F.col("raw_prediction")
    return out.withColumn("prediction", pred)


REFIT = -1   # model key of the model refitted on all rows


def score_with_refit(tt: TrainingTable, fm: FoldModels, refit: LinearModel,
                     rounded: bool = True) -> DataFrame:
    """CV predictions and training-row predictions of the refit, in one pass.

    Every row is scored by its own fold's model (``fold = k``) and by the refit
    (``fold = -1``): the row's key list ``[fold, -1]`` is exploded and equi-joined
    to the broadcast model table, so the table is read once for both results.
    """
    spark = tt.df.sparkSession
    assert len(fm.params) == 1, "one parameter point"
    g = next(iter(fm.params))
    models = dict(fm.models)
    models[(g, REFIT)] = refit
    table = FoldModels(models, fm.params, fm.width)
    assert table.nbytes() <= MAX_MODEL_BROADCAST_BYTES
    keyed = tt.df.select("id", "label", "f", F.explode(F.array("fold", F.lit(REFIT))).alias("fold"))
    scored = keyed.join(F.broadcast(table.frame(spark)), "fold").select(
        "grid_pos", "fold", "id", "label",
        prediction_from_columns("w", "b", fm.width).alias("raw_prediction"))
    pred = round_half_up("raw_prediction") if rounded else F.col("raw_prediction")
    return scored.withColumn("prediction", pred)


def canonical_points(fm: FoldModels) -> dict[int, int]:
    """Grid point -> first grid point with exactly the same models in every fold.

    Gradient descent that stops early gives later iteration counts the same
    weights; scoring such points once keeps their metrics identical, so ties
    go to the first point as intended (and the scoring pass does less work).
    """
    folds = sorted({k for _, k in fm.models})
    seen: dict[bytes, int] = {}
    canon: dict[int, int] = {}
    for g in sorted(fm.params):
        key = b"".join(np.asarray([fm.models[(g, k)].intercept, *fm.models[(g, k)].coef],
                                  dtype=float).tobytes() for k in folds if (g, k) in fm.models)
        canon[g] = seen.setdefault(key, g)
    return canon


def grid_fold_metrics(tt: TrainingTable, fm: FoldModels, rounded: bool = True) -> DataFrame:
    """Per (point, fold) metrics of a model grid, scoring each distinct model once."""
    spark = tt.df.sparkSession
    canon = canonical_points(fm)
    reps = sorted(set(canon.values()))
    sub = FoldModels({key: m for key, m in fm.models.items() if key[0] in reps},
                     {g: fm.params[g] for g in reps}, fm.width)
    per = fold_metrics(score_fold_models(tt, sub, rounded))
    mapping = spark.createDataFrame(sorted(canon.items()), "grid_pos int, canon int")
    return (per.withColumnRenamed("grid_pos", "canon")
            .join(F.broadcast(mapping), "canon").drop("canon"))


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """``grid_pos, fold, n, corr, mae, mse, rmse``."""
    return regression_metrics(predictions, ["grid_pos", "fold"])


def point_report(per_fold: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Macro average per point, ranked by correlation (nulls last), ties by position."""
    rep = macro_average(per_fold, ["grid_pos"])
    if params is not None:
        rep = rep.join(F.broadcast(params), "grid_pos")
    w = Window.orderBy(F.col("corr").desc_nulls_last(), F.col("grid_pos"))
    return rep.withColumn("rank", F.row_number().over(w).cast("int"))


def best_point(report: DataFrame) -> dict:
    """Arg-max of mean correlation; the report has one row per point."""
    row = report.orderBy(F.col("corr").desc_nulls_last(), F.col("grid_pos")).limit(1).collect()
    return row[0].asDict() if row else {}


# --- estimators without a moments shortcut -------------------------------------

# Concurrent fits each cache their own binned copy of ~(k-1)/k of the table.
CONCURRENT_FIT_BYTES = 2 << 30
CONCURRENT_FITS = 8

_METRIC_ROWS = ("grid_pos int, fold int, n bigint, corr double, mae double, mse double, rmse double")


def fit_parallelism(tt: TrainingTable, requested: int | None = None) -> int:
    """Fits submitted at a time: several for small tables, else one. No result depends on it."""
    if requested is not None:
        return max(1, requested)
    return CONCURRENT_FITS if tt.n_rows * (tt.width + 3) * 8 <= CONCURRENT_FIT_BYTES else 1


@contextmanager
def estimator_rows(tt: TrainingTable, scale: bool = False, partitions: int | None = None) -> Iterator[DataFrame]:
    """``id, label, fold, features`` in the layout of :func:`tree_rows`, kept while fits read it."""
    from pyspark.ml.functions import array_to_vector

    rows = tree_rows(tt.df, tt.n_rows, partitions=partitions)
    src = tt.scaler.transform(rows) if scale else rows
    data = src.select("id", "label", "fold", array_to_vector("f").alias("features")).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def estimator_grid_metrics(tt: TrainingTable, make_estimator, points: dict[int, tuple],
                           parallelism: int | None = None, rounded: bool = True,
                           scale: bool = False, partitions: int | None = None) -> DataFrame:
    """Per (point, fold) metrics of an estimator, one task per fit.

    Each task fits on ``fold != k``, scores ``fold = k`` and aggregates the
    metrics right away (one row), so a fitted model lives only while its task
    runs: at most ``parallelism`` models are held at once, and a grid of
    hundreds of points never becomes one plan over thousands of fits. Folds
    without validation rows yield no row (as in the grouped linear path).
    """
    return _estimator_fits(tt, make_estimator, points, None, parallelism, rounded, scale, partitions)[0]


def estimator_cv_and_refit(tt: TrainingTable, make_estimator, params: tuple, parallelism: int | None = None,
                           rounded: bool = True, scale: bool = False,
                           partitions: int | None = None) -> tuple[DataFrame, object]:
    """Per-fold metrics of one point and the model refitted on all rows: the refit is one more task
    beside those of the folds, on the same rows."""
    return _estimator_fits(tt, make_estimator, {0: params}, params, parallelism, rounded, scale, partitions)


@contextmanager
def _fit_rows(tt: TrainingTable, estimator, points: int, scale: bool,
              partitions: int | None) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The rows that fits read and those that are scored: both :func:`estimator_rows`, unless the estimator is a
    bagged forest and at least half of the rows agree with others in fold and features; then it reads their groups."""
    from pyspark.ml.functions import array_to_vector

    features = array_to_vector("f").alias("features")
    if isinstance(estimator, BaggedForest) and points == 1:
        src = tt.scaler.transform(tt.df) if scale else tt.df
        groups = estimator.grouped(src.select("id", "label", "fold", "f"), ["fold", "f"]).select(
            "fold", features, "bags").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if 2 * groups.count() <= tt.n_rows:
                yield groups, src.select("id", "label", "fold", features)
                return
        finally:
            groups.unpersist()
    with estimator_rows(tt, scale, partitions) as data:
        yield data, data


def _estimator_fits(tt: TrainingTable, make_estimator, points: dict[int, tuple], refit: tuple | None,
                    parallelism: int | None, rounded: bool, scale: bool,
                    partitions: int | None) -> tuple[DataFrame, object]:
    tasks = [(g, k) for g in sorted(points) for k in range(tt.n_folds)]
    estimator = make_estimator(*next(iter(points.values())))
    if len(points) == 1 and refit is not None and parallelism is None and hasattr(estimator, "getNumTrees"):
        rows = _forests_in_tasks(tt, estimator, [estimator.getNumTrees()], [estimator.getMaxDepth()], rounded, scale,
                                 partitions)
        if rows is not None:
            with estimator_rows(tt, scale, partitions) as data:
                return tt.df.sparkSession.createDataFrame(rows, _METRIC_ROWS), make_estimator(*refit).fit(data)
    with _fit_rows(tt, estimator, len(points), scale, partitions) as (train, data):
        def one(task):
            g, k = task
            model = make_estimator(*points[g]).fit(train.filter(F.col("fold") != k))
            raw = model.transform(data.filter(F.col("fold") == k)).withColumnRenamed("prediction", "raw")
            pred = raw.withColumn("prediction", round_half_up("raw") if rounded else F.col("raw"))
            m = regression_metrics(pred).collect()[0]
            return None if m["n"] == 0 else (g, k, m["n"], m["corr"], m["mae"], m["mse"], m["rmse"])

        with ThreadPoolExecutor(max_workers=fit_parallelism(tt, parallelism)) as pool:
            whole = None if refit is None else pool.submit(lambda: make_estimator(*refit).fit(train))
            rows = [r for r in pool.map(one, tasks) if r is not None]
            model = None if whole is None else whole.result()
    return tt.df.sparkSession.createDataFrame(rows, _METRIC_ROWS), model


@contextmanager
def _packed_rows(tt: TrainingTable, scale: bool, partitions: int | None = None) -> Iterator[tuple[DataFrame, object]]:
    """The rows of :func:`estimator_rows` with their features in ``f``, and their packed copy, broadcast."""
    rows = tree_rows(tt.df, tt.n_rows, partitions=partitions)
    data = (tt.scaler.transform(rows) if scale else rows).select("label", "fold", "f").persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        yield data, growth.pack(data, tt.width)
    finally:
        data.unpersist()


def _as_given(estimator, own: set[str]) -> bool:
    """Whether every parameter but ``own`` has its default."""
    plain = type(estimator)()
    own = own | {"maxDepth", "maxBins", "seed", "featuresCol", "labelCol", "leafCol", "predictionCol", "cacheNodeIds",
                 "checkpointInterval", "maxMemoryInMB"}
    return all(not estimator.isSet(p) or (plain.hasDefault(p.name) and estimator.getOrDefault(p) == plain.getOrDefault(p.name))
               for p in estimator.params if p.name not in own)


def _in_tasks(tt: TrainingTable, seed: int, points: int, bins: list[int], scale: bool, partitions: int | None,
              fit: Callable) -> list[tuple] | None:
    """The metric rows of ``fit(codes, n_bins, label, held_out, inside, held_label)`` for every number of bins and every
    fold, a task each: codes (features x rows) and labels of the rows to fit on, those of the fold, and a mask of
    the former among all rows. It gives ``(at, metrics)``, of the point ``at * points + b``; ``None`` when a fold
    holds every row."""
    spark = tt.df.sparkSession
    with _packed_rows(tt, scale, partitions) as (data, table):
        sizes = np.bincount(table.fold, minlength=tt.n_folds)
        n = len(table.fold)
        if (sizes == n).any() or not n:
            return None  # nothing to fit on; the estimators say so
        folds = [k for k in range(tt.n_folds) if sizes[k]]
        needs = {(k, growth.sample_size(b, int(n - sizes[k]))) for k in folds for b in bins}
        with ThreadPoolExecutor(max_workers=fit_parallelism(tt)) as pool:
            samples = dict(pool.map(lambda x: (x, growth.drawn(data.filter(F.col("fold") != x[0]),
                                                               int(n - sizes[x[0]]), x[1], seed)), needs))
    sent = spark.sparkContext.broadcast((table, samples))
    # the largest fits first
    tasks = [(b, k) for b in sorted(range(len(bins)), key=lambda b: -bins[b]) for k in folds]

    def one(i: int) -> list[tuple]:
        b, k = tasks[i]
        table, samples = sent.value
        inside = table.fold != k
        train = int(inside.sum())
        size, most = growth.sample_size(bins[b], train), min(bins[b], train)
        sample = samples[(k, size)]
        cuts = [growth.split_candidates(sample[:, j], most, min(1.0, size / train) * train)
                for j in range(sample.shape[1])]
        codes = np.stack([growth.binned(c, t) for c, t in zip(table.features, cuts)])
        found = fit(codes[:, inside], [len(t) + 1 for t in cuts], table.label[inside], codes[:, ~inside], inside,
                    table.label[~inside])
        return [(at * points + b, k, *metrics) for at, metrics in found]

    try:
        return [tuple(r) for r in growth.each_task(spark, len(tasks), one, _METRIC_ROWS)]
    finally:
        sent.destroy()


def _trees_in_tasks(tt: TrainingTable, tree, depths: list[int], bins: list[int], rounded: bool,
                    scale: bool) -> list[tuple] | None:
    """The metric rows of :func:`tree_depth_metrics`, each tree grown in one task; ``None`` for an estimator or a
    table that only the estimators can take."""
    if not growth.fits_a_task(tt.n_rows, tt.width) or not _as_given(tree, set()):
        return None

    def fit(codes, n_bins, label, held_out, inside, held_label):
        raw = growth.grow(codes, n_bins, label, None, held_out, depths)
        return [(at, growth.measured(held_label, p, rounded)) for at, p in enumerate(raw)]

    return _in_tasks(tt, tree.getSeed(), len(bins), bins, scale, None, fit)


def _forests_in_tasks(tt: TrainingTable, forest, trees: list[int], depths: list[int], rounded: bool, scale: bool,
                      partitions: int | None) -> list[tuple] | None:
    """The metric rows of :func:`forest_prefix_metrics`, each forest grown in one task; ``None`` where the
    estimators fit: other estimators, shallow forests and tables of few rows, or more than a task can hold.

    Bags (Poisson draws by row of the fixed layout) and the features of a node come from the seed and the number
    of the tree, so the forests are other draws than the estimator's."""
    if (partitions is None or partitions >= layout_partitions(tt.n_rows) or not growth.fits_a_task(tt.n_rows, tt.width)
            or type(forest).__name__ != "RandomForestRegressor" or not _as_given(forest, {"numTrees", "bootstrap", "impurity"})
            or not forest.getBootstrap() or max(trees) < 2):
        return None
    seed = forest.getSeed()

    def fit(codes, n_bins, label, held_out, inside, held_label):
        out, total = [], np.zeros((len(depths), held_out.shape[1]))
        for t in range(max(trees)):
            rng = np.random.default_rng([seed, t])
            weight = rng.poisson(1.0, len(inside))[inside]
            bag = np.flatnonzero(weight)
            total += growth.grow(codes[:, bag], n_bins, label[bag], weight[bag].astype(float), held_out, depths,
                                 -(-len(n_bins) // 3), rng)
            for i in (i for i, n in enumerate(trees) if n == t + 1):
                out += [(i * len(depths) + j, growth.measured(held_label, s / (t + 1), rounded)) for j, s in enumerate(total)]
        return out

    return _in_tasks(tt, seed, 1, [forest.getMaxBins()], scale, partitions, fit)


def tree_depth_metrics(tt: TrainingTable, make_tree, depths: list[int], bins: list[int],
                       parallelism: int | None = None, rounded: bool = True,
                       scale: bool = False) -> DataFrame:
    """Per (point, fold) metrics of a tree grid (depths outer, bins inner), one fit per
    (bins, fold): the deepest tree, read at every depth.

    ``make_tree(depth, bins)`` returns an estimator whose model gives a row's
    leaf in the column ``leaf``. The leaves' predictions by depth form a table
    (one row per leaf, read from the saved model) that is joined to the
    validation rows; one aggregate gives the metrics of all depths. A table that a task can hold
    is packed and sent to a task per fit (see :mod:`~foldwise.operators.growth`); the trees are the same.
    ``parallelism`` limits the estimators' fits, which are used when it is given.
    """
    spark = tt.df.sparkSession
    tasks = [(b, k) for b in range(len(bins)) for k in range(tt.n_folds)]
    if parallelism is None:
        rows = _trees_in_tasks(tt, make_tree(max(depths), max(bins)), depths, bins, rounded, scale)
        if rows is not None:
            return spark.createDataFrame(rows, _METRIC_ROWS)
    with estimator_rows(tt, scale) as data:
        def one(task):
            b, k = task
            model = make_tree(max(depths), bins[b]).fit(data.filter(F.col("fold") != k))
            path = temporary_path(spark, "tree")
            model.write().save(path)
            nodes = spark.read.parquet(f"{path}/data").select(
                "id", "prediction", "leftChild", "rightChild").toPandas()
            leaves = spark.createDataFrame(depth_predictions(nodes, depths),
                                           "leaf double, preds array<double>")
            raw = (model.transform(data.filter(F.col("fold") == k)).select("label", "leaf")
                   .join(leaves, "leaf").select("label", F.posexplode("preds").alias("at", "raw")))
            pred = raw.withColumn("prediction", round_half_up("raw") if rounded else F.col("raw"))
            return [(m["at"] * len(bins) + b, k, m["n"], m["corr"], m["mae"], m["mse"], m["rmse"])
                    for m in regression_metrics(pred, ["at"]).collect()]

        with ThreadPoolExecutor(max_workers=fit_parallelism(tt, parallelism)) as pool:
            rows = [r for part in pool.map(one, tasks) for r in part]
    return spark.createDataFrame(rows, _METRIC_ROWS)


def forest_prefix_metrics(tt: TrainingTable, make_forest, trees: list[int], depths: list[int],
                          parallelism: int | None = None, rounded: bool = True,
                          scale: bool = False, partitions: int | None = None) -> DataFrame:
    """Per (point, fold) metrics of a forest grid (tree counts outer, depths inner), one fit per
    fold: the largest forest, of which every point is a part.

    The point (t trees, depth d) is the first t trees of that forest, each cut at depth d. A tree
    depends on its own bag only, so the first t trees are a forest of t trees, and a tree cut at d
    is a tree grown to d. ``make_forest(trees, depth)`` returns an estimator whose model gives a row's
    leaves in the vector ``leaf``. Validation rows are joined to the table of leaves once per
    tree; one aggregate makes the running means over the trees and one the metrics of all points.
    Deep forests of large tables that a task can hold grow in a task per fold (:func:`_forests_in_tasks`), unless
    ``parallelism`` is given.
    """
    from pyspark.ml.functions import vector_to_array

    spark = tt.df.sparkSession
    if parallelism is None:
        rows = _forests_in_tasks(tt, make_forest(max(trees), max(depths)), trees, depths, rounded, scale, partitions)
        if rows is not None:
            return spark.createDataFrame(rows, _METRIC_ROWS)
    with estimator_rows(tt, scale, partitions) as data:
        def one(k):
            model = make_forest(max(trees), max(depths)).fit(data.filter(F.col("fold") != k))
            leaves, path = forest_leaves(model, depths)
            own = data.filter(F.col("fold") == k).withColumn("row", F.monotonically_increasing_id())
            rows = model.transform(own).select(
                "row", "label", F.posexplode(vector_to_array("leaf")).alias("tree", "leaf"))
            sums = rows.join(leaves, ["tree", "leaf"]).groupBy("row", "label").agg(
                *[F.sum(F.when(F.col("tree") < t, F.col("preds")[j])).alias(f"s{i}_{j}")
                  for i, t in enumerate(trees) for j in range(len(depths))])
            raw = sums.select("label", F.posexplode(F.array(
                *[F.col(f"s{i}_{j}") / F.lit(float(t)) for i, t in enumerate(trees)
                  for j in range(len(depths))])).alias("at", "raw"))
            pred = raw.withColumn("prediction", round_half_up("raw") if rounded else F.col("raw"))
            got = [(m["at"], k, m["n"], m["corr"], m["mae"], m["mse"], m["rmse"])
                   for m in regression_metrics(pred, ["at"]).collect()]
            delete_path(spark, path)
            return got

        with ThreadPoolExecutor(max_workers=fit_parallelism(tt, parallelism)) as pool:
            rows = [r for part in pool.map(one, range(tt.n_folds)) for r in part]
    return spark.createDataFrame(rows, _METRIC_ROWS)


def as_params_frame(spark: SparkSession, params: dict[int, tuple], names: tuple[str, str],
                    types: tuple[str, str]) -> DataFrame:
    rows = [(g, *map(lambda v, t: int(v) if t == "int" else float(v), p, types))
            for g, p in sorted(params.items())]
    return spark.createDataFrame(rows, f"grid_pos int, {names[0]} {types[0]}, {names[1]} {types[1]}")
