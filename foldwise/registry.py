"""Registered queries: one per operator of the survey inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame computed by the library
from the given Parquet tables (never from made-up input), over whole tables.
Column names, types and rounding match :mod:`foldwise.oracle`.

Shared inputs:

* ``order_features`` / ``order_labels`` (see :mod:`foldwise.sources.tables`);
* the fixed prediction ``floor(0.99 * n2 + 0.5)`` for metric operators, so
  their check needs no model fit;
* least squares on all 21 encoded features where a fitted model is the point (its
  oracle solves the same systems by conjugate gradients);
* line items for row-level scalar functions (values without sums, so both
  engines compute them bit for bit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.columns import fold_of, join_fields, round_half_up, split_line
from .operators import dictionary as D
from .operators import encode as E
from .operators import folds as K
from .operators import metrics as A
from .operators import splits as SP
from .operators.inspect import first_rows, row_count
from .operators.linear import fit_ols, fit_regularised, fit_sgd
from .operators.moments import total
from .operators.scale import column_stats
from .plans import grid as G
from .plans import programs as PR
from .plans import select as S
from .plans.score import linear_predictions, score_table, training_error
from .plans.training import (TrainingTable, combined_frame, join_labels, prepare_coded, prepare_training,
                             scoring_frame)
from .plans.reuse import reusable_training
from .session import scratch_path, temporary_path
from .sources import csv as CSV
from .sources import sinks as SK
from .sources.bucketed import join_bucketed, write_bucketed
from .sources.tables import ORDER_SPEC, SCORING_CUTOFF, order_features, order_labels, table
from .spec import FeatureSpec

N2_SPEC = FeatureSpec(id="id", nominal=(), numeric=("n2",), label="label")
N12_SPEC = FeatureSpec(id="id", nominal=(), numeric=("n1", "n2"), label="label")
# Fixed prediction grid a * n2 + b * n1 for the grid/ranking operators; its points
# are far apart in correlation (>= 4e-5 at every scale), so a ranking is well posed.
GRID_A = [0.95, 1.0, 1.05]
GRID_B = [100.0, 1000.0, 3000.0]

CSV_ROWS = 5_000
BUCKETS = 8

RIDGE_REG, LASSO_REG = 0.1, 2000.0
PENALTY_GRID = [(None, 0.0), ("l1", 10.0), ("l1", 100.0), ("l1", 1000.0), ("l1", 10000.0),
                ("l2", 0.001), ("l2", 0.01), ("l2", 0.1), ("l2", 0.5)]

_cache: dict = {}


_INPUTS = ("orders", "lineitem", "customer", "nation", "region")


def _inputs_state(spark: SparkSession, sf: str) -> tuple:
    """Time and size of each input table, so that a changed one is seen."""
    out = []
    for name in _INPUTS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out.append((fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()))
    return tuple(out)


def _memo(spark: SparkSession, key: tuple, build: Callable):
    """What ``build`` made for a ``key`` (its second part is the folder of the tables) of this session
    while the tables are as they were."""
    k = (spark.sparkContext.applicationId, id(spark), key, _inputs_state(spark, key[1]))
    if k not in _cache:
        _cache[k] = build()
    return _cache[k]


def r(c: Column | str, k: int) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, k)


def _of(spark, sf, before=None, since=None) -> DataFrame:
    return order_features(spark, sf, before=before, since=since)


def _ol(spark, sf) -> DataFrame:
    return order_labels(spark, sf)


def _joined(spark, sf) -> DataFrame:
    return join_labels(_of(spark, sf), _ol(spark, sf), ORDER_SPEC)


def _tt(spark, sf, spec: FeatureSpec = ORDER_SPEC, coding: str = "dummy") -> TrainingTable:
    return _memo(spark, ("tt", sf, spec, coding), lambda: prepare_training(
        _of(spark, sf), _ol(spark, sf), spec, n_folds=G.N_FOLDS, coding=coding))


def _encoder(spark, sf, coding: str = "dummy") -> E.Encoder:
    return _memo(spark, ("enc", sf, coding),
                 lambda: E.fit_encoder(_of(spark, sf), ORDER_SPEC, coding=coding))


def _long(tt_df: DataFrame) -> DataFrame:
    return tt_df.select("id", F.posexplode("f").alias("pos", "value"))


def _fixed_prediction(spark, sf) -> DataFrame:
    """``id, label, prediction, fold`` with prediction = floor(0.99 * n2 + 0.5)."""
    j = _joined(spark, sf)
    return j.select("id", "label", round_half_up(F.lit(0.99) * F.col("n2")).alias("prediction"),
                    fold_of("id", G.N_FOLDS).alias("fold"))


def _ols_all(spark, sf):
    """Training table, moments and least squares on all encoded features."""
    tt = _tt(spark, sf)
    per_fold = S.fold_moments(tt)
    return tt, per_fold, fit_ols(total(per_fold, tt.width), tt.scaler)


def _train_ols(spark, sf):
    """Encoder and least squares on all features of the orders before the cutoff."""
    def build():
        feats = _of(spark, sf, before=SCORING_CUTOFF)
        tt = prepare_training(feats, _ol(spark, sf), ORDER_SPEC, n_folds=G.N_FOLDS)
        per_fold = S.fold_moments(tt)
        return tt.encoder, fit_ols(total(per_fold, tt.width), tt.scaler)
    return _memo(spark, ("train_ols", sf), build)


def _csv_copy(spark, df: DataFrame, name: str) -> str:
    """Write ``df`` as CSV part files (each with a header) in the shared folder.

    Files are cut by their number of rows, so several headers are read back
    without a shuffle for it.
    """
    path = scratch_path(spark, name)
    CSV.write_csv(df, path, rows_per_file=CSV_ROWS)
    return path


# ---- sources and sinks ---------------------------------------------------------------

def s1_feature_csv_scan(spark, sf):
    path = _csv_copy(spark, _of(spark, sf), "features-csv")
    spec = FeatureSpec.positional(["id", "c1", "c2", "c3", "c4", "c5", "n1", "n2", "n3", "n4"])
    df = CSV.read_features(spark, path, spec)
    return df.select("id", "c1", "c2", "c3", "c4", "c5", "n1", r("n2", 4).alias("n2"), "n3", "n4")


def s2_label_csv_scan(spark, sf):
    path = _csv_copy(spark, _ol(spark, sf), "labels-csv")
    df = CSV.read_labels(spark, path, ORDER_SPEC)
    return df.select("id", r("label", 6).alias("label"))


def s3_header_per_file(spark, sf):
    path = _csv_copy(spark, _of(spark, sf), "features-csv")
    spec = FeatureSpec.positional(["id", "c1", "c2", "c3", "c4", "c5", "n1", "n2", "n3", "n4"])
    df = CSV.read_features(spark, path, spec)
    return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


def s4_training_table(spark, sf):
    tt = _tt(spark, sf)
    nd = tt.encoder.dummy_width
    n2_slot = tt.feature_names.index("n2")
    return tt.df.select(
        "id", r("label", 6).alias("label"), F.size("f").cast("int").alias("width"),
        F.aggregate(F.slice("f", 1, nd), F.lit(0.0), lambda acc, x: acc + x).alias("ones"),
        r(F.col("f")[n2_slot], 4).alias("n2"))


def s5_scoring_table(spark, sf):
    enc = E.fit_encoder(_of(spark, sf, before=SCORING_CUTOFF), ORDER_SPEC)
    sc = scoring_frame(_of(spark, sf, since=SCORING_CUTOFF), enc)
    return sc.select("id", F.posexplode("f").alias("pos", "value"), "unseen_levels").select(
        "id", "pos", r("value", 4).alias("value"), "unseen_levels")


def s6_combined_table(spark, sf):
    df = combined_frame(_of(spark, sf), _ol(spark, sf), ORDER_SPEC)
    return df.withColumn("n2", r("n2", 4)).withColumn("label", r("label", 6))


def s7_prediction_sink(spark, sf):
    """Predictions for the orders since the cutoff, as text lines read back."""
    enc, model = _train_ols(spark, sf)
    scored = score_table(_of(spark, sf, since=SCORING_CUTOFF), enc, model)
    path = scratch_path(spark, "predictions")
    SK.write_predictions(scored, path)
    return spark.read.text(path)


def _coefficient() -> Column:
    """Rounded for comparison; the intercept is the largest number by far."""
    return F.when(F.col("feature") == "(intercept)", r("coefficient", 2)).otherwise(
        r("coefficient", 4)).alias("coefficient")


def s8_model_sink(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    path = scratch_path(spark, "model")
    SK.save_linear_model(spark, model, tt.feature_names, path, tt.encoder.to_json())
    back = spark.read.parquet(f"{path}/coefficients")
    return back.select("feature", _coefficient())


def s9_first_rows(spark, sf):
    j = _joined(spark, sf)
    out = first_rows(j, 10, "id")
    return out.select("id", "c1", "c2", "c3", "c4", "c5", "n1", r("n2", 4).alias("n2"), "n3", "n4",
                      r("label", 6).alias("label"))


def s10_fold_rows(spark, sf):
    tt = _tt(spark, sf)
    return K.inspect_fold_rows(tt.df, G.N_FOLDS, 10, "id").select(
        F.col("cv_fold").cast("int").alias("cv_fold"), "side", "rn", "id")


def s11_training_predictions(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    return PR.training_predictions(tt, model)


def s12_model_coefficients(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    rows = model.coefficient_rows(tt.feature_names)
    return spark.createDataFrame(rows, "feature string, coefficient double").select(
        "feature", _coefficient())


def s13_result_report(spark, sf):
    tt, per_fold, model = _ols_all(spark, sf)
    fm = S.ols_fold_models(tt, per_fold)
    cv = A.macro_average(S.fold_metrics(S.score_fold_models(tt, fm)).drop("grid_pos"))
    res = PR.RunResult({}, cv, training_error(tt, model), model)
    return res.report().select("stage", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                               r("rmse", 4).alias("rmse"))


# ---- projections -------------------------------------------------------------------

def _lines(spark, sf, extra: tuple[str, ...] = ()) -> DataFrame:
    of = _of(spark, sf)
    return of.select("id", join_fields("id", "c1", "c2", "c3", "c4", "c5", *extra).alias("line"))


def p1_id_and_rest(spark, sf):
    parts = split_line("line")
    df = _lines(spark, sf, ("n1",)).select(parts.alias("parts"))
    rest = F.slice("parts", 2, F.size("parts") - 1)
    return df.select(F.col("parts")[0].alias("id"), F.size(rest).cast("int").alias("n_rest"),
                     rest[0].alias("first_rest"), rest[4].alias("fifth_rest"))


def p2_nominal_column(spark, sf):
    return _of(spark, sf).select("id", "c3")


def p3_ids_only(spark, sf):
    return _tt(spark, sf).df.select("id")


def p4_drop_id(spark, sf):
    return _of(spark, sf).drop("id").withColumn("n2", r("n2", 4))


def p5_label_last(spark, sf):
    """Single-file form: features and label in one CSV, label last, id dropped on read."""
    path = _csv_copy(spark, _joined(spark, sf), "combined-csv")
    spec = FeatureSpec.positional(["id", "c1", "c2", "c3", "c4", "c5", "n1", "n2", "n3", "n4"])
    df = CSV.read_combined(spark, path, spec)
    return df.withColumn("n2", r("n2", 4)).withColumn("label", r("label", 6))


def p6_unlabelled_rows(spark, sf):
    enc = _encoder(spark, sf)
    sc = scoring_frame(_of(spark, sf, since=SCORING_CUTOFF), enc, with_label=True)
    return sc.select("id", "label")


def p7_labeled_point(spark, sf):
    tt = _tt(spark, sf)
    return tt.df.select("id", r("label", 6).alias("label"), F.size("f").cast("int").alias("width"),
                        r(F.aggregate("f", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


def p8_fold_filter(spark, sf):
    """Rows and quantity on each side of every fold, by the library's fold filters."""
    tt = _tt(spark, sf)
    n1 = tt.feature_names.index("n1")
    out = None
    for k in range(G.N_FOLDS):
        for side, rows in zip(("train", "validation"), K.fold_split(tt.df, k)):
            one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("f")[n1]).alias("qty")).select(
                F.lit(k).alias("cv_fold"), F.lit(side).alias("side"), "n", r("qty", 4).alias("qty"))
            out = one if out is None else out.unionByName(one)
    return out


def p9_column_roles(spark, sf):
    """The encoder's own layout, per source column."""
    enc = _encoder(spark, sf)
    rows: dict[str, list] = {}
    for place, (name, slot) in enumerate(enc.layout()):
        column, role = (slot[0], "nominal") if slot else (name, "numeric")
        rows.setdefault(column, [column, role, place, 0])[3] += 1
    return spark.createDataFrame([tuple(x) for x in rows.values()],
                                 "column_name string, role string, slot_start int, slots int")


# ---- encoding ------------------------------------------------------------------------

def e1_distinct_levels(spark, sf):
    return E.distinct_levels(_of(spark, sf), ORDER_SPEC.nominal)


def e2_level_counts(spark, sf):
    return E.level_counts(E.distinct_levels(_of(spark, sf), ORDER_SPEC.nominal))


def e3_level_index(spark, sf):
    return E.level_index(E.distinct_levels(_of(spark, sf), ORDER_SPEC.nominal))


# Columns of line items with many levels.
KEYS_SPEC = FeatureSpec(id="id", nominal=("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"), numeric=("l_quantity",),
                        label="label")


def _line_keys(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag",
                     "l_quantity", F.col("l_extendedprice").alias("label"))


def e3_wide_level_index(spark, sf):
    """Ranks of the levels of columns with about as many levels as orders, parts and suppliers."""
    d = _memo(spark, ("keys", sf), lambda: D.build_dictionary(_line_keys(spark, sf), KEYS_SPEC))
    return d.table.select("col", "level", "idx", "n")


def j2_wide_lookup(spark, sf):
    """Level codes of every line item, by joins with the dictionary table."""
    d = _memo(spark, ("keys", sf), lambda: D.build_dictionary(_line_keys(spark, sf), KEYS_SPEC))
    rows = d.with_codes(_line_keys(spark, sf))
    return rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.col("codes")[i]).alias(f"code_{i}") for i in range(4)])


def _ct(spark, sf):
    return _memo(spark, ("ct", sf), lambda: prepare_coded(_of(spark, sf), _ol(spark, sf), ORDER_SPEC, n_folds=G.N_FOLDS))


def e5_coded_design(spark, sf):
    """Dummy slots of every order as codes, -1 for the baseline."""
    slots = F.col("slots")
    return _ct(spark, sf).df.select("id", *[slots[i].alias(f"c{i + 1}") for i in range(5)],
                                    r(F.col("x")[1], 4).alias("n2"))


def a9_coded_moments(spark, sf):
    """Rows that hold each pair of levels, and each level's count and means, by fold."""
    m = _ct(spark, sf).moments()
    means = m.levels.select("fold", F.col("slot").alias("a"), F.lit(-1).cast("bigint").alias("b"), "n",
                            r(F.col("n") * F.col("mean")[1], 2).alias("sum_n2"),
                            r(F.col("n") * F.col("mean")[4], 6).alias("sum_label"))
    empty = F.lit(None).cast("double")
    return means.unionByName(m.pairs.select("fold", "a", "b", "n", empty.alias("sum_n2"), empty.alias("sum_label")))


def e4_dummy_width(spark, sf):
    counts = E.level_counts(E.distinct_levels(_of(spark, sf), ORDER_SPEC.nominal))
    k = len(ORDER_SPEC.numeric)
    return counts.agg(F.sum("dummies").cast("int").alias("dummy_width"),
                      (F.sum("dummies") + k).cast("int").alias("width"))


def _named_long(tt: TrainingTable, only_nominal: bool = True) -> DataFrame:
    names = tt.feature_names
    lookup = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
    df = tt.df.select("id", F.posexplode("f").alias("pos", "value"))
    if only_nominal:
        df = df.filter(F.col("pos") < tt.encoder.dummy_width)
    return df.select("id", lookup[F.col("pos")].alias("feature"), "value")


def e5_dummy_coding(spark, sf):
    return _named_long(_tt(spark, sf))


def e6_numeric_passthrough(spark, sf):
    tt = _tt(spark, sf)
    idx = {n: tt.feature_names.index(n) for n in ("n1", "n2", "n3", "n4")}
    return tt.df.select("id", *[(r(F.col("f")[i], 4) if n == "n2" else F.col("f")[i]).alias(n)
                                for n, i in idx.items()])


def e7_flatten(spark, sf):
    return _long(_tt(spark, sf).df).select("id", "pos", r("value", 4).alias("value"))


def e8_nominal_to_binary(spark, sf):
    return _named_long(_tt(spark, sf, coding="binary"))


def e9_scaler_fit(spark, sf):
    tt = _tt(spark, sf)
    st = column_stats(tt.df, tt.width)
    slots = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"mean_{i}").alias("mean"),
                               F.col(f"std_{i}").alias("std")) for i in range(tt.width)])
    return st.select(F.explode(slots).alias("s")).select(
        "s.pos", r("s.mean", 6).alias("mean"), r("s.std", 6).alias("std"))


def e10_scaler_transform(spark, sf):
    tt = _tt(spark, sf)
    z = tt.scaler.transform(tt.df)
    return z.select("id", F.posexplode("f").alias("pos", "z")).select("id", "pos", r("z", 6).alias("z"))


def e11_scaling_switch(spark, sf):
    """Mean and population deviation of what the learner sees, with scaling off and on."""
    tt = _tt(spark, sf)
    parts = []
    for scaled in (False, True):
        src = tt.scaler.transform(tt.df) if scaled else tt.df
        long = src.select(F.posexplode("f").alias("pos", "x"))
        parts.append(long.groupBy("pos").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
                     .select(F.lit(scaled).alias("scaled"), "pos", r("mean", 6).alias("mean"),
                             r("sd", 6).alias("sd")))
    return parts[0].unionByName(parts[1])


# ---- joins -----------------------------------------------------------------------------

def j1_label_join(spark, sf):
    """Row counts of the two inputs and of their inner join, in one aggregate."""
    of, ol = _of(spark, sf), _ol(spark, sf)
    joined = join_labels(of, ol, ORDER_SPEC)
    tagged = (of.select(F.lit("n_features").alias("src"))
              .unionByName(ol.select(F.lit("n_labels").alias("src")))
              .unionByName(joined.select(F.lit("n_joined").alias("src"))))
    return tagged.agg(*[F.count(F.when(F.col("src") == n, 1)).alias(n)
                        for n in ("n_features", "n_labels", "n_joined")])


def j1_bucketed_join(spark, sf):
    """Features and labels written in buckets of the id and joined without an exchange."""
    of = write_bucketed(_of(spark, sf), "id", BUCKETS, "features")
    ol = write_bucketed(_ol(spark, sf), "id", BUCKETS, "labels")
    return join_bucketed(of, ol, "id", "label").select("id", "c1", "n1", r("n2", 4).alias("n2"), r("label", 6).alias("label"))


def c1_reused_table(spark, sf):
    """The training table as a second program finds it: by its manifest, with nothing built."""
    root = temporary_path(spark, "reuse")
    inputs = (_of(spark, sf), _ol(spark, sf), ORDER_SPEC, root, "orders")
    if reusable_training(*inputs).hit or not (again := reusable_training(*inputs)).hit:
        raise RuntimeError("the first program builds the table, the second finds it")
    t = again.table
    n2 = t.feature_names.index("n2")
    return t.df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), r(F.sum(F.col("f")[n2]), 2).alias("n2"),
                                    r(F.sum("label"), 2).alias("label"))


def j2_level_lookup(spark, sf):
    of = _of(spark, sf)
    # the fitted dictionary passed the level-count check, so broadcasting it is bounded
    levels = _encoder(spark, sf).level_frame(spark)
    long = of.select("id", *ORDER_SPEC.nominal).unpivot(["id"], list(ORDER_SPEC.nominal), "col", "level")
    return long.join(F.broadcast(levels), ["col", "level"]).select("id", "col", "level", "idx")


def _grid_predictions(spark, sf) -> DataFrame:
    tt = _tt(spark, sf)
    i1, i2 = tt.feature_names.index("n1"), tt.feature_names.index("n2")
    grid = F.broadcast(G.grid_by_fold(spark, GRID_A, GRID_B, tt.n_folds, ("a", "b")))
    return tt.df.join(grid, "fold").select(
        "grid_pos", "a", "b", "fold", F.col("label").alias("y"),
        round_half_up(F.col("a") * F.col("f")[i2] + F.col("b") * F.col("f")[i1]).alias("p"))


def j4_param_grid(spark, sf):
    gp = _grid_predictions(spark, sf)
    return gp.groupBy("grid_pos", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg(F.abs(F.col("y") - F.col("p"))), 4).alias("mae"))


def j5_grid_by_fold(spark, sf):
    gp = _grid_predictions(spark, sf)
    m = A.regression_metrics(gp, ["grid_pos", "fold"], "y", "p")
    return m.select("grid_pos", "fold", "n", r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


# ---- aggregates --------------------------------------------------------------------------

def _fold_metrics_fixed(spark, sf) -> DataFrame:
    return A.regression_metrics(_fixed_prediction(spark, sf), ["fold"])


def a1_row_count(spark, sf):
    return row_count(_joined(spark, sf))


def a2_mse(spark, sf):
    return _fold_metrics_fixed(spark, sf).select("fold", r("mse", 2).alias("mse"))


def a3_rmse(spark, sf):
    return _fold_metrics_fixed(spark, sf).select("fold", r("rmse", 4).alias("rmse"))


def a4_mae(spark, sf):
    return _fold_metrics_fixed(spark, sf).select("fold", r("mae", 4).alias("mae"))


def a5_pearson(spark, sf):
    return _fold_metrics_fixed(spark, sf).select("fold", r("corr", 8).alias("corr"))


def a6_macro_average(spark, sf):
    m = A.macro_average(_fold_metrics_fixed(spark, sf))
    return m.select("folds", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def a7_pooled_metrics(spark, sf):
    m = A.regression_metrics(_fixed_prediction(spark, sf))
    return m.select("n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def a8_metrics_one_pass(spark, sf):
    return _fold_metrics_fixed(spark, sf).select(
        "fold", "n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("mse", 2).alias("mse"),
        r("rmse", 4).alias("rmse"))


def a9_fold_moments(spark, sf):
    """Every fold's moments over (z, 1), upper triangle."""
    tt = _tt(spark, sf)
    d = tt.width
    rows = [(k, i, j, float(m.G[i, j])) for k, m in S.fold_moments(tt).items()
            for i in range(d + 1) for j in range(i, d + 1)]
    return (spark.createDataFrame(rows, "fold int, i int, j int, value double")
            .withColumn("value", r("value", 6)))


# ---- folds ----------------------------------------------------------------------------------

def k1_fold_assignment(spark, sf):
    return K.assign_folds(_joined(spark, sf), G.N_FOLDS, "id").select("id", "fold")


def k2_fold_pairs(spark, sf):
    """Size of both sides of every (train, validation) pair."""
    tt = _tt(spark, sf)
    out = None
    for k, pair in enumerate(K.fold_pairs(tt.df, G.N_FOLDS)):
        for side, rows in zip(("train", "validation"), pair):
            one = rows.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(k).alias("cv_fold"), F.lit(side).alias("side"), "n")
            out = one if out is None else out.unionByName(one)
    return out


def k3_union_all(spark, sf):
    tt = _tt(spark, sf)
    n1 = tt.feature_names.index("n1")
    parts = [K.fold_split(tt.df, k)[1] for k in range(tt.n_folds)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"),
                 r(F.sum(F.col("f")[n1]), 4).alias("qty"))


def k4_seeded_folds(spark, sf):
    return K.assign_folds(_joined(spark, sf), G.N_FOLDS, "id", seed=1).select("id", "fold")


def k4_balanced_folds(spark, sf):
    """Folds of sizes that differ by one row at most."""
    return K.assign_balanced_folds(_joined(spark, sf).select("id", "label"), G.N_FOLDS).select("id", "fold")


def k4_balanced_fold_sizes(spark, sf):
    """Sizes of balanced folds of the line items by order, whose ids repeat and whose rows may be equal."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    folds = K.assign_balanced_folds(li, G.N_FOLDS, "l_orderkey")
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def k5_distinct(spark, sf):
    return _of(spark, sf).select("c1", "c2").distinct()


# ---- top-k -------------------------------------------------------------------------------------

def t1_take_first(spark, sf):
    j = _joined(spark, sf)
    return first_rows(j, 10, [F.col("label").desc(), F.col("id")]).select(
        "id", r("label", 6).alias("label"))


def _grid_report(spark, sf) -> DataFrame:
    gp = _grid_predictions(spark, sf)
    per_fold = A.regression_metrics(gp, ["grid_pos", "a", "b", "fold"], "y", "p")
    rep = A.macro_average(per_fold, ["grid_pos", "a", "b"])
    return rep


def t2_best_point(spark, sf):
    best = S.best_point(_grid_report(spark, sf))
    return spark.createDataFrame([(best["grid_pos"], best["a"], best["b"], best["corr"])],
                                 "grid_pos int, a double, b double, corr double").withColumn(
                                     "corr", r("corr", 8))


def t3_ranked_points(spark, sf):
    ranked = S.point_report(_grid_report(spark, sf).drop("folds").withColumn("folds", F.lit(0)))
    return ranked.select("rank", "grid_pos", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                         r("rmse", 4).alias("rmse"))


# ---- scalar functions ------------------------------------------------------------------------------

def f1_string_split(spark, sf):
    lines = _lines(spark, sf, ("n1", "n4"))
    e = lines.select("id", F.posexplode(split_line("line")).alias("pos", "field"))
    return e.select("id", F.col("pos").cast("int").alias("pos"),
                    F.when(F.col("pos") <= 5, F.col("field")).alias("text"),
                    F.when(F.col("pos") > 5, F.col("field").cast("double")).alias("num"))


def _lineitem(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
                     F.col("l_extendedprice").alias("price"))


def f2_string_to_double(spark, sf):
    li = _lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber",
                     F.col("price").cast("string").cast("double").alias("price"),
                     F.col("l_quantity").cast("string").cast("double").alias("qty"))


def f3_concat(spark, sf):
    fp = _fixed_prediction(spark, sf)
    return fp.select("id", join_fields("id", "prediction").alias("line"))


def _p_line() -> Column:
    return round_half_up(F.lit(0.99) * F.col("price"))


def f4_power(spark, sf):
    li = _lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r(F.pow(F.col("charge") - _p_line(), 2), 4).alias("sq_err"))


def f5_sqrt(spark, sf):
    li = _lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r(F.sqrt("charge"), 6).alias("root"))


def f6_abs(spark, sf):
    li = _lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r(F.abs(F.col("charge") - _p_line()), 6).alias("abs_err"))


def f7_round_half_up(spark, sf):
    li = _lineitem(spark, sf)
    x = F.col("l_linenumber").cast("double") - F.lit(3.5)
    return li.select("l_orderkey", "l_linenumber", x.alias("x"), round_half_up(x).alias("half_up"),
                     round_half_up(F.col("charge") / 100).alias("charge_units"))


def f8_array_ops(spark, sf):
    parts = split_line("line")
    df = _lines(spark, sf).select(parts.alias("parts"))
    rest = F.slice("parts", 2, F.size("parts") - 1)
    flat = F.flatten(F.array(rest, F.array(F.element_at("parts", 1))))
    return df.select(F.element_at("parts", 1).alias("id"), F.element_at(rest, 1).alias("first_rest"),
                     F.size(rest).cast("int").alias("rest_len"), F.size(flat).cast("int").alias("flat_len"))


def f9_map_lookup(spark, sf):
    enc = _encoder(spark, sf)
    lv = enc.levels["c2"]
    m = F.create_map(*[x for i, v in enumerate(lv) for x in (F.lit(v), F.lit(i))])
    return _of(spark, sf).select("id", "c2", F.element_at(m, F.col("c2")).cast("int").alias("idx"))


def f10_int_ranges(spark, sf):
    of = _of(spark, sf)
    return of.filter(F.col("n3") >= 1).select(
        "id", F.explode(F.sequence(F.lit(1), F.col("n3").cast("int"))).alias("line_no"))


# ---- models -----------------------------------------------------------------------------------------

def m1_sgd_one_feature(spark, sf):
    tt = _tt(spark, sf, N2_SPEC)
    per_fold = S.fold_moments(tt)
    model = fit_sgd(total(per_fold, tt.width), tt.scaler, 200, 1.0, scaled=True)
    # back to the standardised unit the descent ran in
    s, m = float(tt.scaler.stds[0]), float(tt.scaler.means[0])
    w = float(model.coef[0]) * s
    b = float(model.intercept) + float(model.coef[0]) * m
    rows = [("(intercept)", b), ("z(n2)", w)]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.select("feature", r("coefficient", 4).alias("coefficient"))


def m2_least_squares_two(spark, sf):
    tt = _tt(spark, sf, N12_SPEC)
    per_fold = S.fold_moments(tt)
    model = fit_ols(total(per_fold, tt.width), tt.scaler)
    rows = model.coefficient_rows(tt.feature_names)
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.select("feature", F.when(F.col("feature") == "(intercept)", r("coefficient", 4))
                     .when(F.col("feature") == "n1", r("coefficient", 6))
                     .otherwise(r("coefficient", 8)).alias("coefficient"))


def m2_wide_least_squares(spark, sf):
    """Least squares on all encoded features by matrix-free conjugate gradients on level codes."""
    ct = _ct(spark, sf)
    res = PR.wide_least_squares_program(ct)
    rows = res.model.coefficient_rows(_encoder(spark, sf).feature_names)
    return spark.createDataFrame(rows, "feature string, coefficient double").select("feature", _coefficient())


def m16_wide_cv_least_squares(spark, sf):
    """Pooled cross-validation of the same fits."""
    m = PR.wide_least_squares_program(_ct(spark, sf)).cv
    return m.select("n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m3_ridge_regression(spark, sf):
    tt = _tt(spark, sf)
    model = fit_regularised(tt.df, reg_param=0.1, l1_ratio=0.0)
    rows = model.coefficient_rows(tt.feature_names)
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.select("feature", r("coefficient", 4).alias("coefficient"))


def m3_lasso(spark, sf):
    """Lasso on all encoded features (no closed form; compared with its optimality conditions in
    a test)."""
    tt = _tt(spark, sf)
    model = fit_regularised(tt.df, reg_param=500.0, l1_ratio=1.0)
    rows = model.coefficient_rows(tt.feature_names)
    return spark.createDataFrame(rows, "feature string, coefficient double").select(
        "feature", _coefficient())


def _descent_coefficients(spark, sf, penalty, reg):
    tt = _tt(spark, sf)
    model = fit_sgd(total(S.fold_moments(tt), tt.width), tt.scaler, *G.LINEAR_DEFAULT, scaled=True,
                    penalty=penalty, reg=reg)
    rows = model.coefficient_rows(tt.feature_names)
    return spark.createDataFrame(rows, "feature string, coefficient double").select(
        "feature", r("coefficient", 4).alias("coefficient"))


def m3_ridge_descent(spark, sf):
    """Ridge by descent at the linear program's defaults on all encoded features."""
    return _descent_coefficients(spark, sf, "l2", RIDGE_REG)


def m3_lasso_descent(spark, sf):
    """Lasso by descent at the linear program's defaults on all encoded features."""
    return _descent_coefficients(spark, sf, "l1", LASSO_REG)


def m3_penalty_grid(spark, sf):
    """Ten-fold cross-validation of nine penalties in one scoring pass."""
    res = PR.penalised_program(_tt(spark, sf), PENALTY_GRID)
    return res.grid_report.select("grid_pos", "penalty", "reg", r("corr", 8).alias("corr"),
                                  r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m4_decision_tree_cv(spark, sf):
    tt = _tt(spark, sf)
    res = PR.tree_program(tt, max_depth=G.TREE_DEFAULT[0], max_bins=G.TREE_DEFAULT[1])
    return res.report()


def m5_random_forest_cv(spark, sf):
    tt = _tt(spark, sf)
    res = PR.forest_program(tt, num_trees=G.FOREST_DEFAULT[0], max_depth=G.FOREST_DEFAULT[1])
    return res.report()


# Few distinct values and a split sample that covers the table: these trees are exact.
TREE_SPEC = FeatureSpec(id="id", nominal=ORDER_SPEC.nominal, numeric=("n3",), label="label")
EXACT_BINS = 512


def _rounded_report(res):
    return res.report().select("stage", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                               r("rmse", 4).alias("rmse"))


def m4_tree_exact(spark, sf):
    """A tree of depth 3 on the dummies and the line count, cross-validated and refitted."""
    return _rounded_report(PR.tree_program(_tt(spark, sf, TREE_SPEC), max_depth=3, max_bins=EXACT_BINS))


def m5_forest_exact(spark, sf):
    """A forest of one tree without bootstrap on all features: the same tree."""
    return _rounded_report(PR.forest_program(_tt(spark, sf, TREE_SPEC), num_trees=1, max_depth=3,
                                             max_bins=EXACT_BINS, subset="all", bootstrap=False))


def m5_bagged_exact(spark, sf):
    """Five trees of depth 3 on bags drawn by a hash of the id, all features, cross-validated and
    refitted."""
    return _rounded_report(PR.forest_program(_tt(spark, sf, TREE_SPEC), num_trees=5, max_depth=3,
                                             max_bins=EXACT_BINS, subset="all", bags="row"))


def m11_tree_grid_exact(spark, sf):
    """Depths 1 to 3 of the same tree from one fit per fold."""
    res = PR.tree_program(_tt(spark, sf, TREE_SPEC), model_selection=True, depths=[1, 2, 3],
                          bins=[EXACT_BINS])
    return res.grid_report.select("grid_pos", "max_depth", r("corr", 8).alias("corr"),
                                  r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m6_best_split(spark, sf):
    j = _joined(spark, sf)
    long = SP.long_columns(j, ["n1", "n2", "n3", "n4"])
    b = SP.best_splits(long)
    return b.select("feature", r("threshold", 4).alias("threshold"), "n_left", "n_right",
                    r("gain_ratio", 8).alias("gain_ratio"))


def m7_linear_predict(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    return linear_predictions(tt.df, model).select("id", r("raw_prediction", 1).alias("raw_prediction"))


def m8_rounded_prediction(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    return linear_predictions(tt.df, model).select("id", r("label", 6).alias("label"), "prediction")


def m9_cv_one_point(spark, sf):
    tt, per_fold, _ = _ols_all(spark, sf)
    fm = S.ols_fold_models(tt, per_fold)
    m = S.fold_metrics(S.score_fold_models(tt, fm))
    return m.select("fold", "n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                    r("rmse", 4).alias("rmse"))


def m9_sgd_cv_all_features(spark, sf):
    """The cluster linear program at its defaults: 21 scaled features, 200 iterations, step 1.0."""
    tt = _tt(spark, sf)
    res = PR.linear_sgd_program(tt, scaled=True, iterations=200, step=1.0)
    return res.report().select("stage", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                               r("rmse", 4).alias("rmse"))


def m10_linear_grid(spark, sf):
    """45 points x 10 folds on all 21 encoded features."""
    tt = _tt(spark, sf)
    res = PR.linear_sgd_program(tt, scaled=True, model_selection=True)
    rep = res.grid_report
    return rep.select("grid_pos", "iterations", "step", r("corr", 8).alias("corr"),
                      r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m11_tree_grid(spark, sf):
    """The program's whole grid, 25 depths x 11 bin counts: 110 fits read at every depth."""
    tt = _tt(spark, sf)
    res = PR.tree_program(tt, model_selection=True)
    return res.grid_report.select("rank", "grid_pos", "max_depth", "max_bins", "corr", "mae", "rmse")


def m12_forest_grid(spark, sf):
    """The program's whole grid, 5 tree counts x 5 depths, from one forest per fold."""
    tt = _tt(spark, sf)
    res = PR.forest_program(tt, model_selection=True)
    return res.grid_report.select("rank", "grid_pos", "num_trees", "max_depth", "corr", "mae", "rmse")


def m12_forest_grid_exact(spark, sf):
    """Forests of one to three trees without bootstrap on all features, at depths 1 to 3: every tree is
    the same, so the points of a depth are the tree of that depth."""
    res = PR.forest_program(_tt(spark, sf, TREE_SPEC), model_selection=True, trees=[1, 2, 3], depths=[1, 2, 3],
                            max_bins=EXACT_BINS, subset="all", bootstrap=False)
    return res.grid_report.select("grid_pos", "num_trees", "max_depth", r("corr", 8).alias("corr"),
                                  r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m13_refit_sgd(spark, sf):
    """Gradient descent (200 iterations, step 1.0, scaled) refitted on all encoded rows."""
    tt = _tt(spark, sf)
    model = fit_sgd(total(S.fold_moments(tt), tt.width), tt.scaler, 200, 1.0, scaled=True)
    rows = model.coefficient_rows(tt.feature_names)
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.select("feature", r("coefficient", 4).alias("coefficient"))


def m14_training_error(spark, sf):
    tt, _, model = _ols_all(spark, sf)
    m = training_error(tt, model)
    return m.select("n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def m15_score_table(spark, sf):
    """Orders since the cutoff, scored by the encoder and the model of those before it."""
    enc, model = _train_ols(spark, sf)
    return score_table(_of(spark, sf, since=SCORING_CUTOFF), enc, model)


def m16_pooled_cv_least_squares(spark, sf):
    tt = _tt(spark, sf)
    res = PR.least_squares_program(tt, rounded=False, average="pooled")
    m = A.regression_metrics(res.extras["predictions"])
    return m.select("n", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"))


def flagship_least_squares_cv(spark, sf):
    """10-fold CV of least squares on all 21 encoded order features (pooled and macro)."""
    tt = _tt(spark, sf)
    res = PR.least_squares_program(tt, rounded=True, average="macro")
    return res.report().select("stage", r("corr", 8).alias("corr"), r("mae", 4).alias("mae"),
                               r("rmse", 4).alias("rmse"))


QUERIES = (
    s1_feature_csv_scan, s2_label_csv_scan, s3_header_per_file, s4_training_table, s5_scoring_table,
    s6_combined_table, s7_prediction_sink, s8_model_sink, s9_first_rows, s10_fold_rows, s11_training_predictions,
    s12_model_coefficients, s13_result_report,
    p1_id_and_rest, p2_nominal_column, p3_ids_only, p4_drop_id, p5_label_last, p6_unlabelled_rows, p7_labeled_point,
    p8_fold_filter, p9_column_roles,
    e1_distinct_levels, e2_level_counts, e3_level_index, e3_wide_level_index, e4_dummy_width, e5_dummy_coding, e5_coded_design,
    e6_numeric_passthrough, e7_flatten, e8_nominal_to_binary, e9_scaler_fit, e10_scaler_transform,
    e11_scaling_switch,
    j1_label_join, j1_bucketed_join, j2_level_lookup, j2_wide_lookup, j4_param_grid, j5_grid_by_fold,
    a1_row_count, a2_mse, a3_rmse, a4_mae, a5_pearson, a6_macro_average, a7_pooled_metrics,
    a8_metrics_one_pass, a9_fold_moments, a9_coded_moments,
    c1_reused_table, k1_fold_assignment, k2_fold_pairs, k3_union_all, k4_seeded_folds, k4_balanced_folds, k4_balanced_fold_sizes, k5_distinct,
    t1_take_first, t2_best_point, t3_ranked_points,
    f1_string_split, f2_string_to_double, f3_concat, f4_power, f5_sqrt, f6_abs, f7_round_half_up,
    f8_array_ops, f9_map_lookup, f10_int_ranges,
    m1_sgd_one_feature, m2_least_squares_two, m2_wide_least_squares, m3_ridge_regression, m3_lasso, m3_ridge_descent, m3_lasso_descent, m3_penalty_grid, m4_decision_tree_cv, m4_tree_exact,
    m5_random_forest_cv, m5_forest_exact, m5_bagged_exact, m6_best_split, m7_linear_predict, m8_rounded_prediction, m9_cv_one_point,
    m9_sgd_cv_all_features,
    m10_linear_grid, m11_tree_grid, m11_tree_grid_exact, m12_forest_grid, m12_forest_grid_exact, m13_refit_sgd, m14_training_error,
    m15_score_table, m16_pooled_cv_least_squares, m16_wide_cv_least_squares, flagship_least_squares_cv,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in QUERIES}
