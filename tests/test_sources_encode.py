"""CSV sources, encoding and the training/scoring frames on the hand-made fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foldwise.operators.encode import Encoder, fit_encoder
from foldwise.plans.training import scoring_frame, training_frame
from foldwise.sources import csv as CSV


def test_header_dropped_in_every_file(spark, fixture_dir, fixture_spec):
    df = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    ids = sorted(r.id for r in df.collect())
    assert ids == ["r1", "r2", "r3", "r4", "r5"]


def test_levels_and_width(spark, fixture_dir, fixture_spec):
    df = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    enc = fit_encoder(df, fixture_spec)
    assert enc.levels == {"c1": ["", "a", "b", "c"], "c2": ["x", "y"], "c3": ["p", "q"],
                          "c4": ["u", "v"], "c5": ["k"]}
    assert enc.width == 3 + 1 + 1 + 1 + 0 + 2
    assert enc.feature_names[:3] == ["c1=a", "c1=b", "c1=c"]


def test_join_drops_unmatched_and_multiplies_duplicates(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    labels = CSV.read_labels(spark, str(fixture_dir / "labels.csv"), fixture_spec)
    df, enc = training_frame(feats, labels, fixture_spec)
    rows = sorted((r.id, r.label) for r in df.collect())
    assert rows == [("r1", 11.0), ("r2", 22.0), ("r2", 23.0), ("r3", -2.5), ("r4", 44.0)]


def test_dummy_coding_baseline_and_slots(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    enc = fit_encoder(feats, fixture_spec)
    got = {r.id: list(r.f) for r in enc.transform(feats, keep=["id"]).collect()}
    # r3 has the empty (baseline) level in c1 -> zeros; c2 = y -> 1; c3 = p (baseline) -> 0
    assert got["r3"] == [0.0, 0.0, 0.0, 1.0, 0.0, 1.0, -1.5, 30.0]
    assert got["r2"] == [0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 2.5, 20.0]


def test_short_row_fails(spark, fixture_dir, fixture_spec):
    df = CSV.read_features(spark, str(fixture_dir / "short.csv"), fixture_spec)
    enc = fit_encoder(CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec), fixture_spec)
    with pytest.raises(Exception):
        enc.transform(df, keep=["id"]).collect()


def test_unseen_level_is_counted_and_encoded_as_baseline(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    enc = fit_encoder(feats, fixture_spec)
    score = CSV.read_features(spark, str(fixture_dir / "score.csv"), fixture_spec)
    got = {r.id: (list(r.f), r.unseen_levels) for r in scoring_frame(score, enc).collect()}
    assert got["s1"] == ([0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 10.0], 1)
    assert got["s2"][1] == 0
    assert enc.width == len(got["s2"][0])  # same width as in training


def test_binary_coding(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    enc = fit_encoder(feats, fixture_spec, coding="binary")
    # c1 has 4 levels -> 4 columns; c2..c4 have 2 -> 1 each; c5 has 1 -> one constant column
    assert enc.feature_names == ["c1=", "c1=a", "c1=b", "c1=c", "c2=y", "c3=q", "c4=v", "c5", "n1", "n2"]
    row = {r.id: list(r.f) for r in enc.transform(feats, keep=["id"]).collect()}["r3"]
    assert row == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, -1.5, 30.0]


def test_encoder_json_round_trip(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    enc = fit_encoder(feats, fixture_spec)
    back = Encoder.from_json(enc.to_json())
    assert back.feature_names == enc.feature_names
    a = sorted(tuple(r.f) for r in enc.transform(feats).collect())
    b = sorted(tuple(r.f) for r in back.transform(feats).collect())
    assert a == b


def test_level_limit(spark, fixture_dir, fixture_spec):
    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec)
    with pytest.raises(ValueError):
        fit_encoder(feats, fixture_spec, max_levels=5)


def test_combined_file(spark, tmp_path, fixture_spec):
    (tmp_path / "all.csv").write_text("id,c1,c2,c3,c4,c5,n1,n2,label\nr1,a,x,p,u,k,1.0,10,5.5\n")
    df = CSV.read_combined(spark, str(tmp_path / "all.csv"), fixture_spec)
    assert df.columns[-1] == "label" and "id" not in df.columns
    assert df.collect()[0].label == 5.5


def test_empty_numeric_raises(spark, tmp_path, fixture_spec):
    (tmp_path / "f.csv").write_text("id,c1,c2,c3,c4,c5,n1,n2\nr1,a,x,p,u,k,,10\n")
    df = CSV.read_features(spark, str(tmp_path / "f.csv"), fixture_spec)
    enc = fit_encoder(df, fixture_spec)
    with pytest.raises(Exception):
        enc.transform(df).collect()
    zero = fit_encoder(df, fixture_spec, numeric_nulls="zero")
    assert list(zero.transform(df).collect()[0].f)[-2:] == [0.0, 10.0]


def test_split_keeps_trailing_empty_fields(spark):
    from foldwise.functions.columns import split_line

    df = spark.createDataFrame([("a,b,,",)], "line string")
    assert df.select(F.size(split_line("line")).alias("n")).collect()[0].n == 4


def test_cv_on_tiny_table_with_empty_folds_and_constant_column(spark, fixture_dir, fixture_spec):
    """5 labelled rows, 10 folds (most empty), c5 single-level, n3 constant: runs and stays defined."""
    from foldwise.plans import programs as PR
    from foldwise.plans.training import prepare_training

    feats = CSV.read_features(spark, str(fixture_dir / "features"), fixture_spec).withColumn("n3", F.lit(7.0))
    spec = fixture_spec.__class__(id="id", nominal=fixture_spec.nominal, numeric=("n1", "n2", "n3"))
    labels = CSV.read_labels(spark, str(fixture_dir / "labels.csv"), spec)
    tt = prepare_training(feats, labels, spec)
    assert tt.scaler.stds[-1] == 0.0 and tt.scaler.means[-1] == 7.0
    res = PR.least_squares_program(tt)
    rep = {r.stage: r for r in res.report().collect()}
    assert rep["training"].mae is not None
    folds_with_rows = tt.df.select("fold").distinct().count()
    cv = res.cv.collect()[0]
    assert cv.folds == 10 and folds_with_rows < 10


def test_hot_id_with_a_third_of_the_rows(spark):
    """One id holds a third of the feature rows: the join multiplies, the fold stays whole."""
    from foldwise.plans.training import prepare_training
    from foldwise.spec import FeatureSpec

    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        (F.col("id") % 4).cast("string").alias("c1"), (F.col("id") % 7).cast("double").alias("n1"))
    labels = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        (F.col("id") % 11).cast("double").alias("label")).dropDuplicates(["id"])
    spec = FeatureSpec(id="id", nominal=("c1",), numeric=("n1",))
    tt = prepare_training(base, labels, spec)
    assert tt.df.count() == n
    hot_fold = tt.df.filter(F.col("id") == "hot").select("fold").distinct().collect()
    assert len(hot_fold) == 1
    sizes = {r.fold: r["count"] for r in tt.df.groupBy("fold").count().collect()}
    assert sizes[hot_fold[0].fold] >= n // 3
    m = tt.fold_moments()
    assert sum(v.n for v in m.values()) == n


def test_label_join_splits_a_hot_id_partition(spark):
    """With a sort-merge join, adaptive execution splits the partition of an id holding 1/3 of rows."""
    from foldwise.plans.training import join_labels
    from foldwise.spec import FeatureSpec

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300000
        feats = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
            F.rand(7).alias("n1"))
        labels = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("label")) \
            .union(spark.createDataFrame([("hot", 2.0)], "id string, label double"))
        joined = join_labels(feats, labels, FeatureSpec(id="id", nominal=(), numeric=("n1",)))
        # keep the payload column so the shuffled rows are realistic (not all alike)
        agg = joined.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"), F.sum("n1").alias("x"))
        row = agg.collect()[0]
        assert row.n == n and row.s == pytest.approx(2 * 100000 + (n - 100000))
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_join_equals_plain_join_with_hot_id_copies(spark):
    """Explicit salting (used when adaptive skew handling is off) gives the same rows."""
    from foldwise.plans.training import join_labels
    from foldwise.spec import FeatureSpec

    n = 30000
    # a third of the feature rows are identical copies of one row with the hot id
    feats = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id") % 7).cast("double").alias("n1"))
    labels = spark.range(0, n, 2).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("label")) \
        .union(spark.createDataFrame([("hot", 2.0), ("hot", 3.0)], "id string, label double"))
    spec = FeatureSpec(id="id", nominal=(), numeric=("n1",))
    plain = join_labels(feats, labels, spec, skew="none")
    salted = join_labels(feats, labels, spec, skew="salt")
    key = lambda df: sorted((r.id, r.n1, r.label) for r in df.collect())
    assert key(salted) == key(plain)
    assert salted.filter(F.col("id") == "hot").count() == 2 * (n // 3)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_auto_skew_mode_salts_when_adaptive_skew_join_is_off(spark):
    from foldwise.plans.training import join_labels
    from foldwise.spec import FeatureSpec

    feats = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(1.0).alias("n1"))
    labels = spark.createDataFrame([("hot", 1.0), ("1", 2.0)], "id string, label double")
    spec = FeatureSpec(id="id", nominal=(), numeric=("n1",))
    key = "spark.sql.adaptive.skewJoin.enabled"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "false")
        auto = join_labels(feats, labels, spec)
        assert "_salt" in auto._jdf.queryExecution().executedPlan().toString()
        assert auto.count() == 1501
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)
    assert "_salt" not in join_labels(feats, labels, spec)._jdf.queryExecution().executedPlan().toString()
