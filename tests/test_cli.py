"""The command-line jobs run end to end on CSV copies of the order tables."""

from __future__ import annotations

from sample_tables import SF_SMALL
from foldwise.__main__ import main
from foldwise.session import scratch_path
from foldwise.sources.csv import write_csv
from foldwise.sources.tables import SCORING_CUTOFF, order_features, order_labels


def _csvs(spark):
    feats = scratch_path(spark, "cli-features")
    labels = scratch_path(spark, "cli-labels")
    test = scratch_path(spark, "cli-test")
    write_csv(order_features(spark, SF_SMALL, before=SCORING_CUTOFF).repartition(2), feats)
    write_csv(order_labels(spark, SF_SMALL), labels)
    write_csv(order_features(spark, SF_SMALL, since=SCORING_CUTOFF), test)
    return feats, labels, test


def test_linear_job_with_selection_model_and_scoring(spark, capsys):
    feats, labels, test = _csvs(spark)
    model, out = scratch_path(spark, "cli-model"), scratch_path(spark, "cli-out")
    trained = scratch_path(spark, "cli-train-pred")
    assert main(["linear", feats, labels, "--scale", "--select", "--model", model,
                 "--test", test, "--output", out, "--train-predictions", trained]) == 0
    assert spark.read.text(trained).count() > 0
    text = capsys.readouterr().out
    assert "cross-validation: r " in text and "Saved model" in text
    lines = spark.read.text(out).collect()
    assert len(lines) == order_features(spark, SF_SMALL, since=SCORING_CUTOFF).count()


def test_tree_and_fold_jobs(spark, capsys):
    feats, labels, _ = _csvs(spark)
    assert main(["tree", feats, labels, "--depth", "4", "--bins", "16"]) == 0
    assert main(["show-fold", feats, labels, "--fold", "3", "--rows", "5"]) == 0
    text = capsys.readouterr().out
    assert "training rows: r " in text and "validation" in text


def test_least_squares_job_on_combined_file(spark, capsys):
    from foldwise.plans.training import join_labels
    from foldwise.sources.tables import ORDER_SPEC

    combined = scratch_path(spark, "cli-combined")
    write_csv(join_labels(order_features(spark, SF_SMALL), order_labels(spark, SF_SMALL), ORDER_SPEC), combined)
    assert main(["least-squares", combined]) == 0
    text = capsys.readouterr().out
    assert "(intercept) =" in text and "cross-validation: r " in text


def test_penalty_and_row_bags(spark, capsys):
    feats, labels, test = _csvs(spark)
    model, out = scratch_path(spark, "cli-model"), scratch_path(spark, "cli-out")
    assert main(["linear", feats, labels, "--scale", "--balanced", "--penalty", "l1", "--reg", "10", "1000"]) == 0
    assert main(["forest", feats, labels, "--trees", "2", "--depth", "3", "--bags", "row", "--model", model]) == 0
    assert main(["score", model, test, "--output", out]) == 0
    assert spark.read.text(out).count() == order_features(spark, SF_SMALL, since=SCORING_CUTOFF).count()
    text = capsys.readouterr().out
    assert "'penalty': 'l1'" in text and text.count("cross-validation: r ") == 2
