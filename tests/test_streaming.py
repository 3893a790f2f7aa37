"""Streamed scoring gives the same lines as batch scoring."""

from __future__ import annotations

from sample_tables import SF_SMALL
from foldwise.operators.linear import fit_ols
from foldwise.operators.moments import total
from foldwise.plans.score import score_table
from foldwise.plans.select import fold_moments
from foldwise.plans.training import prepare_training
from foldwise.session import scratch_path
from foldwise.sources.csv import write_csv
from foldwise.sources.sinks import prediction_lines
from foldwise.sources.tables import ORDER_SPEC, SCORING_CUTOFF, order_features, order_labels
from foldwise.streaming.score import read_feature_stream, score_stream, write_prediction_stream


def test_stream_scoring_matches_batch(spark):
    tt = prepare_training(order_features(spark, SF_SMALL, before=SCORING_CUTOFF),
                          order_labels(spark, SF_SMALL), ORDER_SPEC)
    model = fit_ols(total(fold_moments(tt), tt.width), tt.scaler)
    later = order_features(spark, SF_SMALL, since=SCORING_CUTOFF)
    src = scratch_path(spark, "stream-src")
    write_csv(later.withColumn("id", later.id.cast("string")).repartition(3), src)

    stream = read_feature_stream(spark, src, tt.encoder, max_files_per_trigger=1)
    out = scratch_path(spark, "stream-out")
    q = write_prediction_stream(score_stream(stream, tt.encoder, model), out)
    q.awaitTermination(120)
    streamed = sorted(r.value for r in spark.read.text(out).collect())

    batch = sorted(r.value for r in prediction_lines(score_table(later, tt.encoder, model)).collect())
    assert streamed == batch and len(batch) > 0


def test_restarted_stream_goes_on(spark):
    tt = prepare_training(order_features(spark, SF_SMALL, before=SCORING_CUTOFF),
                          order_labels(spark, SF_SMALL), ORDER_SPEC)
    model = fit_ols(total(fold_moments(tt), tt.width), tt.scaler)
    later = order_features(spark, SF_SMALL, since=SCORING_CUTOFF)
    later = later.withColumn("id", later.id.cast("string"))
    src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    for run in range(2):
        write_csv(later.filter(f"pmod(hash(id), 2) = {run}"), f"{src}/{run}")
        stream = read_feature_stream(spark, f"{src}/*", tt.encoder)
        write_prediction_stream(score_stream(stream, tt.encoder, model), out).awaitTermination(120)
    batch = sorted(r.value for r in prediction_lines(score_table(later, tt.encoder, model)).collect())
    assert sorted(r.value for r in spark.read.text(out).collect()) == batch
