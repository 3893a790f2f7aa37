"""Refit on all rows, training error, and scoring of new tables.

A linear model is applied as a column expression over the raw encoded array
(coefficients are literals), so scoring is a single map stage with no join and
no Python. ``pyspark.ml`` models are applied with ``transform``. Ids stay a
column from the scan to the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..operators.encode import Encoder
from ..operators.linear import LinearModel
from ..operators.metrics import regression_metrics
from .training import TrainingTable, scoring_frame


def linear_predictions(df: DataFrame, model: LinearModel, rounded: bool = True,
                       keep: tuple[str, ...] = ("id", "label")) -> DataFrame:
    raw = model.prediction("f")
    pred = round_half_up(raw) if rounded else raw
    return df.select(*[c for c in keep if c in df.columns], raw.alias("raw_prediction"),
                     pred.alias("prediction"))


def ml_predictions(df: DataFrame, model, rounded: bool = True, scaler=None,
                   keep: tuple[str, ...] = ("id", "label")) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    src = scaler.transform(df) if scaler is not None else df
    data = src.select(*[c for c in keep if c in df.columns], array_to_vector("f").alias("features"))
    out = model.transform(data).withColumnRenamed("prediction", "raw_prediction")
    pred = round_half_up("raw_prediction") if rounded else F.col("raw_prediction")
    return out.select(*[c for c in keep if c in df.columns], "raw_prediction", pred.alias("prediction"))


def predictions(df: DataFrame, model, rounded: bool = True, scaler=None,
                keep: tuple[str, ...] = ("id", "label")) -> DataFrame:
    if isinstance(model, LinearModel):
        return linear_predictions(df, model, rounded, keep)
    return ml_predictions(df, model, rounded, scaler, keep)


def training_error(tt: TrainingTable, model, rounded: bool = True, scaler=None) -> DataFrame:
    """Metrics of the refitted model on its own training rows (one row)."""
    return regression_metrics(predictions(tt.df, model, rounded, scaler))


def score_table(features: DataFrame, encoder: Encoder, model, rounded: bool = True,
                scaler=None) -> DataFrame:
    """``id, prediction, unseen_levels`` for an unlabelled feature table.

    The encoder (and scaler) fitted on the training table are reused, so the
    columns mean the same thing as in training; levels unseen in training count
    in ``unseen_levels`` and encode as the baseline.
    """
    sf = scoring_frame(features, encoder)
    spec = encoder.spec
    sf = sf.withColumnRenamed(spec.id, "id") if spec.id != "id" else sf
    pred = predictions(sf, model, rounded, scaler, keep=("id", "unseen_levels"))
    return pred.select("id", "prediction", "unseen_levels")
