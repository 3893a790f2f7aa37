"""Regression metrics: correlation, MAE, MSE, RMSE and count in one aggregate.

Per group (e.g. ``grid_pos, fold``) all of them come from a single pass with
partial aggregation, instead of one job per metric. Fold results combine by
macro average (mean of per-fold values, the cluster programs) or pooled (one
aggregate over all held-out rows, the single-machine program).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import guarded_corr

METRICS = ("corr", "mae", "rmse")


def metric_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    err = y - p
    return [
        F.count(F.lit(1)).alias("n"),
        guarded_corr(y, p).alias("corr"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    ]


def regression_metrics(df: DataFrame, group_by: list[str] | tuple[str, ...] = (),
                       label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``group..., n, corr, mae, mse, rmse``."""
    cols = metric_columns(label, prediction)
    if group_by:
        return df.groupBy(*group_by).agg(*cols)
    return df.agg(*cols)


def macro_average(per_fold: DataFrame, group_by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Mean of the per-fold metrics; a null (undefined) fold makes the mean null."""
    def strict_avg(c: str) -> Column:
        return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c)).alias(c)

    aggs = [F.count(F.lit(1)).cast("int").alias("folds"),
            strict_avg("corr"), strict_avg("mae"), strict_avg("rmse")]
    if group_by:
        return per_fold.groupBy(*group_by).agg(*aggs)
    return per_fold.agg(*aggs)
