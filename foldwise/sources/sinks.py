"""Sinks: prediction text lines and fitted models.

Predictions are written as ``id,prediction`` text lines, one part file per
partition, and the write fails if the path exists (the reference's text save).
A linear model is saved as a coefficient table (Parquet) plus its encoder; a tree
or forest by its own writer, with encoder and scaler beside it. An existing path
is reported and skipped; any other failure propagates.
"""

from __future__ import annotations

import json
import logging

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.columns import join_fields
from ..operators.trees import BaggedForestModel

log = logging.getLogger(__name__)


def prediction_lines(df: DataFrame, id_col: str = "id", prediction: str = "prediction") -> DataFrame:
    """``value`` = ``id,prediction`` text line per row."""
    return df.select(join_fields(id_col, prediction).alias("value"))


def write_predictions(df: DataFrame, path: str, id_col: str = "id",
                      prediction: str = "prediction") -> None:
    prediction_lines(df, id_col, prediction).write.mode("errorifexists").text(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Read ``id,prediction`` lines back as ``id string, prediction double``."""
    parts = F.split(F.col("value"), ",", -1)
    return spark.read.text(path).select(parts[0].alias("id"), parts[1].cast("double").alias("prediction"))


def _already_exists(err: Exception) -> bool:
    text = str(err)
    return "PATH_ALREADY_EXISTS" in text or "already exists" in text


def save_linear_model(spark: SparkSession, model, names: list[str], path: str,
                      encoder_json: str | None = None) -> bool:
    """Coefficients as Parquet ``slot, feature, coefficient`` (slot -1: intercept) and the encoder
    as JSON. False if the path exists."""
    rows = [(i - 1, n, c) for i, (n, c) in enumerate(model.coefficient_rows(names))]
    frame = spark.createDataFrame(rows, "slot int, feature string, coefficient double")
    try:
        frame.coalesce(1).write.mode("errorifexists").parquet(f"{path}/coefficients")
    except AnalysisException as err:
        if _already_exists(err):
            log.warning("model not saved: %s already exists", path)
            return False
        raise
    _write_json(spark, f"{path}/encoder", encoder_json)
    return True


def load_linear_model(spark: SparkSession, path: str):
    """(model, encoder or None if it was saved without); a missing part raises."""
    from ..operators.encode import Encoder
    from ..operators.linear import LinearModel

    rows = spark.read.parquet(f"{path}/coefficients").orderBy("slot").collect()
    text = _read_json(spark, f"{path}/encoder")
    coef = np.array([r["coefficient"] for r in rows if r["slot"] >= 0])
    intercept = next(r["coefficient"] for r in rows if r["slot"] == -1)
    return LinearModel(coef, intercept), Encoder.from_json(json.dumps(text)) if text else None


def save_ml_model(model, path: str, encoder=None, scaler=None) -> bool:
    """Save a tree or forest with its encoder and scaler as one bundle; False (and a warning) if
    the path exists."""
    from pyspark.sql import SparkSession

    trees = model.trees if isinstance(model, BaggedForestModel) else None
    try:
        if trees is None:
            model.write().save(f"{path}/model")
        for i, tree in enumerate(trees or []):
            tree.write().save(f"{path}/model/tree-{i}")
    except Exception as err:  # py4j wraps the Hadoop exception
        if _already_exists(err):
            log.warning("model not saved: %s already exists", path)
            return False
        raise
    _write_json(SparkSession.getActiveSession(), f"{path}/parts", json.dumps({
        "class": type(model).__name__, "trees": len(trees or []),
        "encoder": json.loads(encoder.to_json()) if encoder is not None else None,
        "scaler": None if scaler is None else {
            "means": list(map(float, scaler.means)), "stds": list(map(float, scaler.stds)),
            "n": int(scaler.n), "label_mean": float(scaler.label_mean)}}))
    return True


def load_ml_model(spark: SparkSession, path: str):
    """(model, encoder, scaler) of a bundle; parts it was saved without are None."""
    import pyspark.ml.regression as R

    from ..operators.encode import Encoder
    from ..operators.scale import Scaler

    parts = _read_json(spark, f"{path}/parts")
    if parts["class"] == BaggedForestModel.__name__:
        model = BaggedForestModel([R.RandomForestRegressionModel.load(f"{path}/model/tree-{i}") for i in range(parts["trees"])])
    else:
        model = getattr(R, parts["class"]).load(f"{path}/model")
    enc = Encoder.from_json(json.dumps(parts["encoder"])) if parts["encoder"] else None
    sc = parts["scaler"]
    scaler = sc and Scaler(np.array(sc["means"]), np.array(sc["stds"]), sc["n"], sc["label_mean"])
    return model, enc, scaler


def load_model(spark: SparkSession, path: str):
    """(model, encoder, scaler) of a saved model of any kind."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/coefficients")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(root):
        return *load_linear_model(spark, path), None
    return load_ml_model(spark, path)


def _write_json(spark: SparkSession, path: str, text: str | None) -> None:
    spark.createDataFrame([(text or "null",)], "value string").coalesce(1).write.text(path)


def _read_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))
