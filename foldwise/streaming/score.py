"""Scoring of a feature stream with a model fitted in batch.

The reference has no streaming; its scoring step (fitted encoder + model ->
``id,prediction`` lines) is stateless per row, so the same column expressions
run unchanged on a Structured Streaming source. No state, no watermark: each
micro-batch is a map over new files, and the file sink with a checkpoint that
belongs to its output path gives exactly-once output across restarts and lost
executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.encode import Encoder
from ..plans.score import score_table
from ..sources.sinks import prediction_lines


def read_feature_stream(spark: SparkSession, path: str, encoder: Encoder, fmt: str = "csv",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """New feature files under ``path`` as a stream, with the declared schema."""
    spec = encoder.spec
    reader = spark.readStream.schema(spec.feature_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def score_stream(stream: DataFrame, encoder: Encoder, model, rounded: bool = True) -> DataFrame:
    """``id, prediction, unseen_levels`` for every streamed feature row."""
    return score_table(stream, encoder, model, rounded)


def write_prediction_stream(scored: DataFrame, path: str, checkpoint: str | None = None,
                            available_now: bool = True) -> StreamingQuery:
    """Write ``id,prediction`` text lines.

    The checkpoint belongs to the output: by default it is ``_checkpoint`` below
    it (readers skip such names), so that a restart with the same path goes on
    where the last run stopped.
    """
    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoint"
    writer = (prediction_lines(scored).writeStream.format("text")
              .option("path", path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
