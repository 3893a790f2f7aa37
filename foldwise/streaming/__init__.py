"""Structured Streaming entry points (scoring only; the batch jobs have no stream form)."""

from .score import read_feature_stream, score_stream, write_prediction_stream

__all__ = ["read_feature_stream", "score_stream", "write_prediction_stream"]
