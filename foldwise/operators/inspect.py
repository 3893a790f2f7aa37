"""Inspection of frames: first rows (or all, in order), and the first rows of folds.

Nothing here collects: the results are lazy frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import inspect_fold_rows

DEFAULT_ROWS = 10


def first_rows(df: DataFrame, n: int = DEFAULT_ROWS, order_by: str | list[str] | None = "id") -> DataFrame:
    """The first ``n`` rows (by ``order_by`` for a stable answer); all rows for a negative ``n``.

    The frame is lazy either way; nothing is collected here.
    """
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df if n is None or n < 0 else df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def show_fold(df: DataFrame, n_folds: int, fold: int, rows: int = DEFAULT_ROWS,
              order_by: str = "id") -> DataFrame:
    """Both sides of one fold, ``rows`` rows each."""
    return inspect_fold_rows(df, n_folds, rows, order_by, only_fold=fold)


def show_folds(df: DataFrame, n_folds: int, rows: int = DEFAULT_ROWS, order_by: str = "id") -> DataFrame:
    """Both sides of every fold, ``rows`` rows each."""
    return inspect_fold_rows(df, n_folds, rows, order_by)
