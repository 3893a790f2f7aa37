"""Parameter grids: the product of two value lists, first list outer.

``grid_pos`` numbers the points in that order; ties in model selection go to
the lowest position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The search grids and defaults of the reference programs.
LINEAR_ITERATIONS = list(range(100, 1000, 100))        # 100, 200, ..., 900
LINEAR_STEPS = [1e-4, 1e-3, 1e-2, 1e-1, 1.0]
LINEAR_DEFAULT = (200, 1.0)
TREE_DEPTHS = list(range(5, 30, 1))                    # 5, 6, ..., 29
TREE_BINS = [16, 20, 22, 24, 26, 28, 30, 32, 34, 36, 40]
TREE_DEFAULT = (12, 16)
FOREST_TREES = list(range(12, 21, 2))                  # 12, 14, 16, 18, 20
FOREST_DEPTHS = list(range(12, 21, 2))                 # 12, 14, 16, 18, 20
FOREST_DEFAULT = (20, 18)
FOREST_BINS = 32
N_FOLDS = 10


def param_grid(first: list, second: list) -> list[tuple[int, object, object]]:
    """``[(grid_pos, a, b)]`` for a in first (outer) and b in second (inner)."""
    return [(i, a, b) for i, (a, b) in enumerate((a, b) for a in first for b in second)]


def grid_by_fold(spark: SparkSession, first: list, second: list, n_folds: int,
                 names: tuple[str, str] = ("p1", "p2"),
                 types: tuple[str, str] = ("double", "double")) -> DataFrame:
    """Every point of the grid once per fold: ``grid_pos, fold, p1, p2``.

    Joined to the data on ``fold`` (an equi-join against a table whose size is
    points x folds), this attaches to every row exactly the parameter points it
    must be scored under.
    """
    rows = [(g, k, a, b) for g, a, b in param_grid(first, second) for k in range(n_folds)]
    return spark.createDataFrame(
        rows, f"grid_pos int, fold int, {names[0]} {types[0]}, {names[1]} {types[1]}")
