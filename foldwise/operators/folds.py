"""k-fold assignment and the train/validation views of a fold.

A fold is a column, not k separate datasets: the training side of fold k is
``fold != k`` and the validation side ``fold == k`` over the same (materialised)
table, so there are no unions and no k-fold copies of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fold_of


def assign_folds(df: DataFrame, k: int, id_col: str = "id", seed: int | None = None,
                 fold_col: str = "fold") -> DataFrame:
    """Add ``fold`` in ``[0, k)`` from a hash of the id (deterministic)."""
    return df.withColumn(fold_col, fold_of(id_col, k, seed))


# Hexadecimal digits of the hash that name a block of ids, and blocks of the rows of one id.
BLOCK_DIGITS = 4
ROW_BLOCKS = 256


def _running(df: DataFrame, block: list[str], order: list[str], weight: str, out: str) -> DataFrame:
    """``out`` = the sum of ``weight`` over the rows before each row, in the order of ``block`` and then
    ``order``: a running sum within the block plus the sums of the blocks before it."""
    outer, inner = block[:-1], block[-1]
    sums = df.groupBy(*block).agg(F.sum(weight).alias("_block"))
    before = Window.partitionBy(*outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*block, F.coalesce(F.sum("_block").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(base, block)
            .withColumn(out, F.col("_base") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
            .drop("_base"))


def assign_balanced_folds(df: DataFrame, k: int, id_col: str = "id", seed: int = 1,
                          fold_col: str = "fold") -> DataFrame:
    """Add ``fold`` = global rank mod ``k``: fold sizes differ by one row at most.

    Rows are ranked by the md5 of seed and id, then id, then by a hash of the row. The rank is
    built from sums over blocks, so no task sorts more than a block: ids (with their row counts) lie in
    blocks by the first digits of their hash; the rows of a repeated id in blocks by the hash of
    the row, so an id that holds a third of the rows is spread; equal rows are one group with a
    count. It depends on the rows alone, not on partitions or retries. A null id ranks as an empty
    one. Columns must be groupable (no maps).
    """
    cols = df.columns
    key, h, row, m, start, at = (f"_{x}" for x in ("key", "h", "row", "m", "start", "at"))
    rows = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(m))
            .withColumn(key, F.coalesce(F.col(id_col).cast("string"), F.lit(""))).withColumn(row, F.xxhash64(*cols)))
    ids = (rows.groupBy(key).agg(F.sum(m).alias("_n"), F.count(F.lit(1)).alias("_groups"))
           .withColumn(h, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))))
           .withColumn("_all", F.lit(0)).withColumn("_b", F.substring(h, 1, BLOCK_DIGITS)))
    ids = _running(ids, ["_all", "_b"], [h, key], "_n", start).select(key, "_groups", start)
    placed = rows.join(ids, key)
    # one group of equal rows: it starts where its id starts; else the rows before it in the id count too
    single = placed.filter("_groups = 1").withColumn(at, F.col(start))
    several = placed.filter("_groups > 1").withColumn("_rb", F.pmod(F.col(row), F.lit(ROW_BLOCKS)))
    several = (_running(several, [key, "_rb"], [row, *cols], m, at).withColumn(at, F.col(at) + F.col(start))
               .drop("_rb"))
    ranked = single.unionByName(several).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col(m) - 1)))
    return ranked.withColumn(fold_col, ((F.col(at) + F.col("_copy")) % k).cast("int")).select(*cols, fold_col)


def assign_random_folds(df: DataFrame, k: int, seed: int, fold_col: str = "fold") -> DataFrame:
    """Add ``fold`` from a seeded uniform draw (equal weights, like a random split).

    Reproducible only for the same input partitioning; prefer :func:`assign_folds`.
    """
    return df.withColumn(fold_col, F.least(F.floor(F.rand(seed) * k), F.lit(k - 1)).cast("int"))


def fold_split(df: DataFrame, k: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train, validation) of fold ``k``."""
    return df.filter(F.col(fold_col) != k), df.filter(F.col(fold_col) == k)


def fold_pairs(df: DataFrame, n_folds: int, fold_col: str = "fold") -> list[tuple[DataFrame, DataFrame]]:
    """All k (train, validation) pairs, each a filter over the same table."""
    return [fold_split(df, k, fold_col) for k in range(n_folds)]


def fold_sides(df: DataFrame, n_folds: int, fold_col: str = "fold") -> DataFrame:
    """Long form of all k pairs: every row once per fold it belongs to.

    ``(cv_fold, side)`` with side ``train`` for the k-1 folds a row trains and
    ``validation`` for its own; k rows per input row, no shuffle.
    """
    folds = F.sequence(F.lit(0), F.lit(n_folds - 1))
    return (df.withColumn("cv_fold", F.explode(folds))
            .withColumn("side", F.when(F.col("cv_fold") == F.col(fold_col), F.lit("validation"))
                        .otherwise(F.lit("train"))))


def inspect_fold_rows(df: DataFrame, n_folds: int, rows_per_side: int = 10,
                      order_by: str = "id", fold_col: str = "fold",
                      only_fold: int | None = None) -> DataFrame:
    """First ``rows_per_side`` rows (by ``order_by``) of each side of each fold.

    Top-n per group without k copies of the table: validation rows are the
    top-n within the row's own fold; training rows of fold k are the top-n
    among rows of all other folds, which are always within the top-(n) of
    their own folds' union, so only the top-n per fold are expanded.
    """
    w_own = Window.partitionBy(fold_col).orderBy(order_by)
    head = df.withColumn("_rn", F.row_number().over(w_own)).filter(F.col("_rn") <= rows_per_side)
    sides = fold_sides(head.drop("_rn"), n_folds, fold_col)
    if only_fold is not None:
        sides = sides.filter(F.col("cv_fold") == only_fold)
    w_side = Window.partitionBy("cv_fold", "side").orderBy(order_by)
    return (sides.withColumn("rn", F.row_number().over(w_side).cast("int"))
            .filter(F.col("rn") <= rows_per_side))
