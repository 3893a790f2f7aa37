"""The variance-reduction split scan, kept as a query of its own.

``best_splits`` computes, for every feature, the binary split ``x <= t`` that
maximises the variance reduction of the label over *all* distinct values, with
thresholds at midpoints between neighbouring values. The tree trainers do not
use it. It is a two-level prefix sum:

1. ``(feature, value) -> (n, sum y)`` by a grouped aggregate;
2. each feature's value range is cut into blocks at approximate quantiles,
   block totals are summed, and their offsets come from a window over the
   (features x blocks) block table;
3. running sums inside each block come from a window over one block.

No window ever holds more than one block, so a feature with billions of
distinct values is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 1_000_000
# cap for the broadcast table of block boundaries in the split scan
MAX_BOUNDS_BYTES = 32 << 20


def long_features(df: DataFrame, names: list[str] | None = None, features: str = "f",
                  label: str = "label") -> DataFrame:
    """``feature, value, label`` with one row per (row, feature slot)."""
    out = df.select(F.posexplode(features).alias("pos", "value"), F.col(label).alias("label"))
    if names is not None:
        lookup = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
        return out.select(lookup[F.col("pos")].alias("feature"), "value", "label")
    return out.select(F.col("pos").cast("string").alias("feature"), "value", "label")


def long_columns(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """``feature, value, label`` from plain numeric columns (an unpivot)."""
    return (df.select(*[F.col(c).cast("double").alias(c) for c in columns],
                      F.col(label).cast("double").alias("label"))
            .unpivot(["label"], columns, "feature", "value"))


def value_stats(long: DataFrame) -> DataFrame:
    """``feature, value, n, s``: count and label sum per distinct value."""
    return long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))


def _blocks(stats: DataFrame, rows_per_block: int) -> tuple[DataFrame, int]:
    counts = stats.groupBy("feature").agg(F.count(F.lit(1)).alias("nd"))
    top, n_features = counts.agg(F.max("nd"), F.count(F.lit(1))).collect()[0]
    top, n_features = top or 0, n_features or 0
    # the broadcast bounds table holds features x blocks doubles: keep it under the cap
    max_blocks = max(1, MAX_BOUNDS_BYTES // (8 * max(1, n_features)))
    n_blocks = min(max(1, math.ceil(top / rows_per_block)), max_blocks)
    if n_blocks == 1:
        return stats.withColumn("block", F.lit(0)), 1
    fractions = [i / n_blocks for i in range(1, n_blocks)]
    bounds = stats.groupBy("feature").agg(
        F.percentile_approx("value", fractions, 10 * n_blocks).alias("bounds"))
    # bounds: features x (blocks - 1) doubles, bounded by the block count
    blocked = stats.join(F.broadcast(bounds), "feature").withColumn(
        "block", F.size(F.filter("bounds", lambda b: b < F.col("value")))).drop("bounds")
    return blocked, n_blocks


def split_candidates(stats: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Every midpoint threshold with its left/right counts and label sums."""
    blocked, _ = _blocks(stats, rows_per_block)
    tot = blocked.groupBy("feature", "block").agg(
        F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.min("value").alias("bfirst"))
    wb = Window.partitionBy("feature").orderBy("block")
    offsets = tot.select(
        "feature", "block",
        (F.sum("bn").over(wb) - F.col("bn")).alias("off_n"),
        (F.sum("bs").over(wb) - F.col("bs")).alias("off_s"),
        F.lead("bfirst").over(wb).alias("next_block_first"),
        F.sum("bn").over(Window.partitionBy("feature")).alias("N"),
        F.sum("bs").over(Window.partitionBy("feature")).alias("S"),
    )
    wi = Window.partitionBy("feature", "block").orderBy("value")
    wr = wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = blocked.select(
        "feature", "block", "value",
        F.sum("n").over(wr).alias("cn"), F.sum("s").over(wr).alias("cs"),
        F.lead("value").over(wi).alias("next_value"),
    )
    # offsets has features x blocks rows: broadcasting it is bounded
    j = inner.join(F.broadcast(offsets), ["feature", "block"])
    nxt = F.coalesce(F.col("next_value"), F.col("next_block_first"))
    return j.select(
        "feature",
        ((F.col("value") + nxt) / 2).alias("threshold"),
        (F.col("off_n") + F.col("cn")).alias("n_left"),
        (F.col("N") - F.col("off_n") - F.col("cn")).alias("n_right"),
        (F.col("off_s") + F.col("cs")).alias("s_left"),
        (F.col("S") - F.col("off_s") - F.col("cs")).alias("s_right"),
        "N",
    ).filter(nxt.isNotNull())


def variance_reduction(n_left: Column, n_right: Column, s_left: Column, s_right: Column,
                       n: Column) -> Column:
    """Impurity decrease of a split: nL*nR/n^2 * (mean_L - mean_R)^2."""
    diff = s_left / n_left - s_right / n_right
    return n_left * n_right / (n * n) * diff * diff


def best_splits(long: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``feature, threshold, n_left, n_right, gain, gain_ratio`` — the best split per feature.

    ``gain`` is the variance reduction, ``gain_ratio`` the same divided by the
    feature's label variance (the share of variance a depth-1 tree explains).
    Ties go to the smaller threshold. Both picks are plain aggregates.
    """
    stats = value_stats(long)
    cand = split_candidates(stats, rows_per_block).withColumn(
        "gain", variance_reduction(F.col("n_left"), F.col("n_right"), F.col("s_left"),
                                   F.col("s_right"), F.col("N")))
    var = long.groupBy("feature").agg(F.var_pop("label").alias("var"))
    best = cand.groupBy("feature").agg(
        F.max(F.struct(F.col("gain"), (-F.col("threshold")).alias("neg_t"),
                       F.col("n_left"), F.col("n_right"))).alias("b"))
    return best.join(var, "feature").select(
        "feature", (-F.col("b.neg_t")).alias("threshold"),
        F.col("b.n_left").alias("n_left"), F.col("b.n_right").alias("n_right"),
        F.col("b.gain").alias("gain"),
        (F.col("b.gain") / F.nullif(F.col("var"), F.lit(0.0))).alias("gain_ratio"))
