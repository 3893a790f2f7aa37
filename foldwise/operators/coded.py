"""Designs with many levels: codes instead of a dense array, and their moments.

A coded row holds ``slots array<bigint>`` (the dummy slot of each nominal column, -1 for the baseline)
and ``x array<double>`` (the numeric columns), so its size grows with the number of columns, not of
levels. Sparse vectors are made only for an estimator.

Moments of coded rows are contingency tables: a dummy's products with the numeric columns are the
count and the means of the rows that hold its level, two dummies' product is the count of rows that hold
both. Each row adds c levels and c (c - 1) / 2 pairs to two aggregates (c nominal columns), whatever
the number of levels; zeros are never formed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dictionary import LevelDictionary
from .moments import Moments, Summary, collect_summaries, fold_summaries, scaler_of
from .scale import Scaler

#: Widest design whose moments are put together as dense matrices on the driver.
MAX_DENSE_WIDTH = 4096


def coded_rows(df: DataFrame, dictionary: LevelDictionary, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep``, ``slots``, ``x`` and ``unseen_levels`` of feature rows."""
    from .encode import numeric_value

    spec = dictionary.spec
    x = (F.array(*[numeric_value(c) for c in spec.numeric]) if spec.numeric
         else F.array().cast("array<double>"))
    rows = dictionary.with_codes(df)
    unseen = F.size(F.filter("codes", lambda k: k < 0))
    slots = dictionary.slots() if spec.nominal else F.col("codes")
    return rows.select(*keep, slots.alias("slots"), x.alias("x"), unseen.alias("unseen_levels"))


def level_means(rows: DataFrame, n_numeric: int) -> DataFrame:
    """``fold, slot, n, mean array<double>`` (of the numeric columns and the label) of the rows that
    hold a slot's level."""
    means = [F.avg(F.col("x")[i]) for i in range(n_numeric)] + [F.avg("label")]
    return (rows.select("fold", "x", "label", F.explode("slots").alias("slot")).filter("slot >= 0")
            .groupBy("fold", "slot").agg(F.count(F.lit(1)).alias("n"), *[m.alias(f"m{i}") for i, m in enumerate(means)])
            .select("fold", "slot", "n", F.array(*[F.col(f"m{i}") for i in range(len(means))]).alias("mean")))


def pair_counts(rows: DataFrame, n_nominal: int) -> DataFrame:
    """``fold, a, b, n``: rows that hold the levels of two slots, ``a < b``; pairs that never meet are
    not listed."""
    pairs = [F.struct(F.col("slots")[i].alias("a"), F.col("slots")[j].alias("b"))
             for i in range(n_nominal) for j in range(i + 1, n_nominal)]
    if not pairs:
        return rows.sparkSession.createDataFrame([], "fold int, a bigint, b bigint, n bigint")
    return (rows.select("fold", F.explode(F.array(*pairs)).alias("p")).select("fold", "p.a", "p.b")
            .filter("a >= 0 AND b >= 0").groupBy("fold", "a", "b").agg(F.count(F.lit(1)).alias("n")))


@dataclass
class CodedMoments:
    """A design's moments by fold: the numeric block as summaries, the rest as sparse tables."""
    dictionary: LevelDictionary
    numeric: dict[int, Summary]    # over (x, label)
    levels: DataFrame
    pairs: DataFrame

    def summaries(self) -> dict[int, Summary]:
        """Dense summaries over (dummies, x, label), for designs of at most ``MAX_DENSE_WIDTH`` slots."""
        nd, width = self.dictionary.dummy_width, self.dictionary.width
        if width > MAX_DENSE_WIDTH:
            raise ValueError(f"{width} slots are too many for dense moments (at most {MAX_DENSE_WIDTH})")
        counts = {k: np.zeros(nd) for k in self.numeric}
        out = {}
        for k, s in self.numeric.items():
            cross = np.zeros((width + 1, width + 1))
            cross[nd:, nd:] = s.cross
            out[k] = Summary(s.n, np.concatenate([np.zeros(nd), s.mean]), cross)
        for r in self.levels.toLocalIterator():
            k, j, n = r["fold"], r["slot"], float(r["n"])
            s = out[k]
            counts[k][j] = n
            s.mean[j] = n / s.n
            s.cross[j, j] += n
            s.cross[j, nd:] = s.cross[nd:, j] = n * (np.array(r["mean"]) - s.mean[nd:])
        for r in self.pairs.toLocalIterator():
            out[r["fold"]].cross[r["a"], r["b"]] += r["n"]
            out[r["fold"]].cross[r["b"], r["a"]] += r["n"]
        for k, s in out.items():  # centred: the count of both less the product of the counts
            s.cross[:nd, :nd] -= np.outer(counts[k], counts[k]) / s.n
        return out

    def standardised(self) -> tuple[Scaler, dict[int, Moments]]:
        """The scaler and the moments by fold that the linear fits use."""
        dense = self.summaries()
        scaler = scaler_of(dense, self.dictionary.width)
        return scaler, {k: s.moments(scaler) for k, s in dense.items()}


def coded_moments(rows: DataFrame, dictionary: LevelDictionary) -> CodedMoments:
    """Moments by fold of ``rows`` (``fold, label, slots, x``)."""
    p = len(dictionary.spec.numeric)
    return CodedMoments(dictionary, collect_summaries(fold_summaries(rows, p, "x")),
                        level_means(rows, p), pair_counts(rows, len(dictionary.spec.nominal)))


def sparse_vectors(rows: DataFrame, dictionary: LevelDictionary, out: str = "features") -> DataFrame:
    """Add the sparse vector (dummies, then numeric columns) that a ``pyspark.ml`` estimator takes.

    The level's place within its column is one-hot coded by the estimator library's own encoder, which reads
    the number of levels from the column's metadata (no pass over the rows). The baseline and unknown
    levels are the last category, which the encoder drops.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    spec, offsets = dictionary.spec, dictionary.offsets
    frame, cats, hots, nums = rows, [], [], []
    for i, c in enumerate(spec.nominal):
        dummies = dictionary.sizes.get(c, 0) - 1
        if dummies < 1:
            continue
        slot = F.col("slots")[i]
        cat = F.when(slot >= 0, slot - offsets[c]).otherwise(dummies).cast("double")
        meta = {"ml_attr": {"type": "nominal", "num_vals": dummies + 1, "name": f"_cat_{i}"}}
        frame = frame.withColumn(f"_cat_{i}", cat.alias(f"_cat_{i}", metadata=meta))
        cats.append(f"_cat_{i}")
        hots.append(f"_hot_{i}")
    for i in range(len(spec.numeric)):
        frame = frame.withColumn(f"_num_{i}", F.col("x")[i])
        nums.append(f"_num_{i}")
    if cats:
        frame = OneHotEncoder(inputCols=cats, outputCols=hots, dropLast=True).fit(frame).transform(frame)
    frame = VectorAssembler(inputCols=[*hots, *nums], outputCol=out).transform(frame)
    return frame.drop(*cats, *hots, *nums)
