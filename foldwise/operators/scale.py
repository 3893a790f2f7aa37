"""Standard scaling of the encoded feature array.

Fit is one aggregate (mean and sample standard deviation of every slot, plus
the label mean used to centre the moments); transform is a list of literal
arithmetic expressions. A constant column (standard deviation 0) maps to 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Scaler:
    means: np.ndarray
    stds: np.ndarray
    n: int = 0
    label_mean: float = 0.0

    @property
    def width(self) -> int:
        return len(self.means)

    def columns(self, features: str = "f") -> list[Column]:
        out = []
        for i, (m, s) in enumerate(zip(self.means, self.stds)):
            x = F.col(features)[i]
            if s > 0 and np.isfinite(s):
                out.append((x - F.lit(float(m))) / F.lit(float(s)))
            else:
                out.append(F.lit(0.0))
        return out

    def transform(self, df: DataFrame, features: str = "f", out: str | None = None) -> DataFrame:
        """Replace (or add as ``out``) the feature array by its standardised form."""
        target = out or features
        return df.withColumn(target, F.array(*self.columns(features)))

    def frame(self, spark, names: list[str]) -> DataFrame:
        rows = [(n, float(m), float(s)) for n, m, s in zip(names, self.means, self.stds)]
        return spark.createDataFrame(rows, "feature string, mean double, std double")


def column_stats(df: DataFrame, width: int, features: str = "f",
                 label: str | None = None) -> DataFrame:
    """One-row frame: ``n``, ``mean_i``, ``std_i`` per slot (and the label mean)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(width):
        aggs.append(F.avg(F.col(features)[i]).alias(f"mean_{i}"))
        aggs.append(F.stddev_samp(F.col(features)[i]).alias(f"std_{i}"))
    if label is not None:
        aggs.append(F.avg(F.col(label)).alias("label_mean"))
    return df.agg(*aggs)
