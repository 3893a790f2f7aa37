"""Additive moments of the design, one summary per fold.

For z = (x - mean) / std and v = y - mean label a fold's moments are
``G = sum u u^T`` over u = (z, 1), ``h = sum u v`` and ``sum v^2``. They are
additive, so the training side of fold k is ``total - fold k`` and every linear
fit of a cross-validation (any fold, any parameter point, gradient descent or
least squares) comes from one pass over the data.

The pass computes, per partition and fold, the row count, the mean and the
centred cross products of (x, y) with numpy on the flat Arrow buffer of the
features, one row each. Summaries are merged pairwise (Chan, Golub and LeVeque),
which is stable at any offset of the data and needs no shift beforehand. Two
levels of merging keep the fan-in at about the square root of the number of
partitions; a fold that holds a third of the rows costs nothing extra. The
folds come to the driver one at a time, (d + 1)(d + 2) / 2 numbers each. Scaler
and standardised moments follow algebraically. There is one form for every width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import let_workers_import
from .scale import Scaler

MERGE_GROUPS = 32   # first-level groups per fold


@dataclass
class Moments:
    """Augmented moments over u = (z, 1); ``G[-1, -1]`` is the row count."""
    G: np.ndarray
    h: np.ndarray
    vv: float

    @property
    def n(self) -> float:
        return float(self.G[-1, -1])

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.G - other.G, self.h - other.h, self.vv - other.vv)

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.G + other.G, self.h + other.h, self.vv + other.vv)

    @staticmethod
    def zero(d: int) -> "Moments":
        return Moments(np.zeros((d + 1, d + 1)), np.zeros(d + 1), 0.0)


@dataclass
class Summary:
    """Row count, mean and centred cross products of (x, y)."""
    n: float
    mean: np.ndarray
    cross: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> "Summary":
        mean = rows.mean(axis=0)
        centred = rows - mean
        return Summary(float(len(rows)), mean, centred.T @ centred)

    def merge(self, other: "Summary") -> "Summary":
        n = self.n + other.n
        delta = other.mean - self.mean
        return Summary(n, self.mean + delta * (other.n / n),
                       self.cross + other.cross + np.outer(delta, delta) * (self.n * other.n / n))

    def moments(self, scaler: Scaler) -> Moments:
        """Over z = (x - mean) / std (0 for a constant slot) and v = y - mean label."""
        d = scaler.width
        inv = np.where(scaler.stds > 0, 1.0 / np.where(scaler.stds > 0, scaler.stds, 1.0), 0.0)
        at = (self.mean[:d] - scaler.means) * inv
        v = self.mean[d] - scaler.label_mean
        G, h = np.empty((d + 1, d + 1)), np.empty(d + 1)
        G[:d, :d] = self.cross[:d, :d] * np.outer(inv, inv) + self.n * np.outer(at, at)
        G[:d, d] = G[d, :d] = self.n * at
        G[d, d] = self.n
        h[:d] = self.cross[:d, d] * inv + self.n * at * v
        h[d] = self.n * v
        return Moments(G, h, float(self.cross[d, d] + self.n * v * v))


_ROW = "fold int, part int, n double, mean array<double>, cross array<double>"


def _rows(summaries: dict[int, Summary], part: int) -> Iterator[pa.RecordBatch]:
    for fold, s in summaries.items():
        upper = s.cross[np.triu_indices(len(s.mean))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([fold], pa.int32()), pa.array([part], pa.int32()), pa.array([s.n], pa.float64()),
             pa.array([s.mean], pa.list_(pa.float64())), pa.array([upper], pa.list_(pa.float64()))],
            names=["fold", "part", "n", "mean", "cross"])


def _summary(n: float, mean: np.ndarray, upper: np.ndarray) -> Summary:
    cross = np.zeros((len(mean), len(mean)))
    cross[np.triu_indices(len(mean))] = upper
    return Summary(n, mean, cross + np.triu(cross, 1).T)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's summaries, merged by fold."""
    held: dict[int, Summary] = {}
    for b in batches:
        for i in range(b.num_rows):
            fold = b.column(0)[i].as_py()
            s = _summary(b.column(2)[i].as_py(), b.column(3)[i].values.to_numpy(),
                         b.column(4)[i].values.to_numpy())
            held[fold] = held[fold].merge(s) if fold in held else s
    yield from _rows(held, 0)


def fold_summaries(df: DataFrame, width: int, features: str = "f", label: str = "label",
                   fold: str = "fold") -> DataFrame:
    """One row per fold: ``fold, n, mean, cross`` of (features, label), ``cross`` as its upper
    triangle. Rows are merged wherever they meet; the number of first-level groups spreads a
    fold's partial rows over several tasks."""
    data = df.select(F.col(fold).cast("int").alias("fold"), F.col(features).alias("f"),
                     F.col(label).cast("double").alias("y"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held: dict[int, Summary] = {}
        for b in batches:
            if not b.num_rows:
                continue
            if b.column(0).null_count or b.column(2).null_count:
                raise ValueError("a training row has no fold or label")
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            xy = np.column_stack([x, b.column(2).to_numpy()])
            folds = b.column(0).to_numpy()
            for k in np.unique(folds).tolist():
                s = Summary.of(xy[folds == k])
                held[k] = held[k].merge(s) if k in held else s
        yield from _rows(held, TaskContext.get().partitionId() % MERGE_GROUPS)

    let_workers_import(df.sparkSession)
    parts = data.mapInArrow(partial, _ROW)
    some = parts.repartition("fold", "part").mapInArrow(_merged, _ROW)
    return some.repartition("fold").mapInArrow(_merged, _ROW).drop("part")


def collect_summaries(frame: DataFrame) -> dict[int, Summary]:
    """Fold -> :class:`Summary`, fetched one partition at a time."""
    return {r["fold"]: _summary(r["n"], np.asarray(r["mean"], float), np.asarray(r["cross"], float))
            for r in frame.toLocalIterator()}


def total(moments: dict[int, Moments], d: int) -> Moments:
    t = Moments.zero(d)
    for k in sorted(moments):
        t = t + moments[k]
    return t


def scaler_of(summaries: dict[int, Summary], width: int) -> Scaler:
    """Column means and sample standard deviations of all rows."""
    whole = None
    for k in sorted(summaries):
        whole = summaries[k] if whole is None else whole.merge(summaries[k])
    if whole is None:
        return Scaler(np.zeros(width), np.zeros(width), 0, 0.0)
    var = np.clip(np.diag(whole.cross)[:width], 0.0, None) / max(whole.n - 1.0, 1.0)
    return Scaler(whole.mean[:width].copy(), np.sqrt(var), int(whole.n), float(whole.mean[width]))


def fold_moments_one_pass(df: DataFrame, width: int, features: str = "f", label: str = "label",
                          fold: str = "fold") -> tuple[Scaler, dict[int, Moments]]:
    """Scaler and standardised per-fold moments from a single pass over ``df``."""
    summaries = collect_summaries(fold_summaries(df, width, features, label, fold))
    scaler = scaler_of(summaries, width)
    return scaler, {k: s.moments(scaler) for k, s in summaries.items()}


def fold_scaled_training(summaries: dict[int, Summary], width: int) -> dict[int, tuple[Scaler, Moments]]:
    """Per fold k, the scaler of the rows outside k and their moments in its units."""
    out = {}
    for k in summaries:
        rest = {j: s for j, s in summaries.items() if j != k}
        scaler = scaler_of(rest, width)
        out[k] = (scaler, total({j: s.moments(scaler) for j, s in rest.items()}, width))
    return out
