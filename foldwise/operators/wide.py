"""Least squares on wide coded designs by matrix-free conjugate gradients.

The systems of all folds (training rows of fold k: all others) and of the refit are solved together.
A step is one pass over the rows: with the systems' directions V as a d x systems matrix, every row adds
its centred design row times its own product with V, and only d x systems numbers leave a task, in
slices that are added up in parallel. No matrix of d x d numbers exists anywhere. Means, deviations and
right-hand sides come from the design's contingency tables (:mod:`~foldwise.operators.coded`).

The equations are those of :func:`~foldwise.operators.linear.fit_ols`: columns divided by the training
rows' deviation, constant ones dropped, ``(Z'Z + ridge I) b = Z'y`` with ridge 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import let_workers_import
from .coded import CodedMoments
from .linear import LinearModel

REFIT = -1
#: Numbers of a slice that one task adds up.
SLICE = 1 << 16
#: The driver and each task hold a few vectors of slots x systems numbers of at most this size.
MAX_VECTOR_BYTES = 256 << 20


def _ragged(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _products(rows: DataFrame, nd: int, shift: np.ndarray, systems: list[int], W: np.ndarray,
              mu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over the rows of each system of (row - mu) times its product with the system's column of
    ``W``; numeric columns are shifted by ``shift`` first, ``mu`` is in shifted units."""
    d, K = W.shape
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast((W, (mu * W).sum(0)))
    keys = np.array(systems)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W, at_mean = held.value
        out, total = np.zeros((d, K)), np.zeros(K)
        for b in batches:
            if not b.num_rows:
                continue
            fold = b.column(0).to_numpy()
            slots, x = _ragged(b.column(1)).astype(np.int64), _ragged(b.column(2)).astype(float)
            t = np.zeros((b.num_rows, K)) - at_mean
            for j in range(slots.shape[1]):
                some = slots[:, j] >= 0
                t[some] += W[slots[some, j]]
            if d > nd:
                x = x - shift
                t += x @ W[nd:]
            t[fold[:, None] == keys[None]] = 0.0   # a fold's own rows do not train it
            for j in range(slots.shape[1]):
                some = np.flatnonzero(slots[:, j] >= 0)
                order = some[np.argsort(slots[some, j], kind="stable")]
                s = slots[order, j]
                if len(s):
                    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                    out[s[first]] += np.add.reduceat(t[order], first, axis=0)
            if d > nd:
                out[nd:] += x.T @ t
            total += t.sum(0)
        flat = np.append(out.ravel(), total)
        for i in range(0, len(flat), SLICE):
            part = flat[i:i + SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SLICE]), pa.array([part.tobytes()], pa.binary())],
                                                 ["slice", "v"])

    def added(t: pa.Table) -> pa.Table:
        v = sum(np.frombuffer(x, float) for x in t.column("v").to_pylist())
        return pa.table([t.column("slice").slice(0, 1), pa.array([v.tobytes()], pa.binary())], ["slice", "v"])

    let_workers_import(spark)
    sums = (rows.select("fold", "slots", "x").mapInArrow(partial, "slice bigint, v binary")
            .groupBy("slice").applyInArrow(added, "slice bigint, v binary"))
    flat = np.zeros(d * K + K)
    for r in sums.collect():
        v = np.frombuffer(bytes(r["v"]), float)
        flat[r["slice"] * SLICE:r["slice"] * SLICE + len(v)] = v
    held.unpersist()
    total = flat[d * K:]
    return flat[:d * K].reshape(d, K) - mu * total, total


def wide_least_squares(rows: DataFrame, moments: CodedMoments, ridge: float = 1e-8, tol: float = 1e-12,
                       max_steps: int = 500) -> dict[int, LinearModel]:
    """Least squares of every fold's training rows and, under the key -1, of all rows.

    ``rows`` holds ``fold, slots, x``. A system stops when its squared residual has fallen by
    ``tol`` squared, or after ``max_steps`` steps. Means come from one table of levels, read by
    partition.
    """
    nd, d = moments.dictionary.dummy_width, moments.dictionary.width
    folds = sorted(moments.numeric)
    if not folds:
        return {}
    systems = [*folds, REFIT]
    K = len(systems)
    if d * K * 8 > MAX_VECTOR_BYTES:
        raise ValueError(f"{d} slots x {K} systems are more than {MAX_VECTOR_BYTES} bytes a vector")
    whole = None
    for k in folds:
        whole = moments.numeric[k] if whole is None else whole.merge(moments.numeric[k])
    p = d - nd
    shift = whole.mean[:p]
    n_f = {k: moments.numeric[k].n for k in folds}
    # sums by fold: counts and label sums of the levels, numeric sums and cross products about the shift
    count, label = ({k: np.zeros(nd) for k in folds} for _ in range(2))
    for r in moments.levels.toLocalIterator():
        count[r["fold"]][r["slot"]] = r["n"]
        label[r["fold"]][r["slot"]] = r["n"] * (r["mean"][p] - whole.mean[p])
    mu, sd, rhs, ybar = np.zeros((d, K)), np.zeros((d, K)), np.zeros((d, K)), np.zeros(K)
    for i, k in enumerate(systems):
        train = [f for f in folds if f != k]
        n = sum(n_f[f] for f in train)
        if not n:
            continue
        part = None
        for f in train:
            part = moments.numeric[f] if part is None else part.merge(moments.numeric[f])
        c = sum((count[f] for f in train), np.zeros(nd))
        y = part.mean[p] - whole.mean[p]
        ybar[i] = part.mean[p]
        mu[:nd, i], mu[nd:, i] = c / n, part.mean[:p] - shift
        var = np.concatenate([c - c * c / n, np.diag(part.cross)[:p]]) / max(n - 1.0, 1.0)
        sd[:, i] = np.sqrt(np.clip(var, 0.0, None))
        rhs[:, i] = np.concatenate([sum((label[f] for f in train), np.zeros(nd)) - c * y, part.cross[:p, p]])
    keep = sd > 1e-12 * np.maximum(1.0, sd.max(axis=0, initial=0.0))
    inv = np.where(keep, 1.0 / np.where(keep, sd, 1.0), 0.0)
    r = rhs * inv
    x, v, rs = np.zeros((d, K)), r.copy(), (r * r).sum(0)
    goal, live = tol * tol * rs, rs > 0
    for _ in range(max_steps):
        if not live.any():
            break
        q, _ = _products(rows, nd, shift, systems, v * inv, mu)
        q = q * inv + ridge * v
        vq = (v * q).sum(0)
        step = np.where(live & (vq > 0), rs / np.where(vq > 0, vq, 1.0), 0.0)
        x += step * v
        r = r - step * q
        new = (r * r).sum(0)
        v = np.where(live, r + np.where(rs > 0, new / np.where(rs > 0, rs, 1.0), 0.0) * v, 0.0)
        rs = new
        live &= (rs > goal) & (vq > 0)
    out = {}
    for i, k in enumerate(systems):
        coef = x[:, i] * inv[:, i]
        means = mu[:, i] + np.concatenate([np.zeros(nd), shift])
        out[k] = LinearModel(coef, float(ybar[i] - coef @ means) if sum(n_f[f] for f in folds if f != k) else float("nan"))
    return out


def coded_predictions(rows: DataFrame, models: dict[int, LinearModel], nd: int,
                      keep: tuple[str, ...] = ("id", "label", "fold")) -> DataFrame:
    """``keep`` and ``raw_prediction`` of each row under its own fold's model (under the only model if
    there is one): the model's coefficients at the row's slots, no wide row is formed."""
    spark = rows.sparkSession
    keys = sorted(models)
    size = sum(m.coef.nbytes for m in models.values())
    if size > MAX_VECTOR_BYTES:
        raise ValueError(f"models of {size} bytes are more than {MAX_VECTOR_BYTES}")
    held = spark.sparkContext.broadcast((np.stack([models[k].coef for k in keys], axis=1),
                                         np.array([models[k].intercept for k in keys])))
    types = dict(rows.dtypes)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W, b0 = held.value
        for b in batches:
            if not b.num_rows:
                continue
            own = (np.zeros(b.num_rows, np.int64) if len(keys) == 1
                   else np.searchsorted(keys, b.column(n).to_numpy()))
            slots, x = _ragged(b.column(n + 1)).astype(np.int64), _ragged(b.column(n + 2)).astype(float)
            out = b0[own].astype(float)
            for j in range(slots.shape[1]):
                some = slots[:, j] >= 0
                out[some] += W[slots[some, j], own[some]]
            if len(W) > nd:
                out += (x * W[nd:, own].T).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(out)], [*keep, "raw_prediction"])

    let_workers_import(spark)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "raw_prediction double"])
    fold = F.col("fold") if "fold" in rows.columns else F.lit(0).alias("fold")
    return rows.select(*keep, fold.alias("_fold"), "slots", "x").mapInArrow(run, schema)
