"""Headline timings at one scale factor; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

After an untimed warm-up on the smallest tables (its duration is reported as
``warmup_sec``), queries (seconds each, wall clock, results collected or written):

* ``encode_join``      fit levels, encode, join labels, add folds, write the
                       fold-partitioned training table, fit the scaler
* ``moments``          one aggregate of per-fold moments
* ``cv_least_squares`` 10-fold least squares: fold models + one scoring pass
* ``linear_grid``      45-point gradient-descent grid x 10 folds + chosen CV + refit
* ``cv_tree``          10-fold regression tree, depth 12, 16 bins, + refit
* ``cv_forest``        10-fold forest, 10 trees, depth 8
* ``scoring``          score later orders with the refitted model and write lines
* ``lineitem_cv_least_squares``  same as cv_least_squares on 600k line items x 40 features
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))

    from foldwise.operators.linear import fit_ols
    from foldwise.operators.moments import total
    from foldwise.plans import programs as PR
    from foldwise.plans import select as S
    from foldwise.plans.score import score_table
    from foldwise.plans.training import prepare_training
    from foldwise.session import drop_scratch, local_session, scratch_path
    from foldwise.sources.sinks import write_predictions
    from foldwise.sources.tables import (LINEITEM_SPEC, ORDER_SPEC, SCORING_CUTOFF,
                                         lineitem_table, order_features, order_labels)

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="foldwise-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: the same stages once on the smallest tables, so the timings below measure
    # steady-state work rather than first-use JVM compilation. Reported, not hidden.
    t_warm = time.perf_counter()
    small = os.environ.get("BENCH_WARMUP_DIR", str(Path(sf_dir).parent / "sf0.001"))
    if Path(small).exists():
        wt = prepare_training(order_features(spark, small, before=SCORING_CUTOFF),
                              order_labels(spark, small), ORDER_SPEC)
        S.point_report(S.fold_metrics(S.score_fold_models(wt, S.ols_fold_models(wt)))).collect()
        PR.tree_program(wt, max_depth=3, max_bins=16).report().collect()
    warmup = round(time.perf_counter() - t_warm, 3)
    times: dict[str, float] = {}
    state: dict = {}

    def timed(name, fn):
        if only and name not in only:
            return None
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def encode_join():
        feats = order_features(spark, sf_dir, before=SCORING_CUTOFF)
        tt = prepare_training(feats, order_labels(spark, sf_dir), ORDER_SPEC)
        state["tt"] = tt
        return tt

    def tt():
        if "tt" not in state:
            encode_join()
        return state["tt"]

    def moments():
        state["pf"] = S.fold_moments(tt())
        return state["pf"]

    def pf():
        if "pf" not in state:
            moments()
        return state["pf"]

    quality: dict[str, dict] = {}

    def keep(name, row, **extra):
        quality[name] = {"corr": round(row["corr"], 6), "mae": round(row["mae"], 3),
                         "rmse": round(row["rmse"], 3), **extra}

    def cv_least_squares():
        fm = S.ols_fold_models(tt(), pf())
        rep = S.point_report(S.fold_metrics(S.score_fold_models(tt(), fm))).collect()
        state["ols"] = fit_ols(total(pf(), tt().width), tt().scaler)
        keep("cv_least_squares", rep[0])
        return rep

    def linear_grid():
        res = PR.linear_sgd_program(tt(), scaled=True, model_selection=True)
        rows = res.report().collect()
        keep("linear_grid", rows[0], iterations=res.params["iterations"], step=res.params["step"])
        return rows

    def cv_tree():
        res = PR.tree_program(tt(), max_depth=12, max_bins=16)
        rows = res.report().collect()
        keep("cv_tree", rows[0])
        return rows

    def cv_forest():
        rows = PR.forest_program(tt(), num_trees=10, max_depth=8).report().collect()
        keep("cv_forest", rows[0])
        return rows

    def scoring():
        model = state.get("ols") or fit_ols(total(pf(), tt().width), tt().scaler)
        scored = score_table(order_features(spark, sf_dir, since=SCORING_CUTOFF), tt().encoder, model)
        write_predictions(scored, scratch_path(spark, "bench-predictions"))

    def lineitem_cv():
        # single-table form: the label is a column of the line-item table
        t = prepare_training(lineitem_table(spark, sf_dir), None, LINEITEM_SPEC)
        pfl = S.fold_moments(t)
        fm = S.ols_fold_models(t, pfl)
        rep = S.point_report(S.fold_metrics(S.score_fold_models(t, fm))).collect()
        keep("lineitem_cv_least_squares", rep[0])
        return rep

    timed("encode_join", encode_join)
    timed("moments", moments)
    timed("cv_least_squares", cv_least_squares)
    timed("linear_grid", linear_grid)
    timed("cv_tree", cv_tree)
    timed("cv_forest", cv_forest)
    timed("scoring", scoring)
    timed("lineitem_cv_least_squares", lineitem_cv)

    drop_scratch(spark)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": int(cpus), "warmup_sec": warmup,
                      "quality_10fold_cv": quality}))


if __name__ == "__main__":
    main()
