"""Command-line jobs: the same inputs and reports as the original programs.

    python -m foldwise linear FEATURES LABELS [--scale] [--select] [--model PATH]
                              [--test FEATURES --output PATH]
    python -m foldwise tree FEATURES LABELS [--scale] [--select] [--depth 12 --bins 16]
    python -m foldwise forest FEATURES LABELS [--scale] [--select] [--trees 20 --depth 18]
    python -m foldwise score MODEL FEATURES --output PATH
    python -m foldwise least-squares COMBINED
    python -m foldwise show-fold FEATURES LABELS [--fold 0]

FEATURES/LABELS are CSV files or folders with a header line; the first column
is the id, the next five are nominal and the rest numeric (``--nominal`` changes
the count). COMBINED has the label as its last column.
"""

from __future__ import annotations

import argparse
import sys

from foldwise.operators.encode import DEFAULT_MAX_LEVELS


def _spec_from_header(spark, path: str, n_nominal: int, label_last: bool = False):
    from .spec import FeatureSpec

    header = spark.read.option("header", True).csv(path).columns
    cols = header[:-1] if label_last else header
    spec = FeatureSpec.positional(cols, n_nominal)
    if label_last:
        spec = FeatureSpec(id=spec.id, nominal=spec.nominal, numeric=spec.numeric, label=header[-1])
    return spec


def _print_report(title: str, run) -> None:
    rows = {r.stage: r for r in run.report().collect()}
    cv, tr = rows["cv"], rows["training"]
    print(f"{title}: {run.params}")
    for name, m in (("cross-validation", cv), ("training rows", tr)):
        print(f"  {name}: r {m.corr}, mae {m.mae}, rmse {m.rmse}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m foldwise")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("linear", "tree", "forest", "show-fold"):
        p = sub.add_parser(name)
        p.add_argument("features")
        p.add_argument("labels")
        p.add_argument("--nominal", type=int, default=5)
        p.add_argument("--max-levels", type=int, default=DEFAULT_MAX_LEVELS,
                       help="levels of all nominal columns that the driver may hold")
        p.add_argument("--folds", type=int, default=10)
        p.add_argument("--seed", type=int, default=None, help="fold seed (default: folds from the hash of the id alone)")
        p.add_argument("--balanced", action="store_true", help="folds whose sizes differ by one row at most")
        if name != "show-fold":
            p.add_argument("--scale", action="store_true")
            p.add_argument("--select", action="store_true", help="grid search before the final CV")
            p.add_argument("--model", default=None, help="save the refitted model here")
            p.add_argument("--test", default=None, help="feature file to score")
            p.add_argument("--output", default=None, help="where to write id,prediction lines")
            p.add_argument("--train-predictions", default=None,
                           help="write id,prediction lines of the refitted model on the training rows")
        else:
            p.add_argument("--fold", type=int, default=0)
            p.add_argument("--rows", type=int, default=10)
    sub.choices["linear"].add_argument("--iterations", type=int, default=200)
    sub.choices["linear"].add_argument("--step", type=float, default=1.0)
    sub.choices["linear"].add_argument("--penalty", choices=("l1", "l2"), default=None, help="lasso or ridge by descent")
    sub.choices["linear"].add_argument("--reg", type=float, nargs="+", default=[0.1],
                                       help="strengths of the penalty; the best is chosen by cross-validation")
    sub.choices["tree"].add_argument("--depth", type=int, default=12)
    sub.choices["tree"].add_argument("--bins", type=int, default=16)
    sub.choices["forest"].add_argument("--trees", type=int, default=20)
    sub.choices["forest"].add_argument("--depth", type=int, default=18)
    sub.choices["forest"].add_argument("--bins", type=int, default=32)
    sub.choices["forest"].add_argument("--bags", choices=("partition", "row"), default="partition",
                                       help="row: bags from a hash of the id")
    sc = sub.add_parser("score")
    sc.add_argument("model")
    sc.add_argument("features")
    sc.add_argument("--output", required=True, help="where to write id,prediction lines")
    ls = sub.add_parser("least-squares")
    ls.add_argument("combined")
    ls.add_argument("--nominal", type=int, default=5)
    ls.add_argument("--folds", type=int, default=10)
    ls.add_argument("--seed", type=int, default=1)
    args = ap.parse_args(argv)
    if getattr(args, "test", None) and not args.output:
        ap.error("--test needs --output, where every prediction is written")
    if getattr(args, "penalty", None) and args.select:
        ap.error("--penalty chooses among --reg; --select searches iterations and steps")
    if getattr(args, "bags", None) == "row" and args.select:
        ap.error("--bags row is for one forest, --select for a grid")

    from pyspark.sql import SparkSession

    from .plans import programs as PR
    from .plans.training import prepare_training
    from .session import drop_scratch, scratch_mark
    from .sources import csv as CSV

    spark = SparkSession.builder.appName(f"foldwise-{args.job}").getOrCreate()

    mark = scratch_mark()
    if args.job == "score":
        from .plans.score import score_table
        from .sources import sinks as SK

        model, enc, scaler = SK.load_model(spark, args.model)
        rows = CSV.read_features(spark, args.features, enc.spec)
        SK.write_predictions(score_table(rows, enc, model, scaler=scaler), args.output)
        print(f"Wrote predictions to {args.output}")
        return 0

    if args.job == "least-squares":
        spec = _spec_from_header(spark, args.combined, args.nominal, label_last=True)
        df = CSV.read_combined(spark, args.combined, spec, keep_id=True)
        tt = prepare_training(df, None, spec, n_folds=args.folds, seed=args.seed, coding="binary", folds="balanced")
        run = PR.least_squares_program(tt, rounded=False, average="pooled")
        _print_report(f"{args.folds}-Fold CV", run)
        for name, c in run.model.coefficient_rows(tt.feature_names):
            print(f"{name} = {c}")
        drop_scratch(spark, mark)
        return 0

    spec = _spec_from_header(spark, args.features, args.nominal)
    feats = CSV.read_features(spark, args.features, spec)
    labels = CSV.read_labels(spark, args.labels, spec)
    tt = prepare_training(feats, labels, spec, n_folds=args.folds, seed=args.seed,
                          max_levels=args.max_levels, folds="balanced" if args.balanced else "hash")

    if args.job == "show-fold":
        from .operators.inspect import show_fold
        show_fold(tt.df, args.folds, args.fold, args.rows).orderBy("side", "rn").show(2 * args.rows, False)
        drop_scratch(spark, mark)
        return 0

    if args.job == "linear" and args.penalty:
        run = PR.penalised_program(tt, [(args.penalty, x) for x in args.reg], args.iterations, args.step, args.scale)
    elif args.job == "linear":
        run = PR.linear_sgd_program(tt, scaled=args.scale, model_selection=args.select,
                                    iterations=args.iterations, step=args.step)
    elif args.job == "tree":
        run = PR.tree_program(tt, model_selection=args.select, max_depth=args.depth,
                              max_bins=args.bins, scaled=args.scale)
    else:
        run = PR.forest_program(tt, model_selection=args.select, num_trees=args.trees,
                                max_depth=args.depth, max_bins=args.bins, scaled=args.scale, bags=args.bags)
    _print_report(f"{args.folds}-Fold CV", run)

    from .operators.linear import LinearModel
    from .sources import sinks as SK

    if args.model:
        saved = (SK.save_linear_model(spark, run.model, tt.feature_names, args.model, tt.encoder.to_json())
                 if isinstance(run.model, LinearModel) else
                 SK.save_ml_model(run.model, args.model, tt.encoder, tt.scaler if args.scale else None))
        print("Saved model" if saved else "Model not saved: path already exists")
    if args.train_predictions:
        scaler = tt.scaler if args.scale else None
        SK.write_predictions(PR.training_predictions(tt, run.model, scaler=scaler), args.train_predictions)
        print(f"Wrote training predictions to {args.train_predictions}")
    if args.test:
        from .plans.score import score_table

        test = CSV.read_features(spark, args.test, spec)
        scored = score_table(test, tt.encoder, run.model, scaler=tt.scaler if args.scale else None)
        SK.write_predictions(scored, args.output)
        print(f"Wrote predictions to {args.output}")
    drop_scratch(spark, mark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
