"""Training and scoring frames.

``training_frame`` is the lazy plan ``features JOIN labels ON id`` followed by
encoding; ``prepare_training`` adds the fold column and writes the result once
to the shared checkpoint folder (rows clustered by fold), so every later pass
(moments, scoring, tree fits) reads compact Parquet with row-group skipping
instead of re-running the scans and the join. The scaler and the per-fold
moments come from one further pass.

The join is an inner equi-join on the id: rows without a label (or without
features) drop out, and an id that appears twice on one side appears twice in
the result. Adaptive execution splits a hot id's partition (skew join), so a
key holding a large share of the rows does not end up in a single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import required
from ..operators.coded import CodedMoments, coded_moments, coded_rows
from ..operators.dictionary import LevelDictionary, build_dictionary
from ..operators.encode import DEFAULT_MAX_LEVELS, Encoder, fit_encoder
from ..operators.folds import assign_balanced_folds, assign_folds
from ..operators.moments import (Moments, Summary, collect_summaries, fold_scaled_training,
                                 fold_summaries, scaler_of)
from ..operators.scale import Scaler
from ..session import write_table
from ..spec import FeatureSpec


HOT_ID_SUPPORT = 0.01      # an id holding at least this share of feature rows is salted
SALT_BUCKETS = 32


def _adaptive_skew_join(spark) -> bool:
    on = spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    skew = spark.conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true"
    return on and skew


def join_labels(features: DataFrame, labels: DataFrame, spec: FeatureSpec,
                skew: str = "auto") -> DataFrame:
    """Inner join of features and labels on the id (duplicates multiply).

    ``skew="auto"`` leaves a hot id to adaptive execution, which splits its
    partition (``SortMergeJoin(skew=true)``). A null id on either side and a
    null label raise an error that names the column. When the session has that turned
    off, or with ``skew="salt"``, hot ids are salted explicitly (see
    :func:`salted_join`). ``skew="none"`` is the plain join.
    """
    lab = labels.select(required(spec.id, spec.id).alias(spec.id),
                        required(F.col(spec.label).cast("double"), spec.label).alias(spec.label))
    features = features.withColumn(spec.id, required(spec.id, spec.id))
    if skew == "salt" or (skew == "auto" and not _adaptive_skew_join(features.sparkSession)):
        return salted_join(features, lab, spec.id)
    return features.join(lab, spec.id, "inner")


def salted_join(left: DataFrame, right: DataFrame, key: str, support: float = HOT_ID_SUPPORT,
                buckets: int = SALT_BUCKETS) -> DataFrame:
    """Exact inner join on ``key`` that spreads hot keys of ``left`` over ``buckets`` tasks.

    Candidate hot keys come from Spark's one-pass frequent-items sketch
    (at most 1/support keys, a superset of the keys above ``support``). Each
    left row of a hot key gets one salt from a hash of all its columns, which a
    recomputed task gives it again; rows that agree in every column share a
    salt. The right rows of hot keys are repeated once per salt. Every left row still meets every right row of its key exactly once;
    all other keys take the plain join.
    """
    hot = left.select(key).stat.freqItems([key], support).collect()[0][0]
    hot = [h for h in hot if h is not None]
    if not hot:
        return left.join(right, key, "inner")
    is_hot = F.col(key).isin(hot)
    salted_left = left.filter(is_hot).withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), F.lit(buckets)).cast("int"))
    # right rows of at most 1/support keys, each repeated `buckets` times
    salted_right = right.filter(is_hot).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    hot_part = salted_left.join(salted_right, [key, "_salt"], "inner").drop("_salt")
    cold_part = left.filter(~is_hot).join(right.filter(~is_hot), key, "inner")
    return hot_part.unionByName(cold_part)


def training_frame(features: DataFrame, labels: DataFrame | None, spec: FeatureSpec,
                   encoder: Encoder | None = None, coding: str = "dummy", skew: str = "auto",
                   max_levels: int = DEFAULT_MAX_LEVELS) -> tuple[DataFrame, Encoder]:
    """``id, label, f`` (lazy) and the encoder fitted on the feature table.

    ``labels=None`` is the single-table form: the label is already a column of
    ``features`` (no join).
    """
    enc = encoder or fit_encoder(features, spec, coding=coding, max_levels=max_levels)
    if labels is None:
        joined = features.withColumns({
            spec.id: required(spec.id, spec.id),
            spec.label: required(F.col(spec.label).cast("double"), spec.label)})
    else:
        joined = join_labels(features, labels, spec, skew=skew)
    return enc.transform(joined, keep=[spec.id, spec.label]), enc


def scoring_frame(features: DataFrame, encoder: Encoder, with_label: bool = False) -> DataFrame:
    """``id, f, unseen_levels`` through an already fitted encoder (no own dictionary)."""
    spec = encoder.spec
    df = encoder.transform(features, keep=[spec.id], with_unseen=True)
    if with_label:
        df = df.withColumn(spec.label, F.lit(0.0))
    return df


def combined_frame(features: DataFrame, labels: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Single-table form: feature columns, then the label last, id dropped."""
    joined = join_labels(features, labels, spec)
    return joined.select(*spec.feature_columns, spec.label)


@dataclass
class TrainingTable:
    df: DataFrame          # id, label, f, fold
    encoder: Encoder
    n_folds: int
    spec: FeatureSpec
    _scaler: Scaler | None = None
    _moments: dict[int, Moments] | None = None
    _summaries: dict[int, Summary] | None = None
    _n_rows: int | None = None

    @property
    def width(self) -> int:
        return self.encoder.width

    @property
    def n_rows(self) -> int:
        """Rows of the table (a count of the written files' footers)."""
        if self._n_rows is None:
            self._n_rows = self.df.count()
        return self._n_rows

    @property
    def feature_names(self) -> list[str]:
        return self.encoder.feature_names

    def fold_moments(self) -> dict[int, Moments]:
        """Standardised moments by fold; the same pass yields the scaler."""
        if self._moments is None:
            self._summaries = collect_summaries(fold_summaries(self.df, self.width))
            self._scaler = scaler_of(self._summaries, self.width)
            self._moments = {k: s.moments(self._scaler) for k, s in self._summaries.items()}
            for k in range(self.n_folds):
                self._moments.setdefault(k, Moments.zero(self.width))
        return self._moments

    def fold_scaled_training(self) -> dict[int, tuple[Scaler, Moments]]:
        """Training-side scaler and moments of each fold (``scale_scope="fold"``), same pass."""
        self.fold_moments()
        return fold_scaled_training(self._summaries, self.width)

    @property
    def scaler(self) -> Scaler:
        """Column means and sample standard deviations (table-wide, fitted once)."""
        if self._scaler is None:
            self.fold_moments()
        return self._scaler


def prepare_training(features: DataFrame, labels: DataFrame | None, spec: FeatureSpec,
                     n_folds: int = 10, seed: int | None = None, coding: str = "dummy",
                     encoder: Encoder | None = None, materialize: bool = True,
                     skew: str = "auto", max_levels: int = DEFAULT_MAX_LEVELS,
                     folds: str = "hash") -> TrainingTable:
    """Encode, join, add folds and materialise once (scaler and moments follow lazily).

    ``folds="hash"`` assigns by the hash of the id alone (no shuffle, sizes vary);
    ``"balanced"`` by its global rank (sizes differ by one row at most; seed 1 if none is given).

    ``skew`` is passed to :func:`join_labels` (``auto``, ``salt`` or ``none``),
    ``max_levels`` to :func:`fit_encoder`.
    """
    df, enc = training_frame(features, labels, spec, encoder=encoder, coding=coding, skew=skew,
                             max_levels=max_levels)
    if folds not in ("hash", "balanced"):
        raise ValueError(f"unknown folds {folds!r}")
    folded = (assign_folds(df, n_folds, spec.id, seed) if folds == "hash" else
              assign_balanced_folds(df, n_folds, spec.id, 1 if seed is None else seed))
    df = folded.select(
        F.col(spec.id).alias("id"), F.col(spec.label).alias("label"), "f", "fold")
    if materialize:
        df = write_table(df, "training", cluster_by=("fold",))
    return TrainingTable(df, enc, n_folds, spec)


@dataclass
class CodedTable:
    """A training table for columns of many levels: ``df`` holds ``id, label, slots, x, fold``."""
    df: DataFrame
    dictionary: LevelDictionary
    n_folds: int
    _moments: CodedMoments | None = None

    def moments(self) -> CodedMoments:
        if self._moments is None:
            self._moments = coded_moments(self.df, self.dictionary)
        return self._moments


def prepare_coded(features: DataFrame, labels: DataFrame | None, spec: FeatureSpec, n_folds: int = 10,
                  seed: int | None = None, skew: str = "auto",
                  dictionary: LevelDictionary | None = None) -> CodedTable:
    """As :func:`prepare_training`, with level codes in place of dense dummies: no limit on levels, and
    files whose size does not grow with them."""
    d = dictionary or build_dictionary(features, spec)
    joined = (join_labels(features, labels, spec, skew=skew) if labels is not None else features.withColumns({
        spec.id: required(spec.id, spec.id), spec.label: required(F.col(spec.label).cast("double"), spec.label)}))
    rows = assign_folds(coded_rows(joined, d, (spec.id, spec.label)), n_folds, spec.id, seed).select(
        F.col(spec.id).alias("id"), F.col(spec.label).alias("label"), "slots", "x", "fold")
    return CodedTable(write_table(rows, "coded", cluster_by=("fold",)), d, n_folds)
