"""Nominal-to-numeric encoding, fitted once and reused for scoring.

Fitting is one job: the nominal columns are unpivoted into ``(col, level)``
pairs and de-duplicated (partial aggregation on the map side, so a hot level
costs one row per partition), then the small level table is collected behind a
size check. Encoding is a list of plain column expressions, so it runs inside
whole-stage codegen with no dictionary join.

Two codings:

* ``"dummy"`` (default): a column with L levels yields L-1 indicators; the
  alphabetically first level is the all-zero baseline, level i (i >= 1) sets
  slot i-1.
* ``"binary"``: a column with more than two levels yields one indicator per
  level; a column with at most two levels yields one 0/1 column (1 = second
  level). This is the single-machine program's nominal-to-binary filter.

Levels not seen at fit time encode as the baseline (all zeros) and are counted
in ``unseen_levels``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import FeatureSpec

# The literal form collects levels to the driver and makes dense columns of them, so their total is bounded;
# beyond it, operators/dictionary.py and operators/coded.py do the same with tables and codes.
DEFAULT_MAX_LEVELS = 10_000


def nominal_value(c: str) -> Column:
    """A nominal column's level; null is the empty level."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def numeric_value(c: str, nulls: str = "error") -> Column:
    """A numeric column as a double; an empty value raises, or is 0 with ``nulls="zero"``."""
    x = F.col(c).cast("double")
    if nulls == "error":
        x = F.when(x.isNull(), F.raise_error(F.lit(f"numeric column {c} has an empty value"))).otherwise(x)
    elif nulls == "zero":
        x = F.coalesce(x, F.lit(0.0))
    return x.cast("double")


def distinct_levels(df: DataFrame, nominal: tuple[str, ...] | list[str]) -> DataFrame:
    """``(col, level)`` for every distinct value of every nominal column, in one job."""
    cols = list(nominal)
    long = df.select(*[nominal_value(c).alias(c) for c in cols]).unpivot(
        [], cols, "col", "level")
    return long.distinct()


def level_counts(levels: DataFrame) -> DataFrame:
    """``(col, levels, dummies)``: dummies = levels - 1."""
    return levels.groupBy("col").agg(F.count(F.lit(1)).alias("levels")).select(
        "col", "levels", (F.col("levels") - 1).alias("dummies"))


def level_index(levels: DataFrame) -> DataFrame:
    """``(col, level, idx)``: 0-based rank of the level within its column, for any number of levels
    (see :func:`~foldwise.operators.dictionary.ranked`)."""
    from .dictionary import ranked

    return ranked(levels.select("col", "level")).select("col", "level", F.col("idx").cast("int").alias("idx"))


@dataclass
class Encoder:
    spec: FeatureSpec
    levels: dict[str, list[str]]
    coding: str = "dummy"
    numeric_nulls: str = "error"
    _names: list[str] = field(default_factory=list, repr=False)

    def __post_init__(self):
        if self.coding not in ("dummy", "binary"):
            raise ValueError(f"unknown coding {self.coding!r}")
        self._names = [name for name, _ in self.layout()]

    # --- layout -----------------------------------------------------------
    def layout(self) -> list[tuple[str, tuple[str, str | None] | None]]:
        """(feature name, (nominal column, level) or None for numeric)."""
        out: list[tuple[str, tuple[str, str | None] | None]] = []
        for c in self.spec.nominal:
            lv = self.levels.get(c, [])
            if self.coding == "dummy":
                picked = lv[1:]
            elif len(lv) > 2:
                picked = lv
            elif len(lv) == 2:
                picked = lv[1:]
            else:
                # one level: the filter still emits one (constant zero) column
                out.append((c, (c, None)))
                continue
            out.extend((f"{c}={v}", (c, v)) for v in picked)
        out.extend((c, None) for c in self.spec.numeric)
        return out

    @property
    def feature_names(self) -> list[str]:
        return list(self._names)

    @property
    def width(self) -> int:
        return len(self._names)

    @property
    def dummy_width(self) -> int:
        return self.width - len(self.spec.numeric)

    # --- expressions ------------------------------------------------------
    def feature_columns(self) -> list[Column]:
        cols = []
        for name, slot in self.layout():
            if slot is None:
                cols.append(numeric_value(name, self.numeric_nulls))
            else:
                c, level = slot
                if level is None:
                    cols.append(F.lit(0.0))
                    continue
                cols.append(F.when(nominal_value(c) == F.lit(level), F.lit(1.0)).otherwise(F.lit(0.0)))
        return cols

    def unseen_column(self) -> Column:
        terms = [F.when(nominal_value(c).isin(*self.levels.get(c, [])), F.lit(0)).otherwise(F.lit(1))
                 for c in self.spec.nominal]
        if not terms:
            return F.lit(0)
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total.cast("int")

    def transform(self, df: DataFrame, keep: tuple[str, ...] | list[str] = (),
                  features_col: str = "f", with_unseen: bool = False) -> DataFrame:
        """Add ``f array<double>`` (and ``unseen_levels``); keep the listed columns."""
        out = [F.col(c) for c in keep]
        out.append(F.array(*self.feature_columns()).alias(features_col))
        if with_unseen:
            out.append(self.unseen_column().alias("unseen_levels"))
        return df.select(*out)

    # --- persistence ------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps({
            "id": self.spec.id, "nominal": list(self.spec.nominal),
            "numeric": list(self.spec.numeric), "label": self.spec.label,
            "levels": self.levels, "coding": self.coding,
            "numeric_nulls": self.numeric_nulls,
        })

    @staticmethod
    def from_json(text: str) -> "Encoder":
        d = json.loads(text)
        spec = FeatureSpec(id=d["id"], nominal=tuple(d["nominal"]),
                           numeric=tuple(d["numeric"]), label=d["label"])
        return Encoder(spec, {k: list(v) for k, v in d["levels"].items()},
                       coding=d["coding"], numeric_nulls=d["numeric_nulls"])

    def level_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, v, i) for c in self.spec.nominal for i, v in enumerate(self.levels.get(c, []))]
        schema = T.StructType([T.StructField("col", T.StringType()),
                               T.StructField("level", T.StringType()),
                               T.StructField("idx", T.IntegerType())])
        return spark.createDataFrame(rows, schema)


def fit_encoder(df: DataFrame, spec: FeatureSpec, coding: str = "dummy",
                max_levels: int = DEFAULT_MAX_LEVELS,
                numeric_nulls: str = "error") -> Encoder:
    """Collect the level dictionary of the nominal columns (size-checked)."""
    levels: dict[str, list[str]] = {c: [] for c in spec.nominal}
    if spec.nominal:
        rows = distinct_levels(df, spec.nominal).limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(
                f"nominal columns have more than {max_levels} levels in total; "
                "raise max_levels or declare high-cardinality columns numeric")
        for r in rows:
            levels[r["col"]].append(r["level"])
        for c in levels:
            levels[c].sort()
    return Encoder(spec, levels, coding=coding, numeric_nulls=numeric_nulls)
