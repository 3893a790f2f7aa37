"""Declared layout of a feature table.

The reference fixes the layout by position: column 0 is the id, the next five
are nominal, everything after is numeric, and the label sits in a separate
file. Here the layout is declared by name, with that positional rule as the
default when only a header is known.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    id: str = "id"
    nominal: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    label: str = "label"
    id_type: T.DataType = field(default_factory=T.StringType)

    @staticmethod
    def positional(columns: list[str] | tuple[str, ...], n_nominal: int = 5,
                   label: str = "label") -> "FeatureSpec":
        """First column id, next ``n_nominal`` nominal, the rest numeric."""
        cols = list(columns)
        return FeatureSpec(id=cols[0], nominal=tuple(cols[1:1 + n_nominal]),
                           numeric=tuple(cols[1 + n_nominal:]), label=label)

    @staticmethod
    def default(n_numeric: int, n_nominal: int = 5) -> "FeatureSpec":
        """Names used when a file has no usable header: id, c1..c5, n1..nk."""
        return FeatureSpec(
            id="id",
            nominal=tuple(f"c{i}" for i in range(1, n_nominal + 1)),
            numeric=tuple(f"n{i}" for i in range(1, n_numeric + 1)),
        )

    @property
    def feature_columns(self) -> tuple[str, ...]:
        return self.nominal + self.numeric

    def feature_schema(self) -> T.StructType:
        """Schema of a feature file: id, nominal strings, numeric doubles."""
        fields = [T.StructField(self.id, self.id_type, True)]
        fields += [T.StructField(c, T.StringType(), True) for c in self.nominal]
        fields += [T.StructField(c, T.DoubleType(), True) for c in self.numeric]
        return T.StructType(fields)

    def label_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.id, self.id_type, True),
                             T.StructField(self.label, T.DoubleType(), True)])

    def combined_schema(self) -> T.StructType:
        """Schema of the single-file form: features then the label last."""
        return T.StructType(self.feature_schema().fields
                            + [T.StructField(self.label, T.DoubleType(), True)])
