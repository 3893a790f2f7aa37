"""Level dictionaries of any size: distributed ranks, and level codes by joins.

The literal form of :mod:`~foldwise.operators.encode` keeps all levels on the driver; this one keeps
them in a table ``col, level, idx, n`` (``n`` rows hold the level), so a column may have as many
levels as rows. Ranks: the distinct levels are range-partitioned in their order and numbered by a
sum over the partitions before plus the place in the own one (two-level prefix sums); no task
sees more than a partition. Codes: one equi-join a column. The levels of a column that has few are
broadcast, so its rows move for no join; the others' rows are joined by level. A level that holds a large share of
the rows is known from ``n``; its rows are dealt to several tasks and its one dictionary row is repeated.
Only the number of levels of each column and its largest ``n`` come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table
from ..spec import FeatureSpec
from .encode import nominal_value

#: A level is hot if more than this share of a column's rows hold it (so at most 1 / HOT_SHARE are).
HOT_SHARE, HOT_ROWS, SALTS = 0.005, 1000, 32
#: Most levels of a column whose part of the dictionary is broadcast.
BROADCAST_LEVELS = 10_000


def ranked(levels: DataFrame) -> DataFrame:
    """Add ``idx`` (long): the 0-based rank of ``level`` within ``col``. The pairs are distinct."""
    # written once, so that the sums and the places see the same partitions
    placed = write_table(levels.repartitionByRange("col", "level").withColumn("_part", F.spark_partition_id()),
                         "levels")
    sizes = placed.groupBy("col", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("col").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("col", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("col", "_part").orderBy("level")
    return (placed.join(base, ["col", "_part"])
            .withColumn("idx", F.col("_base") + F.row_number().over(within) - 1).drop("_part", "_base"))


@dataclass
class LevelDictionary:
    """The levels of a spec's nominal columns: ``table``, and of each column the number of levels and the
    rows of its most frequent one (``most``; a column not listed may have hot levels)."""
    spec: FeatureSpec
    table: DataFrame
    sizes: dict[str, int]
    n_rows: int
    most: dict[str, int] = field(default_factory=dict)

    @property
    def offsets(self) -> dict[str, int]:
        """First slot of each nominal column in the dummy layout."""
        out, at = {}, 0
        for c in self.spec.nominal:
            out[c] = at
            at += max(0, self.sizes.get(c, 0) - 1)
        return out

    @property
    def dummy_width(self) -> int:
        return sum(max(0, self.sizes.get(c, 0) - 1) for c in self.spec.nominal)

    @property
    def width(self) -> int:
        return self.dummy_width + len(self.spec.numeric)

    def with_codes(self, df: DataFrame) -> DataFrame:
        """``df`` with ``codes array<bigint>``: the rank of each nominal column's level, -1 for a level
        the dictionary lacks. Rows stay as many as they are."""
        keep = df.columns
        out = df
        hot_rows = max(HOT_ROWS, HOT_SHARE * self.n_rows)
        # broadcast columns first: what only they need is dropped before any row is shuffled
        for i, c in sorted(enumerate(self.spec.nominal), key=lambda x: self.sizes.get(x[1], 0) > BROADCAST_LEVELS):
            d = self.table.filter(F.col("col") == c)
            plain = d.select(F.col("level").alias("_level"), F.col("idx").alias(f"_code_{i}"))
            out = out.withColumn("_level", nominal_value(c))
            if self.sizes.get(c, 0) <= BROADCAST_LEVELS:
                out = out.join(F.broadcast(plain), "_level", "left").drop("_level")
                continue
            if self.most.get(c, self.n_rows) <= hot_rows:
                out = out.join(plain, "_level", "left").drop("_level")
                continue
            hot = F.broadcast(d.filter(F.col("n") > hot_rows).select(F.col("level").alias("_level"), F.lit(SALTS).alias("_salts")))
            salts = F.coalesce("_salts", F.lit(1))
            one = (plain.join(hot, "_level", "left")
                   .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
            # the salt is a hash of the row, so a recomputed task deals the rows alike
            out = (out.join(hot, "_level", "left")
                   .withColumn("_salt", F.pmod(F.xxhash64(*keep), salts).cast("int")).drop("_salts")
                   .join(one, ["_level", "_salt"], "left").drop("_level", "_salt"))
        codes = F.array(*[F.coalesce(f"_code_{i}", F.lit(-1)).cast("bigint") for i in range(len(self.spec.nominal))])
        if not self.spec.nominal:
            codes = F.array().cast("array<bigint>")
        return out.withColumn("codes", codes).select(*keep, "codes")

    def slots(self, codes: str = "codes") -> Column:
        """Each nominal column's dummy slot, -1 for the baseline and for a level not known."""
        first = F.array(*[F.lit(self.offsets[c]).cast("bigint") for c in self.spec.nominal])
        return F.zip_with(F.col(codes), first, lambda k, o: F.when(k > 0, o + k - 1).otherwise(F.lit(-1).cast("bigint")))


def build_dictionary(df: DataFrame, spec: FeatureSpec) -> LevelDictionary:
    """Fit the dictionary in one pass over the nominal columns of ``df``."""
    cols = list(spec.nominal)
    if not cols:
        empty = df.sparkSession.createDataFrame([], "col string, level string, n bigint, idx bigint")
        return LevelDictionary(spec, empty, {}, df.count())
    long = df.select(*[nominal_value(c).alias(c) for c in cols]).unpivot([], cols, "col", "level")
    table = write_table(ranked(long.groupBy("col", "level").agg(F.count(F.lit(1)).alias("n"))), "dictionary")
    sizes = {r["col"]: r for r in table.groupBy("col").agg(
        F.count(F.lit(1)).alias("levels"), F.sum("n").alias("n"), F.max("n").alias("most")).collect()}
    return LevelDictionary(spec, table, {c: r["levels"] for c, r in sizes.items()}, max((r["n"] for r in sizes.values()), default=0),
                           {c: r["most"] for c, r in sizes.items()})
