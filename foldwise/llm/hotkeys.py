"""Joins on a key that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import fresh

#: A key is hot if it has more than this share of the rows (so at most 1 / HOT_SHARE keys are), and
#: not fewer than ``HOT_ROWS``; its rows are dealt to ``SALTS`` tasks.
HOT_SHARE, HOT_ROWS, SALTS = 0.005, 1000, 32


def hot_keys(left: DataFrame, keys: list[str], n_rows: int, weight: str | None = None) -> list[Row]:
    """The hot keys among ``n_rows`` rows, at most 1 / HOT_SHARE of them. ``weight`` is a column of
    row counts where ``left`` is aggregated already."""
    if not weight and n_rows <= HOT_ROWS:
        return []
    n = F.sum(weight) if weight else F.count(F.lit(1))
    (c,) = fresh(left, "rows_of_key")
    return (left.groupBy(*keys).agg(n.alias(c)).filter(F.col(c) > max(float(HOT_ROWS), HOT_SHARE * n_rows))
            .select(*keys).collect())


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: list[Row], salt_by: list[str]) -> DataFrame:
    """The inner join of ``left`` with ``right``; the rows of a hot key are dealt out by a hash of
    ``salt_by`` (columns of ``left``), so that a recomputed task deals them alike, and only the
    hot keys' rows of ``right`` are repeated."""
    if not hot:
        return left.join(right, keys)
    salts, salt = fresh(left.join(right, keys), "salts", "salt")
    schema = T.StructType([left.schema[k] for k in keys])
    few = F.broadcast(left.sparkSession.createDataFrame(hot, schema).withColumn(salts, F.lit(SALTS)))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(few, keys, "left").withColumn(salts, F.coalesce(salts, F.lit(1)))

    a = with_salts(left).withColumn(salt, F.pmod(F.xxhash64(*salt_by), F.col(salts)).cast("int")).drop(salts)
    b = with_salts(right).withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(salts) - 1))).drop(salts)
    return a.join(b, [*keys, salt]).drop(salt)
