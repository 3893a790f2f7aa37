"""Column expressions shared by the operators.

All of them are built-in Spark SQL functions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column | str) -> Column:
    """Round half toward +infinity and return a double (``-2.5 -> -2.0``).

    ``floor`` on a double yields a long: NaN becomes 0 and values beyond the
    long range saturate, exactly like the JVM's ``Math.round`` that the
    reference calls; ``round`` would go half away from zero instead.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x + F.lit(0.5)).cast("double")


def sum_tree(terms: list[Column]) -> Column:
    """The sum of the terms as a balanced tree, so its depth is the logarithm of their number.

    A chain of ``+`` is as deep as it is long and overflows the stack of the
    analyser at some hundred terms.
    """
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + (
            [terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def required(col: Column | str, name: str) -> Column:
    """The column, or an error that names it where it is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.raise_error(F.lit(f"column {name} holds a null"))).otherwise(c)


def fold_of(id_col: Column | str, k: int, seed: int | None = None) -> Column:
    """Deterministic fold in ``[0, k)`` from the md5 of the id.

    Depends on the id alone, so it is stable across re-runs, partitionings and
    lost executors, and duplicated ids share a fold. A seed is put in front of
    the id inside the hash to draw a different assignment.
    """
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    key = idc.cast("string")
    if seed is not None:
        key = F.concat(F.lit(f"{seed}:"), key)
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(k)).cast("int")


def guarded_corr(y: Column | str, p: Column | str) -> Column:
    """Pearson correlation as an aggregate; null when either side is constant.

    ``corr`` raises a division by zero under ANSI mode for a constant column;
    the population covariance over the product of population deviations is the
    same number and can be guarded with ``nullif``.
    """
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    return F.covar_pop(y, p) / F.nullif(F.stddev_pop(y) * F.stddev_pop(p), F.lit(0.0))


def split_line(line: Column | str, sep: str = ",") -> Column:
    """Split a text line into its fields (keeps trailing empty fields)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, sep, -1)


def join_fields(*cols: Column | str, sep: str = ",") -> Column:
    """``a,b`` text line from columns (numbers are rendered by Spark's cast)."""
    return F.concat_ws(sep, *[(F.col(c) if isinstance(c, str) else c).cast("string")
                              for c in cols])
