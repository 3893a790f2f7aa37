"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from foldwise.session import drop_table, write_table


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as a table, their number and a checksum, taken while they are written."""
    seen = Observation()
    table = write_table(edges.observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("h")), "cc-edges")
    got = seen.get
    return table, (got["n"], int(got["h"]))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # equal edges are dropped behind the small star
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(least, "u")
    return (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """Columns ``u, v`` (longs) -> ``id, component_id`` for every id that has an edge,
    except components' least ids themselves.

    Each round is written to the shared folder, which cuts the lineage, and replaces the table of
    the round before; the number of rounds grows with the logarithm of the longest chain. No edge
    goes to the driver, only a count and a checksum per round.
    """
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e, mark = _written(e.distinct())
    while mark[0]:
        old = e
        e, new = _written(_small_star(_large_star(old)))
        drop_table(old)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
