"""Stand-in feature and label tables built from the star-schema Parquet tables.

``order_features``: one row per order with five nominal columns (order status,
priority, customer segment, customer region, order quarter) and four numeric
ones (line quantity, line price, line count, customer balance).
``order_labels``: the net charge per order, from its line items.

Each is its own aggregate of ``lineitem`` by order key (partial aggregation
before the shuffle): features and labels are separate inputs, as in the
original programs. Dimension tables with a fixed size (nation, region) are
broadcast; customer is joined by key, so Spark plans a shuffle join once
customer outgrows its size-checked broadcast threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import FeatureSpec

ORDER_SPEC = FeatureSpec(
    id="id",
    nominal=("c1", "c2", "c3", "c4", "c5"),
    numeric=("n1", "n2", "n3", "n4"),
    label="label",
)

# Orders before this date train the model; the rest are scored.
SCORING_CUTOFF = dt.datetime(2000, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Sums of cents (prices) and of 6-decimal charges are exact decimals; a double
# sum carries order-dependent noise in the last bits (it differs between
# partitionings and engines), so the sums are put back on their decimal grid.
PRICE_DECIMALS = 2
CHARGE_DECIMALS = 6


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.round(F.sum("l_extendedprice"), PRICE_DECIMALS).alias("price"),
        F.count(F.lit(1)).alias("lines"),
    )


def order_features(spark: SparkSession, sf_dir: str,
                   before: dt.datetime | None = None,
                   since: dt.datetime | None = None) -> DataFrame:
    """Feature table ``id, c1..c5, n1..n4`` (optionally a date range of orders)."""
    o = table(spark, sf_dir, "orders")
    if before is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(before))
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(since))
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region have a fixed size (25 and 5 rows): broadcasting them is bounded.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "r_name", "c_acctbal")
    lt = _line_totals(spark, sf_dir)
    df = (o.join(cust, o.o_custkey == cust.c_custkey)
          .join(lt, o.o_orderkey == lt.l_orderkey, "left"))
    return df.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("c1"),
        F.col("o_orderpriority").alias("c2"),
        F.col("c_mktsegment").alias("c3"),
        F.col("r_name").alias("c4"),
        F.quarter("o_orderdate").cast("string").alias("c5"),
        F.coalesce(F.col("qty"), F.lit(0.0)).alias("n1"),
        F.coalesce(F.col("price"), F.lit(0.0)).alias("n2"),
        F.coalesce(F.col("lines"), F.lit(0)).cast("double").alias("n3"),
        F.col("c_acctbal").alias("n4"),
    )


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label table ``id, label``: net charge of each order with line items."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))),
                CHARGE_DECIMALS).alias("label")
    ).select(F.col("l_orderkey").alias("id"), "label")


# Line-item variant: no usable key, so it is used only where no id is needed.
LINEITEM_SPEC = FeatureSpec(
    id="id",
    nominal=("l_returnflag", "l_linestatus", "p_brand", "p_type", "r_name"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    label="label",
)


def lineitem_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with part and supplier-region attributes and the charge label."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    sup = s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey).select("s_suppkey", "r_name")
    df = (li.join(p, li.l_partkey == p.p_partkey)
          .join(sup, li.l_suppkey == sup.s_suppkey))
    return df.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        "l_returnflag", "l_linestatus", "p_brand", "p_type", "r_name",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("label"),
    )
