"""Feature and label tables laid out by id, so that joining them moves no row.

A table is hashed on the id once when it is written, into a fixed number of buckets, one sorted file
each. Two tables with the same number of buckets are joined bucket by bucket, with no exchange, however
often. Ids that hold a large share of the rows cannot be split inside a bucket, so
:func:`join_bucketed` takes them out and joins them salted, as the unlaid form does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import required
from ..plans.training import HOT_ID_SUPPORT, SALT_BUCKETS
from ..session import temporary_path


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed", path: str | None = None) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``key``, sorted by it, and read it back as a table.

    ``path`` defaults to a temporary path in the shared folder. A null key raises. The session's
    catalogue keeps the layout; another session registers it again with :func:`open_bucketed`.
    """
    spark = df.sparkSession
    path = path or temporary_path(spark, name)
    table = f"foldwise_{uuid.uuid4().hex}"
    (df.withColumn(key, required(key, key)).repartition(buckets, key)
     .write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return spark.table(table)


def open_bucketed(spark, path: str, key: str, buckets: int) -> DataFrame:
    """A table that :func:`write_bucketed` wrote to ``path``, in a new session."""
    table = f"foldwise_{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS")
    return spark.table(table)


def hot_ids(df: DataFrame, key: str, support: float = HOT_ID_SUPPORT) -> list:
    """Ids that hold at least ``support`` of the rows, at most 1 / support: one pass, no exchange of
    rows (the table is laid out by the id, so its counts are local to a bucket)."""
    n = df.count()
    return [r[0] for r in df.groupBy(key).count().filter(F.col("count") >= max(2.0, support * n)).collect()]


def join_bucketed(features: DataFrame, labels: DataFrame, key: str, label: str,
                  support: float = HOT_ID_SUPPORT) -> DataFrame:
    """Inner join of two tables of :func:`write_bucketed`, as ``join_labels`` does.

    All but the hot ids are joined where they lie; the rows of a hot id are dealt to
    ``SALT_BUCKETS`` tasks by a hash of the row.
    """
    lab = labels.select(key, required(F.col(label).cast("double"), label).alias(label))
    hot = hot_ids(features, key, support)
    if not hot:
        return features.join(lab.hint("merge"), key)
    is_hot = F.col(key).isin(hot)
    salted = features.filter(is_hot).withColumn("_salt", F.pmod(F.xxhash64(*features.columns), F.lit(SALT_BUCKETS)).cast("int"))
    repeated = lab.filter(is_hot).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1))))
    return (features.filter(~is_hot).join(lab.filter(~is_hot).hint("merge"), key)
            .unionByName(salted.join(repeated, [key, "_salt"]).drop("_salt")))
