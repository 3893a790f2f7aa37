"""Session helpers: a local session for tests and benches, and the shared folder
for materialised intermediates.

On a cluster the caller owns the session; nothing here overrides settings that
are already present. Intermediates that cut lineage are written below
``spark.checkpoint.dir`` (a shared file system on a cluster). A private folder
is created only when that setting is absent *and* the master is local.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Parquet row groups of written intermediates: small enough that a filter on a
# clustering column (fold) skips most of each file, and a small table still makes several tasks.
ROW_GROUP_BYTES = 4 << 20

_written: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "foldwise") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path.

    A driver may have found the package by its own ``sys.path`` alone; workers
    that are started elsewhere could not import it then. A folder that an
    executor lacks (the package is installed there) does no harm.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    have = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master may
    fall back to a fresh private folder (tests); a cluster without the setting
    is an error, because a machine-local folder would be lost with its node.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        # a directory set with SparkContext.setCheckpointDir (a per-application subfolder)
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="foldwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}foldwise/{name}-{uuid.uuid4().hex}"


def temporary_path(spark: SparkSession, name: str) -> str:
    """A scratch path that :func:`drop_scratch` deletes."""
    _written.append(scratch_path(spark, name))
    return _written[-1]


def scratch_mark() -> int:
    """The place in the list of temporary paths from which a job's own ones follow."""
    return len(_written)


def write_table(df: DataFrame, name: str, cluster_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of recomputing
    joins) and gives later passes column pruning. ``cluster_by`` sorts each
    task's rows before writing: one file per task (a directory partitioning
    would write one file per task *and* value), while Parquet row-group
    statistics still let a filter such as ``fold = k`` skip most row groups.
    """
    spark = df.sparkSession
    path = temporary_path(spark, name)
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    (df.write.mode("errorifexists")
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .parquet(path))
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one written table or model; for the end of a step whose frames are used no more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    if path in _written:
        _written.remove(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of :func:`write_table` whose frame is used no more (a no-op for others)."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        own = next((w for w in _written if path.split(":", 1)[-1].lstrip("/") == w.split(":", 1)[-1].lstrip("/")), None)
        if own:
            delete_path(df.sparkSession, own)


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the temporary tables written since a :func:`scratch_mark`; for the end of a job,
    when no frame that reads them is used any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_written) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)

