"""Training tables that a second program finds instead of building them again.

A table lies below a root folder under a key made of its name, spec, options and input files; beside
it stands a manifest: the same facts, the encoder, the number of rows and the folder of the rows.
The manifest is written last, by a job of its own that Spark commits as a whole, and is the only way
to a table: rows without a manifest (an interrupted write) are never read, and a changed, added or
removed input file makes another key. Two programs that build the same table at once each write their
rows; the first manifest stands and both read its rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import Encoder
from ..session import ROW_GROUP_BYTES
from ..spec import FeatureSpec
from .training import TrainingTable, prepare_training


def input_fingerprint(*frames: DataFrame) -> dict:
    """Number and checksum of the files that the frames read: path, size and time of each, listed by
    Spark (contents are not read)."""
    read = [df.inputFiles() for df in frames]
    if not all(read):
        raise ValueError("a table is reused by its input files; a frame reads none")
    files = sorted({f for of in read for f in of})
    spark = frames[0].sparkSession
    listed = (spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime").distinct())
    row = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                     F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).alias("h")).first()
    return {"files": row["n"], "bytes": row["bytes"], "checksum": str(row["h"])}


@dataclass
class Reused:
    table: TrainingTable
    hit: bool         # the table was found, nothing was built
    manifest: dict


def _read(spark: SparkSession, path: str) -> dict | None:
    """The manifest, or None where none is committed (the marker is the last file of a commit)."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        return None
    return json.loads(spark.read.text(path).first()["value"])


def _table(spark: SparkSession, m: dict) -> TrainingTable:
    enc = Encoder.from_json(m["encoder"])
    return TrainingTable(spark.read.parquet(m["rows"]), enc, m["n_folds"], enc.spec, _n_rows=m["n_rows"])


def reusable_training(features: DataFrame, labels: DataFrame | None, spec: FeatureSpec, root: str, name: str,
                      n_folds: int = 10, seed: int | None = None, coding: str = "dummy",
                      folds: str = "hash") -> Reused:
    """:func:`prepare_training`, or the table it made before below ``root``.

    ``name`` stands for what the frames do with their files (filters, derived columns): change it when
    that changes. The frames must read files.
    """
    spark = features.sparkSession
    facts = {"name": name, "spec": {"id": spec.id, "nominal": list(spec.nominal), "numeric": list(spec.numeric),
                                    "label": spec.label},
             "columns": features.columns, "labels": labels.columns if labels is not None else None,
             "n_folds": n_folds, "seed": seed, "coding": coding, "folds": folds,
             "inputs": input_fingerprint(features, *([labels] if labels is not None else []))}
    key = hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()[:32]
    home = f"{root.rstrip('/')}/{key}"
    found = _read(spark, f"{home}/manifest")
    if found is not None:
        return Reused(_table(spark, found), True, found)
    tt = prepare_training(features, labels, spec, n_folds=n_folds, seed=seed, coding=coding, folds=folds, materialize=False)
    rows = f"{home}/rows-{uuid.uuid4().hex}"
    tt.df.sortWithinPartitions("fold").write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(rows)
    manifest = facts | {"rows": rows, "n_rows": spark.read.parquet(rows).count(), "encoder": tt.encoder.to_json()}
    try:
        text = spark.createDataFrame([(json.dumps(manifest),)], "value string")
        text.coalesce(1).write.mode("errorifexists").text(f"{home}/manifest")
    except AnalysisException:
        found = _read(spark, f"{home}/manifest")  # another program was faster
        if found is None:
            raise
        return Reused(_table(spark, found), True, found)
    return Reused(_table(spark, manifest), False, manifest)
