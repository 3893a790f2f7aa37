"""CSV sources: feature file, label file and the single combined file.

The reference reads text lines, drops the first line of partition 0 and splits
on commas. Here the reader is Spark's CSV source with a declared schema: the
header is dropped in every file (a second file's header does not become a
row), a short or malformed row fails the read (FAILFAST), and values are typed
at the scan, so only the columns a plan uses are parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import FeatureSpec


def _reader(spark: SparkSession, schema):
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("enforceSchema", True))


def read_features(spark: SparkSession, path: str | list[str], spec: FeatureSpec) -> DataFrame:
    """Feature file(s): ``id, nominal..., numeric...``.

    An empty nominal field is read as null by the CSV source; it is turned back
    into the empty string so that it stays a level of its own, as in the
    reference's string split.
    """
    df = _reader(spark, spec.feature_schema()).csv(path)
    return df.select(spec.id,
                     *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in spec.nominal],
                     *spec.numeric)


def read_labels(spark: SparkSession, path: str | list[str], spec: FeatureSpec) -> DataFrame:
    """Label file(s): ``id, label``."""
    return _reader(spark, spec.label_schema()).csv(path)


def read_combined(spark: SparkSession, path: str | list[str], spec: FeatureSpec,
                  keep_id: bool = False) -> DataFrame:
    """Single file with the label as its last column (id dropped by default)."""
    df = _reader(spark, spec.combined_schema()).csv(path)
    df = df.select(*([spec.id] if keep_id else []),
                   *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in spec.nominal],
                   *spec.numeric, spec.label)
    return df


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Write a frame as CSV part files (of ``rows_per_file`` rows at most, if given), each with
    its own header line."""
    (df.write.mode("errorifexists").option("header", True)
     .option("maxRecordsPerFile", rows_per_file).csv(path))
