"""The corpus pipeline: quality, near duplicates, personal data, mix, token ids.

Every stage gets the documents its predecessor kept, read back from Parquet, and
all but the last return rows with the columns of ``documents``. ``run`` applies
them to the ``documents`` table; the last stage's rows are one per document of
the mix (repeats counted): ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``.

Defined results: null, empty and white-space texts fail the quality rules and go; rows with a null
id are nobody's duplicate and stay; of near duplicates and of equal texts the least id stays, and
rows that repeat that id stay together; very long texts are handled whole; rows that agree in id,
source and text share their takes of the mix; an empty table gives empty stages; further columns,
whatever their names, are carried to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm import bpe, minhash, mixing, pii, quality
from foldwise.llm.common import table
from foldwise.llm.registry import vocabularies
from foldwise.session import write_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose source is not rejected."""
    return quality.keep_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    return minhash.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, and digests of the ids and of their decoding."""
    return bpe.round_trip(docs, vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN,
                          with_ids=True)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("personal_data", mask_personal_data), ("mixing", mix_sources), ("bpe", encode)]

#: SQL cannot express byte-level BPE or the bootstrapped patterns; tests compare ``run`` with
#: brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
