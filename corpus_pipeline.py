"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns
a DataFrame; all but the last return the columns of ``documents``, further ones that the table has included.  ``run`` writes
each stage's rows as Parquet in the shared folder, reads them as the next one's docs, and deletes what only earlier stages read.

An empty table gives an empty result in every stage.  Null texts count as empty ones: the quality rules reject them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewake.llm import op3_quality, op4_pii, op8_packing, op9_minhash, op10_decontaminate
from tidewake.llm.common import release, stage, staged_paths, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and short texts among them.  Rows are judged each by itself, so
    repeated rows and rows without an id share a verdict and stay or go together."""
    return op3_quality.kept_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: one with the least doc_id (null last; ties by the text's key and digest).  Rows
    of different texts that share an id, or have none, are told apart; of repeated rows one stays."""
    return op9_minhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go; null and blank items occur nowhere, and without items all stay."""
    return op10_decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays, a null text as null, and n_chars is that of the new text."""
    return op4_pii.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of the documents that are left: a null or empty text is its end id, repeated rows are packed each."""
    return op8_packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", packing),
]

#: Signatures, spans learned by a model and a packing search are beyond SQL; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), staged_paths()
    for k, (_, function) in enumerate(STAGES):
        docs, path = stage(function(spark, docs, sf_dir), f"stage-{k}")
        release(spark, staged_paths() - before - {path})
    return docs
