"""A corpus from documents to packed sequences: five stages, each over all that the one before kept.

Every stage is (spark, docs, sf_dir) -> DataFrame and returns the columns of ``documents``, but for the last, which
returns the pieces of the packed sequences. run() writes each result as Parquet in the shared folder and reads it again,
so that no stage is computed twice and lost executors cost one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewarden.llm import classifier, mixing, packing, simhash, suffixes
from tidewarden.llm.common import materialise, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, doesn't reject."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut from the text; n_chars follows it."""
    return suffixes.without_repeats(docs).selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 2,048 token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("suffix_dedup", no_repeats),
    ("mixing", mixed),
    ("packing", packed),
]
#: SQL can't express the classifier, the fingerprints or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
