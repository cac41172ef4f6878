"""The training-data pipeline: stages over the documents table, each one operator of haulmark.llm.

Every stage works on all rows its predecessor kept, which are written as Parquet and read again in between.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from haulmark.llm import mixing, near_dup, packing, quality_model, quality_rules, tokens
from haulmark.llm.common import read, table
from haulmark.session import named_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more."""
    return quality_model.keep_good(docs, read(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dup.keep_one(docs, by_text=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come to their target weights."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return packing.packed_documents(docs, tokens.default_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed),
]

#: SQL cannot express trained scores, signatures or planned slots; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    master = spark.sparkContext.master
    if not named_folder(spark) and master.startswith("local") and not master.startswith("local-cluster"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="haulmark-"))  # one process: no executors to share with
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
