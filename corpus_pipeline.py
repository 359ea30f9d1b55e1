"""Corpus pipeline: good documents, without repeated lines, near copies and benchmark passages, packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage's result as Parquet to the session's shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontamination, jaccard_join, line_dedup, packing, quality_classifier
from quarry.llm._store import written
from quarry.llm.queries import BYTE_TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on them and their labels, rejects go."""
    return quality_classifier.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; a document of which nothing is left goes too."""
    return line_dedup.drop_lines(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return jaccard_join.keep_one(spark, docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontamination.drop_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pieces(packing.pack(spark, docs, public_tokenizers.path(BYTE_TOKENIZER)))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("packing", sequences),
]

# The classifier, the sketches and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs
