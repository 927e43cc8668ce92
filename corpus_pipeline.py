"""A cleaning pipeline over ``documents``: each stage takes what its predecessor kept and returns a DataFrame.

All stages but the last return the columns of ``documents``; the last returns the places of the packed pieces.

Defined results, in every stage: without rows there are none; columns beyond those of ``documents`` stay with their rows, whatever
their names; rows of one doc_id are judged each. Null and empty texts are scored like others (the first stage), are no copies of each
other (the second), hold no passage and no item (the third and fourth), and are one end token (the last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, near_join, packing, quality, substring_dedup
from millrace.llm.common import materialize

#: Share of hit words above which a document goes as a whole; below, only the hit words go.
MOSTLY_BENCHMARK = 0.5


def _with_length(docs: DataFrame, like: DataFrame) -> DataFrame:
    """Texts have changed: n_chars, where it is a column, says their new length."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below one half go; it learns from labels of the documents at hand.

    Equal texts have equal scores. Without labels every score is one half, so all stay.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays: the one of smallest doc_id; of repeated rows of it, one."""
    return near_join.keep_one(docs)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id has as well are cut out; n_chars is that of what is left."""
    return _with_length(substring_dedup.remove(docs), docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows are cut out; documents of which more than half are such words go. Without items all stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(decontam.clean(docs, benchmark, MOSTLY_BENCHMARK), docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the pieces of all documents in sequences of 1024 tokens; each document ends with one more token."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_removal),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: A learned classifier is not expressible in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
