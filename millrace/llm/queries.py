"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, hash_tree, lm, near_join, ogg, packing, quality, ranked_search, spelling, substring_dedup, suffix_dedup, token_counts, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.join(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(warc.warc_round_trip(table(spark, sf_dir, "pages")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_corpus(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_edited(token_counts.sample_edits(table(spark, sf_dir, "documents")))


def op7_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.decode_media(ogg.encode_media(table(spark, sf_dir, "documents")))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assign(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_warc, op3_packing, op4_lm_scoring, op5_substring_dedup,
        op6_token_counts, op7_ogg_media, op8_suffix_array_dedup, op9_decontamination, op10_quality,
        op11_ranked_search, op12_hash_tree, op13_spelling_variants,
    )
}

ORACLES: dict[str, str] = {
    "op2_warc": warc.SQL, "op9_decontamination": decontam.SQL,
    "op11_ranked_search": ranked_search.SQL, "op12_hash_tree": hash_tree.SQL, "op13_spelling_variants": spelling.SQL,
}
