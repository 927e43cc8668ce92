"""Near names: the share of two names that lies in matching blocks, and the nearest known names of asked ones."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.retrieval import top_n


def similarity(asked: str, known: str, least: float) -> Column:
    """Twice the letters in matching blocks by the letters of both names, to 6 digits; 0 for pairs that a bound shows to be below ``least``.

    The longest common block counts, then those on its left and on its right. Two names may reach 0.6 without a common pair of
    letters (one letter each lies between the letters they share), so no q-gram can stand for the pair; lengths and letter counts
    are exact bounds. The column isn't deterministic to the planner, so that a filter on it doesn't compute it twice.
    """

    def score(words: pd.Series, names: pd.Series) -> pd.Series:
        matcher, last, out = SequenceMatcher(), None, []
        for word, name in zip(words, names, strict=True):
            if word != last:
                matcher.set_seq2(word)
                last = word
            matcher.set_seq1(name)
            near = matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least
            out.append(round(matcher.ratio(), 6) if near else 0.0)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(score, "double").asNondeterministic()(F.col(asked), F.col(known))


def close_names(asked: DataFrame, known: DataFrame, ratio: float = 0.6, top: int = 3, block: int = 2_000, within: Sequence[str] = ()) -> DataFrame:
    """Rows (*within, query, rank, id, score): up to ``top`` known names per asked name with a similarity of ``ratio`` or more.

    ``within`` names columns of both that must be equal (a member's class): an equi-join. Without it asked names go in blocks of about
    ``block`` or fewer, each broadcast against all known names of a fitting length, so no pair is lost to a blocking key.
    A name isn't near itself; null names are left out; repeated rows count once; equal scores go to the last name.
    """
    keys = list(within)
    a = asked.filter("name IS NOT NULL").select(*keys, F.col("name").alias("query"), F.length("name").alias("n")).distinct()
    k = known.filter("name IS NOT NULL").select(*keys, F.col("name").alias("id"), F.length("name").alias("m")).distinct()
    share = ratio / (2 - ratio)
    fits = (F.col("n") >= share * F.col("m")) & (F.col("m") >= share * F.col("n")) & (F.col("query") != F.col("id"))

    def best(pairs: DataFrame) -> DataFrame:
        scored = pairs.select(F.struct(*keys, "query").alias("query"), "id", similarity("query", "id", ratio).alias("score")).filter(F.col("score") >= ratio)
        return top_n(scored, top, ties="last").select("query.*", "rank", "id", "score")

    if keys:
        return best(a.join(k, keys).filter(fits))
    blocks = -(-2 * a.count() // block)
    if blocks <= 2:
        return best(k.join(F.broadcast(a), fits))
    dealt = a.withColumn("_b", F.pmod(F.xxhash64("query"), F.lit(blocks))).checkpoint()
    return reduce(DataFrame.unionByName, [best(k.join(F.broadcast(dealt.filter(F.col("_b") == b).drop("_b")), fits)).checkpoint() for b in range(blocks)])


def listed(near: DataFrame, *keys: str) -> DataFrame:
    """Rows (*keys, near): the ranked names of each key in one text."""
    ranked = F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"])
    return near.groupBy(*keys).agg(F.array_join(ranked, "; ").alias("near"))
