"""Evaluation: pass rates, Wilson intervals, verdicts and regressions between rounds.

Results have (round, configuration, skill, task, seq, ok); configurations ``frontier*`` are measured once, whatever the round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quantile 97.5 % of the normal distribution; a fixed value.
Z_95 = 1.959963984540054
CONFIGURATIONS = ("base", "base_rag", "lora", "lora_rag")
FRONTIERS = ("frontier", "frontier_rag")
SKILLS = tuple(f"S{i:02d}" for i in range(14))


def last_wins(results: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """For each key the row that comes last in ``order``; a maximum, so hot keys combine before the shuffle."""
    rest = [c for c in results.columns if c not in key and c not in order]
    last = results.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("x"))
    return last.select(*key, *(F.col(f"x.{c}").alias(c) for c in [*order, *rest]))


def counts(results: DataFrame, chosen: str | None = None) -> DataFrame:
    """Successes k of n per (skill, configuration). Without a choice, several rounds of own configurations are an error."""
    own = F.col("configuration").isin(*CONFIGURATIONS)
    if chosen is not None:
        return results.filter(~own | (F.col("round") == chosen)).groupBy("skill", "configuration").agg(F.sum(F.col("ok").cast("long")).alias("k"), F.count(F.lit(1)).alias("n"))
    rounds = results.filter(own).select("round").distinct().limit(2).collect()
    if len(rounds) > 1:
        raise ValueError("results of several rounds: choose one")
    return results.groupBy("skill", "configuration").agg(F.sum(F.col("ok").cast("long")).alias("k"), F.count(F.lit(1)).alias("n"))


def wilson(k: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval: exact at 0 and n successes, [0, 1] for n = 0, an error for an impossible k."""
    bad = (n < 0) | (k < 0) | (k > n)
    size = F.when(n > 0, n).otherwise(F.lit(1)).cast("double")
    p, z2 = k / size, z * z
    centre = (p + z2 / (2 * size)) / (1 + z2 / size)
    half = z * F.sqrt(p * (1 - p) / size + z2 / (4 * size * size)) / (1 + z2 / size)
    low = F.when(bad, F.raise_error("impossible k of n").cast("double")).when((n == 0) | (k == 0), 0.0).otherwise(F.greatest(F.lit(0.0), centre - half))
    high = F.when((n == 0) | (k == n), 1.0).otherwise(F.least(F.lit(1.0), centre + half))
    return low, high


def with_interval(scored: DataFrame) -> DataFrame:
    low, high = wilson(F.col("k"), F.col("n"))
    return scored.withColumn("rate", F.when(F.col("n") > 0, F.col("k") / F.col("n"))).withColumn("low", low).withColumn("high", high)


def wide(scored: DataFrame) -> DataFrame:
    """One row a skill: every known skill, then others; k, n, rate, low, high of each configuration."""
    names = list(CONFIGURATIONS + FRONTIERS)
    skills = scored.sparkSession.createDataFrame([(s,) for s in SKILLS], "skill string").union(scored.select("skill")).distinct()
    pivot = with_interval(scored).groupBy("skill").pivot("configuration", names).agg(
        *(F.first(c).alias(c) for c in ("k", "n", "rate", "low", "high"))
    )
    out = skills.join(pivot, "skill", "left")
    return out.withColumn("n", F.coalesce(F.greatest(*(F.coalesce(f"{c}_n", F.lit(0)) for c in names)), F.lit(0)))


def win_rule(table: DataFrame) -> DataFrame:
    """verdict and reason: strict separation of intervals, then the exact fraction against the frontier."""
    n = lambda c: F.coalesce(F.col(f"{c}_n"), F.lit(0))
    unknown = (n("lora_rag") == 0) | (n("base_rag") == 0)
    apart = F.col("lora_rag_low") > F.col("base_rag_high")
    reaches = F.col("lora_rag_k") * F.col("frontier_rag_n") >= F.col("frontier_rag_k") * F.col("lora_rag_n")
    reason = (
        F.when(unknown, "not measured").when(F.col("lora_rag_high") < F.col("base_rag_low"), "below")
        .when(~apart & (F.col("lora_rag_low") == F.col("base_rag_high")), "touch").when(~apart, "overlap")
        .when(n("frontier_rag") == 0, "no frontier").when(reaches, "frontier reached").otherwise("below frontier")
    )
    table = table.withColumn("reason", reason)
    verdict = F.when(F.col("reason") == "not measured", "not measured").when(F.col("reason") == "below", "defeat").when(F.col("reason") == "frontier reached", "victory").otherwise("tie")
    return table.withColumn("verdict", verdict)


def regression(old: DataFrame, new: DataFrame) -> DataFrame:
    """Skill by skill: new, absent, setback (interval wholly below), drop, rise, stable; blocking for absent and setback."""
    a = with_interval(old).select("skill", *(F.col(c).alias(f"old_{c}") for c in ("k", "n", "low", "high")))
    b = with_interval(new).select("skill", *(F.col(c).alias(f"new_{c}") for c in ("k", "n", "low", "high")))
    less = F.col("new_k") * F.col("old_n") - F.col("old_k") * F.col("new_n")
    status = (
        F.when(F.coalesce("old_n", F.lit(0)) == 0, "new").when(F.coalesce("new_n", F.lit(0)) == 0, "absent")
        .when(F.col("new_high") < F.col("old_low"), "setback").when(less < 0, "drop").when(less > 0, "rise").otherwise("stable")
    )
    return a.join(b, "skill", "full").withColumn("status", status).withColumn("blocking", F.col("status").isin("absent", "setback"))


def latency(calls: DataFrame, by: list[str], column: str) -> DataFrame:
    x = F.col(column)
    return calls.groupBy(*by).agg(F.median(x).alias("median"), F.avg(x).alias("mean"), F.max(x).alias("longest"), F.count(x).alias("calls"))
