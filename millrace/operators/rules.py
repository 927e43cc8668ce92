"""Rules over code lines, measures against a reference, balance of generated work, and reassembly of streamed answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def by_rule(found: DataFrame) -> DataFrame:
    """Per script (id): violations in all, and counts by rule as text."""
    counts = found.groupBy("id", "rule").agg(F.count(F.lit(1)).alias("n"))
    named = F.sort_array(F.collect_list(F.concat_ws("=", "rule", F.col("n").cast("string"))))
    return counts.groupBy("id").agg(F.sum("n").alias("total"), F.array_join(named, ",").alias("rules"))


def triage(project: DataFrame, session: DataFrame) -> DataFrame:
    """Violations of attempts by project and session rules, added up rule by rule, with a flag for each side."""
    both = project.withColumn("side", F.lit("project")).unionByName(session.withColumn("side", F.lit("session")))
    counts = both.groupBy("attempt", "rule").agg(F.sum("n").alias("n"), F.max(F.when(F.col("side") == "project", 1).otherwise(0)).alias("p"), F.max(F.when(F.col("side") == "session", 1).otherwise(0)).alias("s"))
    named = F.sort_array(F.collect_list(F.concat_ws("=", "rule", F.col("n").cast("string"))))
    return counts.groupBy("attempt").agg(F.sum("n").alias("violations"), F.array_join(named, ",").alias("rules"), (F.max("p") == 0).alias("structure_ok"), (F.max("s") == 0).alias("session_ok"))


def written_output(text: Column) -> Column:
    """Beginning of a command block that holds more than the command, or the mark of an exit code; else null."""
    fences = F.regexp_extract_all(text, F.lit(r"```[a-z]*\n([^`]*)```"), F.lit(1))
    full = F.filter(fences, lambda b: F.ltrim(b).startswith("$ ") & (F.size(F.filter(F.split(b, "\n"), lambda x: F.trim(x) != "")) > 1))
    return F.coalesce(F.substring(F.get(F.split(F.ltrim(F.get(full, F.lit(0))), "\n"), F.lit(0)), 1, 80), F.when(text.contains("(exit code"), F.lit("(exit code")))


def balance(rows: DataFrame, group: list[str], kind: str, one: str, other: str, measure: str) -> DataFrame:
    """Measure of one kind over that of the other, per group, rounded to 2 places; null without the other."""
    of = lambda k: F.sum(F.when(F.col(kind) == k, F.col(measure)))
    return rows.groupBy(*group).agg(F.round(of(one) / of(other), 2).alias("ratio"))


def efficiency(measures: DataFrame) -> DataFrame:
    """Candidate against reference per task: allocations 0, batches at most 1.05 x, time at most 1.15 x by medians, render equal.

    ``errors`` come in the order render, allocations, batches, time.
    """
    side = lambda k, c: F.median(F.when(F.col("side") == k, F.col(c)))
    m = measures.groupBy("task").agg(
        F.max(F.when(F.col("side") == "candidate", F.col("allocations"))).alias("allocations"),
        side("candidate", "batches").alias("b1"), side("reference", "batches").alias("b0"), side("candidate", "time").alias("t1"), side("reference", "time").alias("t0"),
        F.max(F.when(F.col("side") == "candidate", F.col("render"))).alias("r1"), F.max(F.when(F.col("side") == "reference", F.col("render"))).alias("r0"),
    )
    tests = (("render", F.col("r1") != F.col("r0")), ("allocations", F.col("allocations") > 0), ("batches", F.col("b1") > 1.05 * F.col("b0")), ("time", F.col("t1") > 1.15 * F.col("t0")))
    return m.select("task", F.array_join(F.array_compact(F.array(*(F.when(t, F.lit(n)) for n, t in tests))), ",").alias("errors"))


def assembled(chunks: DataFrame) -> DataFrame:
    """Streamed answers (response, at, data) to one message each: contents in order up to [DONE]; unreadable chunks are skipped."""
    ends = chunks.groupBy("response").agg(F.min(F.when(F.col("data") == "[DONE]", F.col("at"))).alias("stop"))
    parsed = chunks.join(ends, "response").filter("stop IS NULL OR at < stop").withColumn("x", F.from_json("data", "content string, finish string"))
    known = parsed.filter("x.content IS NOT NULL OR x.finish IS NOT NULL")
    ordered = F.transform(F.sort_array(F.collect_list(F.when(F.col("x.content").isNotNull(), F.struct("at", "x.content")))), lambda c: c["content"])
    return known.groupBy("response").agg(F.array_join(ordered, "").alias("content"), F.max_by("x.finish", F.when(F.col("x.finish").isNotNull(), F.col("at"))).alias("finish"))
