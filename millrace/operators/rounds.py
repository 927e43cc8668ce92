"""Attempts, verdicts and gates: choose attempts, classify difficulty, merge rounds, report decisions.

Attempts have (task, skill, attempt, ok, length, violations, structure_ok, session_ok); the last three may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRUE_WORDS = ("true", "1", "oui")


def truthy(column: str) -> Column:
    """Text, number or boolean to boolean; anything else than the true words, null included, is false."""
    return F.coalesce(F.lower(F.col(column).cast("string")).isin(*TRUE_WORDS), F.lit(False))


def passed(attempts: DataFrame) -> DataFrame:
    ok = truthy("ok")
    for c in ("structure_ok", "session_ok"):
        ok = ok & (F.col(c).isNull() | truthy(c))
    return attempts.filter(ok)


def best_attempt(attempts: DataFrame) -> DataFrame:
    """Per task the passing attempt of least (violations, length, attempt); a minimum of structs, no sort."""
    order = F.struct(F.coalesce("violations", F.lit(0)).alias("violations"), "length", "attempt")
    return passed(attempts).groupBy("task").agg(F.min(order).alias("x")).select("task", "x.attempt", "x.length", "x.violations")


def to_retry(attempts: DataFrame) -> DataFrame:
    return attempts.select("task").distinct().join(passed(attempts).select("task"), "task", "left_anti")


def difficulty(attempts: DataFrame, expected: int, least: int, most: int) -> DataFrame:
    """too hard / too easy / keep by the number of successes; incomplete unless there are ``expected`` attempts."""
    counted = attempts.groupBy("task").agg(F.count(F.lit(1)).alias("attempts"), F.sum(truthy("ok").cast("long")).alias("successes"))
    label = F.when(F.col("attempts") != expected, "incomplete").when(F.col("successes") < least, "too hard").when(F.col("successes") > most, "too easy").otherwise("keep")
    return counted.withColumn("difficulty", label)


def remaining(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Work that isn't done: same round, configuration, id and content hash."""
    return wanted.join(done.select(*key), key, "left_anti")


def complete_tasks(attempts: DataFrame, expected: int) -> DataFrame:
    return attempts.groupBy("task").agg(F.countDistinct("attempt").alias("n")).filter(F.col("n") >= expected).select("task")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of a redone key replace all its old rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def stability(verdicts: DataFrame, expected_failures: str = "start") -> DataFrame:
    """Per (task, version): first unexpected repetition, different outcomes, and the reason.

    Versions named ``expected_failures`` should fail, all others pass.
    """
    unexpected = F.col("ok") == (F.col("version") == expected_failures)
    per = verdicts.groupBy("task", "version").agg(
        F.min(F.when(unexpected, F.col("repetition"))).alias("first_bad"), F.countDistinct(F.struct("step", "failures", "total")).alias("outcomes")
    )
    wrong = F.when(F.col("version") == expected_failures, "start_not_red").otherwise("reference_not_green")
    return per.withColumn("reason", F.when(F.col("first_bad") == 1, wrong).when(F.col("first_bad").isNotNull() | (F.col("outcomes") > 1), "unstable"))


def mutation_score(mutants: DataFrame, threshold: float = 0.5) -> DataFrame:
    """killed / total per task (null for none), first three survivors, whether the threshold is reached."""
    alive = F.when(~F.col("killed"), F.col("mutant"))
    per = mutants.groupBy("task").agg(
        F.sum(F.col("killed").cast("long")).alias("killed"), F.count("killed").alias("total"), F.sort_array(F.collect_list(alive)).alias("s")
    )
    score = F.when(F.col("total") > 0, F.col("killed") / F.col("total"))
    return per.select("task", "killed", "total", score.alias("score"), F.array_join(F.slice("s", 1, 3), ",").alias("survivors"), F.coalesce(score >= threshold, F.lit(False)).alias("enough"))


def gate_report(decisions: DataFrame) -> DataFrame:
    """Per skill and in total: candidates, qualified, frozen, accepted, and rejects by reason as text."""
    reasons = decisions.filter("reason IS NOT NULL").rollup("skill", "reason").agg(F.count(F.lit(1)).alias("n"), F.grouping("skill").alias("all"), F.grouping("reason").alias("g"))
    per_skill = reasons.filter("g = 0 AND all = 0").select("skill", "reason", "n")
    overall = per_skill.groupBy("reason").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("skill"), "reason", "n")
    named = per_skill.unionByName(overall).groupBy("skill").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "reason", F.col("n").cast("string")))), ",").alias("reasons"))
    flag = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    sums = decisions.rollup("skill").agg(F.count(F.lit(1)).alias("candidates"), flag("qualified").alias("qualified"), flag("frozen").alias("frozen"), flag("accepted").alias("accepted"))
    s, n = sums.alias("s"), named.alias("n")
    joined = s.join(n, F.col("s.skill").eqNullSafe(F.col("n.skill")), "left")
    return joined.select(F.coalesce("s.skill", F.lit("(total)")).alias("skill"), "candidates", "qualified", "frozen", "accepted", F.coalesce("reasons", F.lit("")).alias("reasons"))


def match_answers(answers: DataFrame, tasks: DataFrame, judged: DataFrame) -> DataFrame:
    """status of each answer: unknown task, other version (its hash differs), already judged, or matched."""
    a, t = answers.alias("a"), tasks.select("task", F.col("hash").alias("task_hash")).alias("t")
    done = judged.select("task", F.lit(True).alias("done")).distinct()
    joined = a.join(t, "task", "left").join(done, "task", "left")
    status = F.when(F.col("task_hash").isNull(), "unknown task").when(F.col("task_hash") != F.col("hash"), "other version").when(F.coalesce("done", F.lit(False)), "already judged")
    return joined.withColumn("status", status.otherwise("matched")).drop("task_hash", "done")


def compare(a: DataFrame, b: DataFrame, key: str, values: list[str], show: int = 20) -> DataFrame:
    """One row: number of keys that differ or miss a side, and the first of them."""
    x, y = a.select(key, F.struct(*values).alias("x")), b.select(key, F.struct(*values).alias("y"))
    differing = x.join(y, key, "full").filter(~F.col("x").eqNullSafe(F.col("y"))).select(key)
    first = differing.orderBy(key).limit(show).agg(F.array_join(F.sort_array(F.collect_list(key)), ",").alias("first"))
    return differing.agg(F.count(F.lit(1)).alias("differing")).crossJoin(first)


def select_tasks(tasks: DataFrame, skills: list[str], each: int, frozen: DataFrame) -> DataFrame:
    """The first ``each`` tasks of each chosen skill, in id order; a frozen task among them is an error.

    Ranks come from a heap of the ids per skill (partial aggregation), not from a sort of the skill.
    """
    chosen = tasks.filter(F.col("skill").isin(*skills))
    if chosen.join(frozen.select("task"), "task", "left_semi").limit(1).count():
        raise ValueError("a frozen task is among the chosen ones")
    return first_n(chosen, "skill", ["task"], each)


def first_n(rows: DataFrame, key: str, order: list[str], n: int, buckets: int = 64) -> DataFrame:
    """The first n rows of each key in the order given: ranked within buckets first, so a hot key is never one task."""
    from pyspark.sql.window import Window

    salted = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    near = salted.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_b").orderBy(*order))).filter(F.col("_r") <= n)
    return near.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_r") <= n).drop("_r", "_b")
