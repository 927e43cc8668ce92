"""Queries of the evaluation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import scores
from millrace.plans import registry
from millrace.plans.registry import query, view
from millrace.sources import folders

view("results", """
SELECT CASE WHEN year(l_shipdate) % 2 = 0 THEN 'r0' ELSE 'r1' END AS round,
  CASE l_suppkey % 6 WHEN 0 THEN 'base' WHEN 1 THEN 'base_rag' WHEN 2 THEN 'lora' WHEN 3 THEN 'lora_rag' WHEN 4 THEN 'frontier' ELSE 'frontier_rag' END AS configuration,
  'S' || lpad(CAST(l_partkey % 16 AS varchar(3)), 2, '0') AS skill, l_orderkey AS task, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
  l_extendedprice AS price, (l_quantity > CASE WHEN l_suppkey % 6 IN (3, 4) THEN 20 WHEN l_suppkey % 6 = 5 THEN 22 ELSE 30 END) AS ok
FROM {lineitem}
""")  # fmt: skip

KEY, ORDER = ["round", "configuration", "skill", "task"], ["line", "part", "supp", "price"]
LAST = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round, configuration, skill, task ORDER BY line DESC, part DESC, supp DESC, price DESC, ok DESC) AS rn FROM {results}) WHERE rn = 1)"""
COUNTS = """scored AS (SELECT skill, configuration, sum(ok::INT)::BIGINT AS k, count(*)::BIGINT AS n FROM last WHERE round = 'r0' OR configuration LIKE 'frontier%' GROUP BY ALL)"""
INTERVAL = """bounds AS (SELECT *, k / n AS rate,
  CASE WHEN k = 0 THEN 0.0 ELSE greatest(0.0, (k / n + 3.8414588206941254 / (2 * n)) / (1 + 3.8414588206941254 / n) - 1.959963984540054 * sqrt(k / n * (1 - k / n) / n + 3.8414588206941254 / (4.0 * n * n)) / (1 + 3.8414588206941254 / n)) END AS low,
  CASE WHEN k = n THEN 1.0 ELSE least(1.0, (k / n + 3.8414588206941254 / (2 * n)) / (1 + 3.8414588206941254 / n) + 1.959963984540054 * sqrt(k / n * (1 - k / n) / n + 3.8414588206941254 / (4.0 * n * n)) / (1 + 3.8414588206941254 / n)) END AS high FROM {from})"""


def bounds(source: str) -> str:
    return INTERVAL.replace("{from}", source)


def scored(results: DataFrame, chosen: str = "r0") -> DataFrame:
    return scores.counts(scores.last_wins(results, KEY, ORDER), chosen)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("results", sql=f"WITH {LAST} SELECT round, configuration, skill, task, line, ok FROM last")
def read_results_last_wins(results):
    return scores.last_wins(results, KEY, ORDER).select(*KEY, "line", "ok")


def _result_files(spark, sf_dir):
    """All results as files of JSON lines in their order, one line in 13 cut off and one in 17 blank, read back."""
    root = folders.scratch(spark)
    r = registry.read(spark, sf_dir, "results")
    line = F.to_json(F.struct(F.col("round").alias("tour"), "configuration", F.col("skill").alias("competence"), F.concat("skill", F.lit("/"), F.col("task").cast("string")).alias("tache_id"), "ok", F.col("line").cast("double").alias("duree_juge_s")))
    cut = F.when(F.col("part") % 17 == 0, F.lit(" ")).when(F.col("part") % 13 == 0, F.expr("substring(j, 1, length(j) - 5)")).otherwise(F.col("j"))
    ordered = r.withColumn("j", line).repartitionByRange(4, *ORDER, "ok").sortWithinPartitions(*ORDER, "ok")
    ordered.select(cut.alias("value")).write.text(root)
    return folders.read_results(spark, root).select("tour", "configuration", "tache_id", "ok", F.col("duree_juge_s").cast("long").alias("line"))


registry.QUERIES["read_results_files"] = _result_files
registry.ORACLES["read_results_files"] = registry.oracle(f"WITH {LAST.replace('{results})', '{results} WHERE part % 13 <> 0 AND part % 17 <> 0)')} SELECT round AS tour, configuration, skill || '/' || task AS tache_id, ok, line::BIGINT AS line FROM last")


@query("results", sql=f"WITH {LAST}, {COUNTS} SELECT * FROM scored")
def score_counts(results):
    return scored(results)


@query("results", sql=f"WITH {LAST}, {COUNTS}, {bounds('scored')} SELECT skill, configuration, k, n, round(rate, 6) AS rate, round(low, 6) AS low, round(high, 6) AS high FROM bounds")
def wilson_interval(results):
    return rounded(scores.with_interval(scored(results)), "rate", "low", "high")


WIDE = """skills AS (SELECT 'S' || lpad(i::VARCHAR, 2, '0') AS skill FROM range(14) t(i) UNION SELECT skill FROM scored),
pick AS (SELECT s.skill, coalesce(max(b.n), 0) AS n, {picks} FROM skills s LEFT JOIN bounds b USING (skill) GROUP BY s.skill),
ruled AS (SELECT *, CASE WHEN coalesce(lora_rag_n, 0) = 0 OR coalesce(base_rag_n, 0) = 0 THEN 'not measured' WHEN lora_rag_high < base_rag_low THEN 'below'
  WHEN lora_rag_low <= base_rag_high THEN CASE WHEN lora_rag_low = base_rag_high THEN 'touch' ELSE 'overlap' END
  WHEN coalesce(frontier_rag_n, 0) = 0 THEN 'no frontier' WHEN lora_rag_k * frontier_rag_n >= frontier_rag_k * lora_rag_n THEN 'frontier reached' ELSE 'below frontier' END AS reason FROM pick),
judged AS (SELECT *, CASE reason WHEN 'not measured' THEN 'not measured' WHEN 'below' THEN 'defeat' WHEN 'frontier reached' THEN 'victory' ELSE 'tie' END AS verdict FROM ruled)""".replace(
    "{picks}", ", ".join(f"max(b.{c}) FILTER (b.configuration = '{f}') AS {f}_{c}" for f in scores.CONFIGURATIONS + scores.FRONTIERS for c in ("k", "n", "rate", "low", "high"))
)
ALL = [f"{f}_{c}" for f in scores.CONFIGURATIONS + scores.FRONTIERS for c in ("k", "n", "rate", "low", "high")]


@query("results", sql=f"WITH {LAST}, {COUNTS}, {bounds('scored')}, {WIDE} SELECT skill, verdict, reason FROM judged")
def win_rule(results):
    return scores.win_rule(scores.wide(scored(results))).select("skill", "verdict", "reason")


@query("results", sql=f"WITH {LAST}, {COUNTS}, {bounds('scored')}, {WIDE} SELECT skill, n, verdict, reason, {', '.join(c if c[-2:] in ('_k', '_n') else f'round({c}, 6) AS {c}' for c in ALL)} FROM judged")
def score_table(results):
    table = scores.win_rule(scores.wide(scored(results)))
    return rounded(table, *(c for c in ALL if c[-2:] not in ("_k", "_n"))).select("skill", "n", "verdict", "reason", *ALL)


@query("results", sql=f"WITH {LAST}, {COUNTS}, {bounds('scored')}, {WIDE} SELECT verdict, count(*)::BIGINT AS skills FROM judged GROUP BY verdict")
def verdict_tally(results):
    return scores.win_rule(scores.wide(scored(results))).groupBy("verdict").agg(F.count(F.lit(1)).alias("skills"))


ROUNDS = f"""WITH {LAST}, scored AS (SELECT round, skill, sum(ok::INT)::BIGINT AS k, count(*)::BIGINT AS n FROM last WHERE configuration = 'lora_rag' GROUP BY ALL), {bounds("scored")},
a AS (SELECT * FROM bounds WHERE round = 'r0' AND skill <> 'S03'), b AS (SELECT * FROM bounds WHERE round = 'r1' AND skill <> 'S05'),
j AS (SELECT coalesce(a.skill, b.skill) AS skill, a.k AS old_k, a.n AS old_n, b.k AS new_k, b.n AS new_n, CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'absent' WHEN b.high < a.low THEN 'setback'
 WHEN b.k * a.n < a.k * b.n THEN 'drop' WHEN b.k * a.n > a.k * b.n THEN 'rise' ELSE 'stable' END AS status FROM a FULL JOIN b USING (skill))"""


@query("results", sql=f"{ROUNDS} SELECT *, status IN ('absent', 'setback') AS blocking FROM j")
def regression_status(results):
    kept = scores.last_wins(results, KEY, ORDER).filter("configuration = 'lora_rag'")
    side = lambda name, without: kept.filter((F.col("round") == name) & (F.col("skill") != without)).groupBy("skill").agg(F.sum(F.col("ok").cast("long")).alias("k"), F.count(F.lit(1)).alias("n"))
    return scores.regression(side("r0", "S03"), side("r1", "S05")).select("skill", "old_k", "old_n", "new_k", "new_n", "status", "blocking")


@query("events", sql="SELECT event_type, round(median(value), 6) AS median, round(avg(value), 6) AS mean, max(value) AS longest, count(value)::BIGINT AS calls FROM {events} GROUP BY event_type")
def latency_stats(events):
    return rounded(scores.latency(events, ["event_type"], "value"), "median", "mean")


@query("supplier", sql="SELECT s_suppkey, s_name, s_acctbal FROM {supplier} ORDER BY s_acctbal DESC, s_suppkey LIMIT 10")
def leaderboard_top(supplier):
    return supplier.select("s_suppkey", "s_name", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(10)
