"""Queries of line rules, efficiency, balance and streamed answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import code, orders, rules
from millrace.plans.code import BROKEN
from millrace.plans.registry import query, view

@query("scripts", sql=f"WITH {BROKEN} SELECT id, line, rule FROM v")
def rule_violations(scripts):
    return code.violations(scripts)


@query("scripts", sql=f"WITH {BROKEN}, c AS (SELECT id, rule, count(*) AS n FROM v GROUP BY ALL) SELECT id, sum(n)::BIGINT AS total, string_agg(rule || '=' || n::VARCHAR, ',' ORDER BY rule) AS rules FROM c GROUP BY id")
def violations_by_rule(scripts):
    return rules.by_rule(code.violations(scripts))


@query("events", sql="""WITH b AS (SELECT user_id AS attempt, CASE WHEN value > 50 THEN event_type ELSE 'QA-' || (event_id % 3)::VARCHAR END AS rule, 1 AS n, CASE WHEN value > 50 THEN 'p' ELSE 's' END AS side FROM {events}),
c AS (SELECT attempt, rule, sum(n) AS n, max((side = 'p')::INT) AS p, max((side = 's')::INT) AS s FROM b GROUP BY ALL)
SELECT attempt, sum(n)::BIGINT AS violations, string_agg(rule || '=' || n::VARCHAR, ',' ORDER BY rule || '=' || n::VARCHAR) AS rules, max(p) = 0 AS structure_ok, max(s) = 0 AS session_ok FROM c GROUP BY attempt""")
def attempt_triage(events):
    """Every event breaks a rule: of the project if its value is high, else of the session."""
    project = events.filter("value > 50").select(F.col("user_id").alias("attempt"), F.col("event_type").alias("rule"), F.lit(1).alias("n"))
    session = events.filter("NOT coalesce(value > 50, false)").select(F.col("user_id").alias("attempt"), F.concat(F.lit("QA-"), (F.col("event_id") % 3).cast("string")).alias("rule"), F.lit(1).alias("n"))
    return rules.triage(project, session)


@query("conversations", sql=r"""WITH s AS (SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '[`$]', '', 'g') AS said, length(coalesce(text, '')) % 4 AS k FROM {conversations}), l AS (SELECT *, string_split(said, chr(10)) AS x FROM s)
SELECT conv_id, turn, CASE WHEN k = 1 AND len(list_filter(x, lambda y: trim(y) <> '')) >= CASE WHEN trim(x[1]) <> '' THEN 2 ELSE 1 END THEN substring('$ ' || x[1], 1, 80) WHEN k = 3 OR contains(said, '(exit code') THEN '(exit code' END AS found FROM l""")
def fake_output_check(conversations):
    """Whole texts as a command block, whose first line is the command, as text with an exit code, or as they are."""
    said = F.regexp_replace(F.coalesce("text", F.lit("")), "[`$]", "")
    kind = F.length(F.coalesce("text", F.lit(""))) % 4
    fenced = F.concat(F.lit("Look:\n```sh\n$ "), said, F.lit("\n```"))
    text = F.when(kind == 1, fenced).when(kind == 3, F.concat(said, F.lit(" (exit code 0)"))).otherwise(said)
    return conversations.select("conv_id", "turn", rules.written_output(text).alias("found"))


BALANCE = "b AS (SELECT l_orderkey, round(sum(l_quantity) FILTER (l_linestatus = 'O') / sum(l_quantity) FILTER (l_linestatus = 'F'), 2) AS ratio FROM {lineitem} GROUP BY ALL)"


@query("lineitem", sql=f"""WITH {BALANCE}, r AS (SELECT ratio, row_number() OVER (ORDER BY ratio) - 1 AS i, row_number() OVER (ORDER BY ratio DESC) AS d, count(*) OVER () AS n FROM b WHERE ratio IS NOT NULL)
SELECT ratio, 'low' AS place FROM r WHERE i < 3 UNION ALL SELECT ratio, 'high' FROM r WHERE d <= 3 UNION ALL SELECT ratio, 'middle' FROM r WHERE i = n // 2""")
def balance_by_step(lineitem):
    found = rules.balance(lineitem, ["l_orderkey"], "l_linestatus", "O", "F", "l_quantity")
    return orders.extremes(found, "ratio").withColumnRenamed("value", "ratio")


view("measures", """
SELECT user_id AS task, CASE WHEN event_id % 2 = 0 THEN 'candidate' ELSE 'reference' END AS side, CASE WHEN event_id % 400 = 0 THEN 1 ELSE 0 END AS allocations,
  value AS time, event_id % 17 + 20 AS batches, CASE WHEN user_id % 10 = 0 THEN event_id % 2 ELSE 0 END AS render FROM {events}
""")


@query("measures", sql="""WITH m AS (SELECT task, max(allocations) FILTER (side = 'candidate') AS a, median(batches) FILTER (side = 'candidate') AS b1, median(batches) FILTER (side = 'reference') AS b0, median(time) FILTER (side = 'candidate') AS t1, median(time) FILTER (side = 'reference') AS t0,
 max(render) FILTER (side = 'candidate') AS r1, max(render) FILTER (side = 'reference') AS r0 FROM {measures} GROUP BY task)
SELECT task, concat_ws(',', CASE WHEN r1 <> r0 THEN 'render' END, CASE WHEN a > 0 THEN 'allocations' END, CASE WHEN b1 > 1.05 * b0 THEN 'batches' END, CASE WHEN t1 > 1.15 * t0 THEN 'time' END) AS errors FROM m""")
def efficiency_gate(measures):
    return rules.efficiency(measures)


@query("conversations", sql="SELECT conv_id AS response, sha256(string_agg(CASE WHEN turn % 5 = 4 THEN '' ELSE text END, '' ORDER BY turn)) AS content, 'stop' AS finish FROM {conversations} GROUP BY conv_id")
def sse_to_message(conversations):
    """Turns as chunks of one streamed answer, some unreadable, then the finish, [DONE] and a chunk too late."""
    chunk = F.when(F.col("turn") % 5 == 4, F.lit("{broken")).otherwise(F.to_json(F.struct(F.col("text").alias("content"))))
    chunks = conversations.select(F.col("conv_id").alias("response"), F.col("turn").alias("at"), chunk.alias("data"))
    ids = conversations.select(F.col("conv_id").alias("response")).distinct()
    tail = lambda at, data: ids.select("response", F.lit(at).cast("bigint").alias("at"), F.lit(data).alias("data"))
    every = chunks.unionByName(tail(10_000, '{"finish": "stop"}')).unionByName(tail(10_001, "[DONE]")).unionByName(tail(10_002, '{"content": "late"}'))
    return rules.assembled(every).withColumn("content", F.sha2(F.col("content").cast("binary"), 256))
