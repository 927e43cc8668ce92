"""Queries of attempts, gates and run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import rounds
from millrace.plans.registry import query, view

view("attempts", """
SELECT 't' || CAST(user_id AS varchar(20)) || '_' || event_type AS task, event_type AS skill,
  CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS bigint) AS attempt,
  CASE WHEN value > 60 THEN 'True' WHEN value > 40 THEN 'oui' WHEN value > 30 THEN '1' ELSE 'False' END AS ok,
  event_id % 97 AS length, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 5 END AS violations,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 11 <> 0 END AS structure_ok, event_id % 13 <> 0 AS session_ok, event_id
FROM {events}
""")  # fmt: skip
view("passed", """
SELECT * FROM {attempts} WHERE lower(ok) IN ('true', '1', 'oui') AND (structure_ok IS NULL OR structure_ok) AND (session_ok IS NULL OR session_ok)
""")
view("verdicts", """
SELECT user_id AS task, CASE WHEN event_id % 2 = 0 THEN 'start' ELSE 'reference' END AS version,
  CAST(row_number() OVER (PARTITION BY user_id, event_id % 2 ORDER BY event_id) AS bigint) AS repetition,
  CASE WHEN user_id % 3 = 0 THEN event_id % 2 = 1 ELSE (event_id % 2 = 1) = (event_id % 40 > 1) END AS ok,
  event_type AS step, event_id % 2 AS failures, user_id % 9 AS total
FROM (SELECT * FROM {events} WHERE event_type = CASE WHEN user_id % 2 = 0 THEN 'click' ELSE event_type END) e
""")
view("mutants", "SELECT user_id AS task, event_id AS mutant, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value > 20 END AS killed FROM {events}")
view("decisions", """
SELECT o_orderpriority AS skill, o_orderkey AS task, o_orderstatus <> 'P' AS qualified, o_orderkey % 7 = 0 AS frozen,
  o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 AS accepted,
  CASE WHEN o_orderstatus = 'P' THEN 'unstable' WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN 'duplicate' END AS reason
FROM {orders}
""")
view("labels_text", "SELECT doc_id, CASE quality WHEN 1 THEN 'Oui' ELSE 'no' END AS said, toxic FROM {labels}")
LIVE = "lower(ok) IN ('true', '1', 'oui')"


@query("labels_text", sql="SELECT doc_id, said = 'Oui' AS yes, toxic = 1 AS flag FROM {labels_text}")
def truthy(labels):
    return labels.select("doc_id", rounds.truthy("said").alias("yes"), rounds.truthy("toxic").alias("flag"))


@query("attempts", sql="SELECT task, attempt, length, coalesce(violations, 0) AS violations FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY coalesce(violations, 0), length, attempt) AS r FROM {passed}) WHERE r = 1")
def best_attempt(attempts):
    return rounds.best_attempt(attempts)


@query("attempts", sql=f"SELECT task, count(*)::BIGINT AS attempts, sum(({LIVE})::INT)::BIGINT AS successes, CASE WHEN count(*) <> 13 THEN 'incomplete' WHEN sum(({LIVE})::INT) < 2 THEN 'too hard' WHEN sum(({LIVE})::INT) > 8 THEN 'too easy' ELSE 'keep' END AS difficulty FROM {{attempts}} GROUP BY task")
def difficulty_class(attempts):
    return rounds.difficulty(attempts, 13, 2, 8)


@query("attempts", sql="SELECT task, attempt FROM {attempts} a WHERE NOT EXISTS (SELECT 1 FROM {passed} p WHERE p.task = a.task AND p.attempt = a.attempt)")
def resume_anti_join(attempts):
    return rounds.remaining(attempts.select("task", "attempt"), rounds.passed(attempts), ["task", "attempt"])


@query("attempts", sql="SELECT task FROM {attempts} GROUP BY task HAVING count(DISTINCT attempt) >= 13")
def complete_tasks(attempts):
    return rounds.complete_tasks(attempts, 13)


@query("attempts", sql="SELECT task, attempt, length FROM {attempts} WHERE (skill <> 'error' AND task NOT IN (SELECT task FROM {attempts} WHERE skill = 'click')) OR skill = 'click'")
def upsert_by_task(attempts):
    rows = attempts.select("task", "attempt", "length", "skill")
    return rounds.upsert(rows.filter("skill <> 'error'"), rows.filter("skill = 'click'"), "task").drop("skill")


@query("attempts", sql=f"SELECT task, 'retry' AS list FROM {{attempts}} GROUP BY task HAVING task NOT IN (SELECT task FROM {{passed}}) UNION ALL SELECT task, 'acquired' FROM {{attempts}} GROUP BY task HAVING count(*) = 13 AND sum(({LIVE})::INT) > 8")
def retry_and_acquired_lists(attempts):
    easy = rounds.difficulty(attempts, 13, 2, 8).filter("difficulty = 'too easy'").select("task", F.lit("acquired").alias("list"))
    return rounds.to_retry(attempts).withColumn("list", F.lit("retry")).unionByName(easy)


@query("verdicts", sql="""SELECT task, version, first_bad, outcomes, CASE WHEN first_bad = 1 THEN CASE version WHEN 'start' THEN 'start_not_red' ELSE 'reference_not_green' END WHEN first_bad IS NOT NULL OR outcomes > 1 THEN 'unstable' END AS reason
FROM (SELECT task, version, min(repetition) FILTER (ok = (version = 'start')) AS first_bad, count(DISTINCT (step, failures, total))::BIGINT AS outcomes FROM {verdicts} GROUP BY task, version)""")
def stability_gate(verdicts):
    return rounds.stability(verdicts)


@query("mutants", sql="""SELECT task, coalesce(sum(killed::INT), 0)::BIGINT AS killed, count(killed)::BIGINT AS total, round(sum(killed::INT) / count(killed), 6) AS score,
coalesce(array_to_string((array_agg(mutant ORDER BY mutant) FILTER (NOT killed))[1:3], ','), '') AS survivors, coalesce(sum(killed::INT) / count(killed) >= 0.5, false) AS enough FROM {mutants} GROUP BY task""")
def mutation_score(mutants):
    return rounds.mutation_score(mutants).withColumn("score", F.round("score", 6)).withColumn("killed", F.coalesce("killed", F.lit(0)))


@query("decisions", sql="""WITH r AS (SELECT coalesce(skill, '(total)') AS skill, string_agg(reason || '=' || n::VARCHAR, ',' ORDER BY reason) AS reasons FROM (SELECT skill, reason, count(*) AS n FROM {decisions} WHERE reason IS NOT NULL GROUP BY GROUPING SETS ((skill, reason), (reason))) GROUP BY 1)
SELECT s.*, coalesce(r.reasons, '') AS reasons FROM (SELECT coalesce(skill, '(total)') AS skill, count(*)::BIGINT AS candidates, sum(qualified::INT)::BIGINT AS qualified, sum(frozen::INT)::BIGINT AS frozen, sum(accepted::INT)::BIGINT AS accepted FROM {decisions} GROUP BY ROLLUP (skill)) s LEFT JOIN r USING (skill)""")
def gate_report(decisions):
    return rounds.gate_report(decisions)


@query("lineitem", "part", sql="""SELECT l_orderkey AS answer, l_linenumber AS line, l_partkey AS task, CASE WHEN p_partkey IS NULL OR p_size > 40 THEN 'unknown task' WHEN p_size % 4 <> l_linenumber % 4 THEN 'other version' WHEN p_partkey % 3 = 0 THEN 'already judged' ELSE 'matched' END AS status
FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey""")
def match_answers_to_tasks(lineitem, part):
    answers = lineitem.select(F.col("l_orderkey").alias("answer"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("task"), (F.col("l_linenumber") % 4).cast("string").alias("hash"))
    tasks = part.filter("p_size <= 40").select(F.col("p_partkey").alias("task"), (F.col("p_size") % 4).cast("string").alias("hash"))
    return rounds.match_answers(answers, tasks, part.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("task"))).drop("hash")


@query("orders", sql="""WITH d AS (SELECT o_orderkey FROM {orders} WHERE o_orderkey % 50 IN (0, 1) OR (o_orderstatus = 'P' AND o_totalprice > 100000))
SELECT (SELECT count(*) FROM d)::BIGINT AS differing, (SELECT string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM d ORDER BY 1 LIMIT 20)) AS first""")
def compare_runs(orders):
    a = orders.filter("o_orderkey % 50 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = orders.filter("o_orderkey % 50 <> 1").select("o_orderkey", F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000), "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")
    return rounds.compare(a, b, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("decisions", sql="SELECT skill, task FROM (SELECT skill, task, row_number() OVER (PARTITION BY skill ORDER BY task) AS r FROM {decisions} WHERE skill IN ('1-URGENT', '5-LOW') AND NOT frozen) WHERE r <= 12")
def select_tasks(decisions):
    return rounds.select_tasks(decisions.filter("NOT frozen").select("skill", "task"), ["1-URGENT", "5-LOW"], 12, decisions.filter("frozen"))


@query("events", sql="SELECT event_id, user_id, event_type FROM {events} EXCEPT SELECT event_id, user_id, CASE WHEN user_id % 2 = 0 THEN 'click' ELSE event_type END FROM {events}")
def comparable_verdict(events):
    """Volatile columns (time, value) are dropped before two runs are compared."""
    rows = events.drop("ts", "value", "props")
    other = rows.withColumn("event_type", F.when(F.col("user_id") % 2 == 0, "click").otherwise(F.col("event_type")))
    return rows.exceptAll(other)


@query("documents", "pages", sql="SELECT doc_id AS id, lang AS skill, 'documents' AS origin FROM {documents} WHERE lang IN ('en', 'fr') UNION ALL SELECT page_id, CASE page_id % 2 WHEN 0 THEN 'en' ELSE 'de' END, 'pages' FROM {pages} WHERE page_id % 2 = 0")
def union_sources(documents, pages):
    a = documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("skill"), F.lit("documents").alias("origin"))
    b = pages.select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 2 == 0, "en").otherwise("de").alias("skill"), F.lit("pages").alias("origin"))
    return a.unionByName(b).filter(F.col("skill").isin("en", "fr"))
