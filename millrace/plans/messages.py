"""Queries over conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import messages as m
from millrace.plans.registry import query, view

view("messages", """
SELECT conv_id AS session, turn AS pos, role, CASE WHEN length(text) % 3 = 0 THEN '' ELSE text END AS content,
  CASE WHEN role <> 'assistant' THEN NULL ELSE CASE (length(text) + turn) % 7 WHEN 0 THEN 'write_file' WHEN 1 THEN 'read_file' WHEN 2 THEN 'run_tests' WHEN 3 THEN 'capture_frames' WHEN 4 THEN 'prepare_action' WHEN 5 THEN 'edit' ELSE NULL END END AS tool,
  CASE WHEN role <> 'assistant' THEN NULL ELSE CASE length(text) % 6 WHEN 0 THEN 'plan.md' WHEN 1 THEN '1_core/hero.gd' WHEN 2 THEN 'notes/x.txt' WHEN 3 THEN '4_ui/hud.tscn' WHEN 4 THEN 'README.md' ELSE 'hero.gd' END END AS path,
  CASE WHEN role <> 'assistant' THEN NULL ELSE text END AS body, length(text) % 2 = 0 AS tests_ok
FROM {conversations}
""")  # fmt: skip
view("calls", "SELECT session, pos, tool, path, body FROM {messages} WHERE tool IS NOT NULL")
view("retried_calls", "SELECT session, pos, tool, path, body FROM {calls} UNION ALL SELECT session, pos + 1000, tool, path, body FROM {calls} WHERE (session + pos) % 3 = 0")
view("chat", """
SELECT session, pos, CASE WHEN pos % 5 = 3 THEN 'tool' WHEN pos % 5 = 4 AND role = 'user' THEN 'tool' ELSE role END AS role, content, tool FROM {messages}
""")
#: Word borders are spelled out, as engines differ on \b beside accented letters.
ANNOUNCE = r"(^|[^a-zà-ÿ0-9_])(the|de|la|der|el)[^a-zà-ÿ0-9_.\n]([^.\n]{0,40}[^a-zà-ÿ0-9_.\n])?(and|et|und|que|of)([^a-zà-ÿ0-9_]|\z)"
WRITES, READS = "('write_file', 'write', 'edit')", "('read_file', 'read', 'view')"
LAST_PART = "split_part(path, '/', -1)"


@query("messages", sql="SELECT session, pos, coalesce(role, '') AS role, coalesce(content, '') AS content FROM {messages}")
def normalize_message(messages):
    return m.normalized(messages)


@query("messages", sql="SELECT session, pos, sha256(length(role)::VARCHAR || ':' || role || length(content)::VARCHAR || ':' || content || length(coalesce(tool, ''))::VARCHAR || ':' || coalesce(tool, '')) AS key FROM {messages}")
def message_key(messages):
    return messages.select("session", "pos", m.key("role", "content", "tool").alias("key"))


@query("messages", sql="SELECT session, pos, role, content FROM (SELECT *, max(pos) FILTER (role = 'assistant') OVER (PARTITION BY session) AS l FROM {messages} WHERE role IN ('system', 'user', 'assistant', 'tool')) WHERE pos <= l")
def clean_messages(messages):
    return m.cleaned(messages).select("session", "pos", "role", "content")


@query("messages", sql="SELECT session, count(*) >= 3 AND arg_max(role, pos) = 'assistant' AND bool_and(CASE WHEN i = 0 THEN role = 'system' WHEN i % 2 = 1 THEN role = 'user' ELSE role = 'assistant' END) AS valid FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY pos) - 1 AS i FROM {messages}) GROUP BY session")
def role_alternation(messages):
    return m.alternates(messages)


TURNS = """WITH r AS (SELECT *, coalesce(role = 'tool' AND lag(role) OVER w = 'tool', false) AS j FROM {chat} WHERE role <> 'system' WINDOW w AS (PARTITION BY session ORDER BY pos)),
n AS (SELECT *, sum((NOT j)::INT) OVER (PARTITION BY session ORDER BY pos)::BIGINT - 1 AS turn FROM r),
t AS (SELECT session, turn, arg_min(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN CASE WHEN tool IS NULL THEN 'gpt' ELSE 'function_call' END ELSE 'observation' END, pos) AS "from",
 string_agg(CASE WHEN role = 'assistant' AND tool IS NOT NULL THEN tool ELSE content END, chr(10) ORDER BY pos) AS value FROM n GROUP BY session, turn)"""


@query("chat", sql=TURNS + ' SELECT session, turn, "from", sha256(value) AS value FROM t')
def to_sharegpt(chat):
    return m.sharegpt_turns(chat).withColumn("value", F.sha2(F.col("value").cast("binary"), 256))


@query("chat", sql=TURNS + """ SELECT session, bool_and(CASE WHEN turn % 2 = 0 THEN "from" IN ('human', 'observation') ELSE "from" IN ('gpt', 'function_call') END) AND arg_max("from", turn) IN ('gpt', 'function_call') AS valid, count(*)::BIGINT AS turns FROM t GROUP BY session""")
def sharegpt_validity(chat):
    return m.sharegpt_valid(m.sharegpt_turns(chat))


REPLY = "CASE WHEN role = 'tool' THEN '<tool_response>' || chr(10) || content || chr(10) || '</tool_response>' WHEN role = 'assistant' AND tool IS NOT NULL THEN content || chr(10) || '<tool_call>' || tool || '</tool_call>' ELSE content END"


RENDERED = f"""WITH r AS (SELECT *, {REPLY} AS text, coalesce(role = 'tool' AND lag(role) OVER w = 'tool', false) AS j, pos < coalesce(min(CASE WHEN role <> 'system' THEN pos END) OVER (PARTITION BY session), 1e9) AS head FROM {{chat}} WINDOW w AS (PARTITION BY session ORDER BY pos)),
n AS (SELECT *, sum((NOT head AND NOT j)::INT) OVER (PARTITION BY session ORDER BY pos) AS turn FROM r),
t AS (SELECT session, turn, CASE arg_min(role, pos) WHEN 'assistant' THEN 'gpt' WHEN 'system' THEN 'system' ELSE 'human' END AS f, string_agg(text, chr(10) ORDER BY pos) AS value FROM n WHERE NOT head GROUP BY session, turn),
y AS (SELECT session, string_agg(text, chr(10) ORDER BY pos) AS system, count(*) AS heads FROM n WHERE head GROUP BY session), c AS (SELECT session, count(*) AS turns, bool_and(f = CASE turn % 2 WHEN 1 THEN 'human' ELSE 'gpt' END) AND count(*) % 2 = 0 AS valid, string_agg(f || ':' || value, chr(10) ORDER BY turn) AS said FROM t GROUP BY session)"""


@query("chat", sql=f"""{RENDERED}
SELECT s.session, coalesce(valid, false) AS valid, coalesce(turns, 0)::INT AS turns, coalesce(heads, 0) < 2 AND (heads IS NULL OR system <> '') AS same, sha256(coalesce(system, '') || chr(10) || coalesce(said, '')) AS hash FROM (SELECT DISTINCT session FROM {{chat}}) s LEFT JOIN c USING (session) LEFT JOIN y USING (session)""")
def to_sharegpt_rendered(chat):
    out = m.sharegpt_rendered(chat)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["from"], F.lit(":"), t["value"])), "\n")
    return out.select("session", "valid", F.size("turns").alias("turns"), "same", F.sha2(F.concat("system", F.lit("\n"), said).cast("binary"), 256).alias("hash"))


@query("chat", sql="""SELECT session, sha256(string_agg(CASE WHEN coalesce(role = 'tool' AND p = 'tool', false) THEN '' ELSE '<|im_start|>' || CASE role WHEN 'tool' THEN 'user' ELSE role END || chr(10) END ||
 CASE WHEN role = 'tool' THEN '<tool_response>' || chr(10) || content || chr(10) || '</tool_response>' WHEN tool IS NOT NULL THEN content || chr(10) || '<tool_call>' || tool || '</tool_call>' ELSE content END ||
 CASE WHEN role = 'tool' AND n = 'tool' THEN chr(10) ELSE '<|im_end|>' || chr(10) END, '' ORDER BY pos)) AS text FROM (SELECT *, lag(role) OVER w AS p, lead(role) OVER w AS n FROM {chat} WINDOW w AS (PARTITION BY session ORDER BY pos)) GROUP BY session""")
def render_chat(chat):
    return m.rendered(chat).withColumn("text", F.sha2(F.col("text").cast("binary"), 256))


@query("messages", sql="SELECT session, coalesce(sum(length(content) + length(coalesce(tool, '')) + length(coalesce(path, '')) + length(coalesce(body, ''))) FILTER (role = 'assistant'), 0)::BIGINT AS length FROM {messages} GROUP BY session")
def production_length(messages):
    return m.production(messages)


#: Calls of a server's tools: by a name with the server's, or from code that is given to another tool.
view("served_calls", """
SELECT session, pos, CASE WHEN pos % 3 = 1 THEN 'mill_' || tool ELSE 'execute' END AS tool, CASE WHEN pos % 4 < 3 THEN 'const a = await tools["mill"].' || tool || '(1); // ' || body || ' tools[''mill''] . ' || split_part(path, '.', 1) || '(1)' ELSE body END AS arguments FROM {calls}
""")  # fmt: skip
SERVED = r"""'mill(?:_|\\?["'']\s*\]\s*\.\s*)([A-Za-z_][A-Za-z0-9_]*)'"""


@query("served_calls", sql=f"""WITH x AS (SELECT session, pos, unnest(range(len(t))) AS place, unnest(t) AS tool FROM (SELECT session, pos, regexp_extract_all(tool, {SERVED}, 1) || regexp_extract_all(coalesce(arguments, ''), {SERVED}, 1) AS t FROM {{served_calls}}))
SELECT session, string_agg(tool, ',' ORDER BY pos, place) AS tools, count(DISTINCT tool)::BIGINT AS kinds FROM x GROUP BY session""")
def tool_usage(calls):
    used = m.served_tools(calls, "mill")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "at", "tool"))), lambda x: x["tool"])
    return used.groupBy("session").agg(F.array_join(ordered, ",").alias("tools"), F.countDistinct("tool").alias("kinds"))


PLAN = f"plan AS (SELECT session, CASE WHEN min(pos) FILTER (tool IN {WRITES}) IS NOT NULL THEN coalesce(min(pos) FILTER (tool IN {READS} AND {LAST_PART} IN ('ORGANISATION.md', 'plan.md')) < min(pos) FILTER (tool IN {WRITES}), false) END AS plan_first FROM {{calls}} GROUP BY session)"
REPEATED = f"repeated AS (SELECT session, pos, path FROM (SELECT *, row_number() OVER (PARTITION BY session, path, body ORDER BY pos) AS r FROM {{calls}} WHERE tool IN {WRITES}) WHERE r > 1)"
OUT = f"outside AS (SELECT session, pos, path FROM {{calls}} WHERE tool IN {WRITES} AND NOT (regexp_matches(path, '^[0-7]_(autoload|core|sequence|entities|ui|data|assets|tests)/') OR path IN ('plan.md', 'README.md', 'ORGANISATION.md', 'project.godot', 'AGENTS.md')))"
CAPTURE = "captures AS (SELECT session, pos FROM (SELECT *, lead(content) OVER (PARTITION BY session ORDER BY pos) AS n FROM {messages} WHERE role = 'assistant') WHERE tool IN ('capture_frames', 'capture_ecran') AND trim(n) = '')"
ANNOUNCED = f"""announced AS (SELECT session, pos FROM (SELECT *, last_value(CASE WHEN tool IN {WRITES} THEN 0 WHEN tool = 'run_tests' THEN CASE WHEN tests_ok THEN 1 ELSE 2 END END IGNORE NULLS) OVER (PARTITION BY session ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM {{messages}})
 WHERE role = 'assistant' AND regexp_matches(lower(content), '{ANNOUNCE}') AND coalesce(s, 0) <> 1)"""
UNDECLARED = f"""undeclared AS (SELECT w.session, w.pos, w.path FROM {{messages}} w WHERE w.tool IN {WRITES} AND {LAST_PART.replace("path", "w.path")} NOT IN ('ORGANISATION.md', 'plan.md')
 AND EXISTS (SELECT 1 FROM {{messages}} d WHERE d.session = w.session AND d.tool = 'prepare_action' AND d.pos < w.pos)
 AND NOT EXISTS (SELECT 1 FROM {{messages}} d WHERE d.session = w.session AND d.tool = 'prepare_action' AND d.pos < w.pos AND (d.path = w.path OR ends_with(w.path, '/' || d.path))))"""
REPORT = r"report AS (SELECT session, regexp_matches(c, '[\w/.-]+\.(gd|tscn|tres)\b') AND regexp_matches(lower(c), '\btests?\b') AS report FROM (SELECT session, arg_max(content, pos) AS c FROM {messages} WHERE role = 'assistant' GROUP BY session))"


@query("calls", sql=f"WITH {PLAN} SELECT * FROM plan")
def plan_read_before_write(calls):
    return m.plan_read_first(calls)


@query("retried_calls", sql=f"WITH {REPEATED.replace('calls', 'retried_calls')} SELECT * FROM repeated")
def repeated_writes(calls):
    return m.repeated_writes(calls)


@query("calls", sql=f"WITH {OUT} SELECT * FROM outside")
def out_of_plan_writes(calls):
    return m.out_of_plan(calls)


@query("messages", sql=f"WITH {CAPTURE} SELECT * FROM captures")
def capture_without_comment(messages):
    return m.captures_without_comment(messages)


@query("messages", sql=f"WITH {ANNOUNCED} SELECT * FROM announced")
def announce_without_proof(messages):
    return m.unproven_announcements(messages, ANNOUNCE)


@query("messages", sql=f"WITH {UNDECLARED} SELECT * FROM undeclared")
def undeclared_writes(messages):
    return m.undeclared_writes(messages)


@query("messages", sql=f"WITH {REPORT} SELECT * FROM report")
def closing_report(messages):
    return m.closing_report(messages)


def _n(name: str) -> str:
    return f"coalesce((SELECT count(*) FROM {name} x WHERE x.session = s.session), 0)::BIGINT AS {name}"


@query("messages", sql=f"""WITH {PLAN}, {REPEATED}, {OUT}, {CAPTURE}, {ANNOUNCED}, {UNDECLARED}, {REPORT},
h AS (SELECT s.session, plan_first, {_n("repeated")}, {_n("outside")}, {_n("captures")}, {_n("announced")}, {_n("undeclared")}, coalesce(report, false) AS report FROM (SELECT DISTINCT session FROM {{messages}}) s LEFT JOIN plan USING (session) LEFT JOIN report USING (session))
SELECT session, plan_first, repeated, outside AS out_of_plan, captures, announced, undeclared, report, coalesce(plan_first, true) AND repeated + outside + captures + announced + undeclared = 0 AS ok FROM h""")
def session_health(messages):
    return m.session_health(messages, ANNOUNCE)


@query("calls", sql="SELECT session, pos, r AS rank FROM (SELECT *, unnest([0, 1]) AS r FROM {calls}) WHERE (pos + r) % 4 = 0 OR (session % 5 = 0 AND r = 1)")
def pair_calls_with_returns(calls):
    ranked = calls.select("session", "pos", F.explode(F.array(F.lit(0), F.lit(1))).alias("rank"))
    asked = ranked.withColumn("id", F.concat_ws("-", "session", "pos", "rank"))
    got = asked.filter("(pos + rank) % 4 <> 0").withColumn("id", F.when((F.col("session") % 5 == 0) & (F.col("rank") == 1), F.lit("other")).otherwise(F.col("id")))
    return m.unpaired_calls(asked, got)


@query("calls", sql="""SELECT session, pos, CASE WHEN tool = 'prepare_action' THEN 'unknown tool' WHEN tool IN ('write_file', 'edit') AND session % 3 = 0 THEN 'missing content' WHEN tool = 'run_tests' THEN 'unknown path' ELSE 'ok' END AS status FROM {calls}""")
def call_schema_check(calls):
    """Calls against the tools' arguments: unknown tool, required argument missing, argument unknown."""
    tools = calls.sparkSession.createDataFrame([("write_file", ["path", "content"], ["path", "content"]), ("edit", ["path", "content"], ["path", "content"]), ("read_file", ["path"], ["path"]), ("run_tests", [], ["filter"]), ("capture_frames", [], ["path"])], "tool string, required array<string>, known array<string>")
    given = F.when(F.col("tool").isin("write_file", "edit") & (F.col("session") % 3 != 0), F.array(F.lit("path"), F.lit("content"))).otherwise(F.array(F.lit("path")))
    j = calls.withColumn("given", given).join(F.broadcast(tools), "tool", "left")
    missing, extra = F.array_except("required", "given"), F.array_except("given", "known")
    status = F.when(F.col("known").isNull(), "unknown tool").when(F.size(missing) > 0, F.concat_ws(" ", F.lit("missing"), missing[0])).when(F.size(extra) > 0, F.concat_ws(" ", F.lit("unknown"), extra[0])).otherwise("ok")
    return j.select("session", "pos", status.alias("status"))


LINES = "l AS (SELECT session, pos, role, unnest(string_split(content, chr(10))) AS line FROM {messages})"


@query("messages", sql=f"WITH {LINES} SELECT DISTINCT session, pos, sha256(line) AS line FROM l c WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM l s WHERE s.session = c.session AND s.line = c.line AND s.pos < c.pos)")
def unseen_citations(messages):
    lines = messages.select("session", "pos", "role", F.explode(F.split("content", "\n")).alias("line"))
    unseen = m.unseen_lines(lines.filter("role = 'assistant'").select("session", "pos", "line"), lines.select("session", "pos", "line"))
    return unseen.withColumn("line", F.sha2(F.col("line").cast("binary"), 256))


@query("messages", sql="""SELECT session, pos, CASE WHEN ask <> '' THEN coalesce(starts_with(n, ask), false) ELSE n IS NULL END AS valid FROM (SELECT *, regexp_extract(content, '([a-zA-Z]+)\\.\\s*$', 1) AS ask, lead(content) OVER (PARTITION BY session ORDER BY pos) AS n FROM {messages}) WHERE role = 'assistant'""")
def answer_follows_request(messages):
    """A reply that ends with a command word is followed by a turn that starts with it; otherwise no turn follows."""
    rows = messages.withColumn("next", F.lead("content").over(m.by_pos())).filter("role = 'assistant'").withColumn("ask", F.regexp_extract("content", r"([a-zA-Z]+)\.\s*$", 1))
    return rows.select("session", "pos", F.when(F.col("ask") != "", F.coalesce(F.startswith("next", "ask"), F.lit(False))).otherwise(F.col("next").isNull()).alias("valid"))


view("sizes", "SELECT session, count(*) AS n, sum(length(content)) AS size, max(CASE WHEN tool = 'write_file' THEN 1 ELSE 0 END) AS writes, max(CASE WHEN tool = 'run_tests' THEN 1 ELSE 0 END) AS runs FROM {messages} GROUP BY session")


@query("sizes", sql="""WITH a AS (SELECT session FROM {sizes} WHERE n <= 17 AND writes = 1 ORDER BY size, session LIMIT 1),
b AS (SELECT session FROM {sizes} WHERE n <= 17 AND runs = 1 AND session NOT IN (SELECT session FROM a) ORDER BY size, session LIMIT 1),
c AS (SELECT session FROM {sizes} WHERE n <= 17 AND session NOT IN (SELECT session FROM a UNION ALL SELECT session FROM b) ORDER BY size, session LIMIT 1)
SELECT 'writes' AS condition, session FROM a UNION ALL SELECT 'runs', session FROM b UNION ALL SELECT 'any', session FROM c""")
def showcase_pick(sizes):
    """For each condition in turn the shortest session not taken yet."""
    taken = None
    for name, test in (("writes", "writes = 1"), ("runs", "runs = 1"), ("any", "true")):
        rows = sizes.filter(f"n <= 17 AND {test}")
        if taken is not None:
            rows = rows.join(taken.select("session"), "session", "left_anti")
        pick = rows.orderBy("size", "session").limit(1).select(F.lit(name).alias("condition"), "session")
        taken = pick if taken is None else taken.unionByName(pick)
    return taken
