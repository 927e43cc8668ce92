"""Queries over logs: lines of documents, dressed as log lines by their number."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import logs
from millrace.plans.registry import query, view

DRESS = """CASE (line * 7 + log) % 11 WHEN 0 THEN 'ERROR: ' || {part} WHEN 1 THEN '   at: f (res://' || CASE WHEN line % 3 = 0 THEN 'addons/x' ELSE 'scripts/h' || CAST(log % 5 AS varchar(9)) END || '.gd:' || CAST(line % 40 AS varchar(9)) || ')'
 WHEN 2 THEN 'SCRIPT ERROR: Parse Error: ' || {part} WHEN 3 THEN '   at: g (res://scripts/k.gd:' || CAST(line % 9 AS varchar(9)) || ')' WHEN 4 THEN 'ERROR: res://scenes/c.tscn:' || CAST(line % 12 AS varchar(9)) || ' - File not found: x'
 WHEN 5 THEN 'ERROR: 3 resources still in use at exit' WHEN 6 THEN '   at: clear (core/io.cpp:1)' WHEN 7 THEN chr(27) || '[31mERROR: Invalid operands' || chr(27) || '[0m' WHEN 8 THEN '  in res://scripts/z.gd:' || CAST(line % 6 AS varchar(9)) ELSE {part} END"""
PART = "replace(raw, chr(10), '_')"
view(
    "log_lines",
    "SELECT log, line, " + DRESS.replace("{part}", PART) + " AS text FROM (SELECT doc_id AS log, CAST(p AS bigint) + 1 AS line, t AS raw FROM {documents} LATERAL VIEW posexplode(split(text, '[ ]')) x AS p, t) r",
    "SELECT log, line, " + DRESS.replace("{part}", PART) + " AS text FROM (SELECT doc_id AS log, unnest(range(1, len(string_split(text, ' ')) + 1)) AS line, unnest(string_split(text, ' ')) AS raw FROM {documents}) r",
)
NOISE = logs.NOISE
PLAIN = r"plain AS (SELECT log, line, regexp_replace(text, '\x1B\[[0-9;?]*[A-Za-z]', '', 'g') AS text FROM {log_lines})"
CLEAN = rf"""{PLAIN}, clean AS (SELECT log, line, text FROM (SELECT *, coalesce(regexp_matches(lower(lag(text) OVER (PARTITION BY log ORDER BY line)), '\b(leaked|in use|exist) at exit\b'), false) AND starts_with(ltrim(text), 'at:') AS a FROM plain) WHERE NOT a AND NOT regexp_matches(lower(text), '{NOISE}'))"""
BLOCKS = r"""s AS (SELECT *, regexp_matches(text, '^\s*(USER )?(SCRIPT ERROR|ERROR): (.*)$') AS st, regexp_matches(text, '^[ \t]') AS ind FROM clean),
n AS (SELECT *, sum(st::INT) OVER (PARTITION BY log ORDER BY line)::BIGINT AS block FROM s), k AS (SELECT *, sum((NOT st AND NOT ind)::INT) OVER (PARTITION BY log, block ORDER BY line) AS br FROM n WHERE block > 0),
b AS (SELECT log, block, min(line) AS line, trim(regexp_extract(min(text) FILTER (st), '^\s*(USER )?(SCRIPT ERROR|ERROR): (.*)$', 3), ' ') AS message, coalesce(list(text ORDER BY line) FILTER (NOT st), []) AS body FROM k WHERE br = 0 GROUP BY log, block)"""
ERRORS = rf"""p AS (SELECT *, list_transform(flatten(list_transform(body, lambda t: regexp_extract_all(t, '\(?(res://[^\s:()]+):([0-9]+)\)?', 0))), lambda q: regexp_replace(q, '[()]', '', 'g')) AS ps, regexp_matches(message, '^(res://[^\s:]+):([0-9]+) - (.*)$') AS inl FROM b WHERE NOT regexp_matches(lower(message), '{NOISE}')),
q AS (SELECT log, line, CASE WHEN inl THEN regexp_extract(message, '^(res://[^\s:]+):([0-9]+) - (.*)$', 3) ELSE message END AS message, CASE WHEN inl THEN regexp_extract(message, '^(res://[^\s:]+:[0-9]+) - (.*)$', 1) ELSE coalesce(list_filter(ps, lambda x: NOT starts_with(x, 'res://addons/'))[1], ps[1]) END AS place FROM p),
e AS (SELECT log, line, message, regexp_extract(place, '^(.*):([0-9]+)$', 1) AS file, regexp_extract(place, '^(.*):([0-9]+)$', 2)::INT AS number, {{category}} AS category FROM q)"""
CATEGORY = "CASE " + " ".join(f"WHEN regexp_matches(lower(message), '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}'" for n, p in logs.CATEGORIES) + " ELSE 'autre' END"
ERRORS = ERRORS.replace("{{category}}", CATEGORY).replace("{category}", CATEGORY)


@query("log_lines", sql=f"WITH {CLEAN} SELECT * FROM clean")
def drop_noise(lines):
    return logs.without_noise(lines)


@query("log_lines", sql=f"WITH {CLEAN}, {BLOCKS} SELECT log, block, line, message, len(body)::INT AS body FROM b")
def error_blocks(lines):
    return logs.blocks(logs.without_noise(lines)).withColumn("body", F.size("body"))


@query("log_lines", sql=f"WITH {CLEAN}, {BLOCKS}, {ERRORS} SELECT log, line, file, number FROM e")
def error_location(lines):
    return logs.errors(logs.without_noise(lines)).select("log", "line", "file", "number")


@query("log_lines", sql=f"WITH {CLEAN}, {BLOCKS}, {ERRORS} SELECT category, count(*)::BIGINT AS n FROM e GROUP BY category")
def categorize_error(lines):
    return logs.errors(logs.without_noise(lines)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("log_lines", sql=f"WITH {CLEAN}, {BLOCKS}, {ERRORS} SELECT log, file, number, category, message, min(line) AS line FROM e GROUP BY ALL")
def distinct_errors(lines):
    return logs.distinct_errors(logs.errors(logs.without_noise(lines)))


@query("log_lines", sql=f"""WITH {PLAIN}, n AS (SELECT *, sum(regexp_matches(text, '^(SCRIPT ERROR|ERROR|WARNING|ok)')::INT) OVER (PARTITION BY log ORDER BY line)::BIGINT AS block FROM plain),
h AS (SELECT log, block, string_agg(text, chr(10) ORDER BY line) AS key FROM (SELECT *, row_number() OVER (PARTITION BY log, block ORDER BY line) AS i FROM n) WHERE i <= 2 GROUP BY log, block),
r AS (SELECT *, row_number() OVER (PARTITION BY log, key ORDER BY block) AS nth FROM h)
SELECT n.log, sum((nth <= 2)::INT)::BIGINT AS kept, count(DISTINCT n.block) FILTER (nth > 2)::BIGINT AS dropped FROM n JOIN r USING (log, block) GROUP BY n.log""")
def compact_repeats(lines):
    plain = lines.withColumn("text", F.regexp_replace("text", logs.COLOURS, ""))
    return logs.compact(plain).groupBy("log").agg(F.sum(F.col("kept").cast("long")).alias("kept"), F.countDistinct(F.when(~F.col("kept"), F.col("block"))).alias("dropped"))


@query("log_lines", sql="""WITH s AS (SELECT *, last_value(CASE WHEN starts_with(text, 'SCRIPT ERROR') THEN line END IGNORE NULLS) OVER (PARTITION BY log ORDER BY line) AS segment FROM {log_lines})
SELECT log, coalesce(segment, -1) AS segment, count(*)::BIGINT AS lines, bool_or(starts_with(text, 'ERROR')) AS review FROM s GROUP BY ALL""")
def marker_segments(lines):
    found = logs.segments(lines, "^SCRIPT ERROR").withColumn("segment", F.coalesce("segment", F.lit(-1)))
    return found.groupBy("log", "segment").agg(F.count(F.lit(1)).alias("lines"), F.bool_or(F.col("text").startswith("ERROR")).alias("review"))


@query("log_lines", sql=rf"""WITH {CLEAN}, s AS (SELECT *, regexp_matches(text, '^\s*(USER )?(SCRIPT ERROR|ERROR): (.*)$') AS st FROM clean),
o AS (SELECT *, last_value(CASE WHEN st THEN line END IGNORE NULLS) OVER w AS opened, last_value(CASE WHEN st THEN trim(regexp_extract(text, '^\s*(USER )?(SCRIPT ERROR|ERROR): (.*)$', 3), ' ') END IGNORE NULLS) OVER w AS message FROM s WINDOW w AS (PARTITION BY log ORDER BY line)),
f AS (SELECT log, opened, min(line) AS line, arg_min(message, line) AS message, arg_min(text, line) AS text FROM o WHERE NOT st AND starts_with(ltrim(text), 'at:') AND regexp_matches(text, '\(?(res://[^\s:()]+):([0-9]+)\)?') AND opened IS NOT NULL GROUP BY log, opened)
SELECT log, regexp_extract(text, '\(?(res://[^\s:()]+):([0-9]+)\)?', 1) AS file, regexp_extract(text, '\(?(res://[^\s:()]+):([0-9]+)\)?', 2)::INT AS number, arg_min(message, line) AS message FROM f GROUP BY ALL""")
def carry_error_message(lines):
    return logs.carried(logs.without_noise(lines))


view("cases", "SELECT doc_id % 50 AS report, 'c' || CAST(doc_id AS varchar(20)) AS name, CASE doc_id % 7 WHEN 0 THEN 'failure' WHEN 1 THEN 'skipped' WHEN 2 THEN 'error' ELSE 'ok' END AS outcome FROM {documents}")


@query("cases", sql="""SELECT report, count(*)::BIGINT AS total, (count(*) - count(DISTINCT name) FILTER (outcome IN ('failure', 'error')) - sum((outcome = 'skipped')::INT))::BIGINT AS passed, sum((outcome = 'skipped')::INT)::BIGINT AS skipped,
coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (outcome IN ('failure', 'error')), '') AS failed FROM {cases} GROUP BY report""")
def junit_tally(cases):
    return logs.junit_tally(cases)
