"""Queries of the first gates, over tasks, proposals and scripts made of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import admission as a
from millrace.plans.names import ratios
from millrace.plans.registry import query, view

view("task_files", """
SELECT CAST(floor(doc_id / 5) AS bigint) AS id, CASE WHEN doc_id % 7 = 0 THEN 'tests_caches/test_' ELSE 'depart/f' END || CAST(doc_id AS varchar(20)) || '.gd' AS path, coalesce(text, '') AS text FROM {documents}
""")
view("task_heads", """
SELECT CAST(floor(doc_id / 5) AS bigint) AS id, CASE WHEN min(doc_id) % 11 = 0 THEN ' ' ELSE max(lang) END AS origin, CASE WHEN min(doc_id) % 9 = 0 THEN NULL ELSE array_join(transform(array_sort(collect_list(struct(doc_id, text))), x -> x.text), ' ') END AS instruction FROM {documents} GROUP BY 1
""", """
SELECT doc_id // 5 AS id, CASE WHEN min(doc_id) % 11 = 0 THEN ' ' ELSE max(lang) END AS origin, CASE WHEN min(doc_id) % 9 = 0 THEN NULL ELSE string_agg(text, ' ' ORDER BY doc_id) END AS instruction FROM {documents} GROUP BY 1
""")
SUMS = """(SELECT id, string_agg(path || ' ' || sha256(text), chr(10) ORDER BY path) AS lines, count(*) FILTER (starts_with(path, 'tests_caches/test_')) AS tests FROM {task_files} GROUP BY id)"""
VERSION = "proposal/1"


@query("task_heads", "task_files", sql=f"""WITH f AS {SUMS}, t AS (SELECT h.*, f.tests, concat_ws(',', CASE WHEN trim(coalesce(origin, '')) = '' THEN 'origin' END, CASE WHEN trim(coalesce(instruction, '')) = '' THEN 'instruction' END) AS lacking FROM {{task_heads}} h LEFT JOIN f USING (id))
SELECT id, CASE WHEN lacking <> '' THEN 'missing: ' || lacking WHEN id % 6 = 1 THEN 'wrong hash' WHEN coalesce(tests, 0) = 0 THEN 'no hidden test' END AS reason FROM t""")
def task_format_check(heads, files):
    """Hashes written down by the tasks: right ones, but for one in six, which lost a file's last character."""
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    hashed = files.withColumn("hash", digest("text")).select("id", "path", "hash")
    lines = F.sort_array(F.collect_list(F.struct("path", F.concat_ws(" ", "path", "hash").alias("line"))))
    sums = hashed.groupBy("id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("lines"))
    damaged = F.when(F.col("id") % 6 == 1, F.concat("lines", F.lit("."))).otherwise(F.col("lines"))
    tasks = heads.join(sums.select("id", F.sha2(damaged.cast("binary"), 256).alias("hash")), "id", "left")
    return a.task_format_check(tasks, hashed, ("origin", "instruction"))


view("proposals", """
SELECT page_id AS id, CASE WHEN page_id % 19 = 0 THEN 'proposal/0' ELSE 'proposal/1' END AS format, split_part(split_part(url, '/', 3), '.', 1) AS skill,
 CASE WHEN page_id % 4 = 0 THEN split_part(url, '/', 3) ELSE url END AS instruction, CASE WHEN page_id % 3 = 0 THEN split_part(url, '://', 2) || '.gd' WHEN page_id % 13 = 1 THEN url || '.gd' WHEN page_id % 17 = 2 THEN 'a/../b.gd' WHEN page_id % 23 = 1 THEN 'tests_juge/x.gd' ELSE 'core/p' || CAST(page_id AS varchar(20)) || '.tscn' END AS path,
 coalesce(html, '') AS base_text, CASE WHEN page_id % 2 = 0 THEN '<p>' WHEN page_id % 29 = 3 THEN '' ELSE '<body>' END AS part, CASE WHEN page_id % 31 = 0 THEN NULL ELSE html END AS answer,
 CASE WHEN page_id % 8 = 5 THEN 'tests/hero.gd' ELSE 'tests/test_hero.gd' END AS test_path, CASE WHEN page_id % 9 = 4 THEN 'extends Node' ELSE 'extends GdUnitTestSuite' END AS test_text, page_id % 37 = 6 AS odd FROM {pages}
""")  # fmt: skip


@query("proposals", "pages", sql=rf"""WITH s AS (SELECT DISTINCT split_part(split_part(url, '/', 3), '.', 1) AS skill FROM {{pages}} WHERE length(url) % 3 = 0), p AS (SELECT p.*, s.skill AS found, CASE WHEN part = '' THEN 0 ELSE len(string_split(base_text, part)) - 1 END AS n FROM {{proposals}} p LEFT JOIN s USING (skill))
SELECT id, concat_ws(', ', CASE WHEN format <> '{VERSION}' THEN 'format' END, CASE WHEN found IS NULL THEN 'skill' END, CASE WHEN length(trim(coalesce(instruction, ''))) < 20 THEN 'instruction' END,
 CASE WHEN NOT coalesce(path <> '' AND NOT contains(path, chr(92)) AND NOT contains(path, ':') AND NOT starts_with(path, '/') AND NOT list_contains(string_split(path, '/'), '..') AND regexp_matches(path, '[^/]\.(gd|tscn|tres|json|txt|cfg|md)\z'), false) THEN 'path' END,
 CASE WHEN n <> 1 THEN 'before found ' || n || ' times' END, CASE WHEN coalesce(answer, '') = '' THEN 'answer' END, CASE WHEN test_path <> 'tests/test_hero.gd' THEN 'test name' END, CASE WHEN test_text = 'extends Node' THEN 'test class' END,
 CASE WHEN starts_with(path, 'tests_juge/') THEN 'reserved folder' END, CASE WHEN odd THEN 'steps' END) AS errors FROM p""")
def proposal_validation(proposals, pages):
    steps = F.when(F.col("odd"), F.array(F.lit("import"), F.lit("deploy"))).otherwise(F.array(F.lit("import"), F.lit("run_tests")))
    skills = pages.filter("length(url) % 3 = 0").select(F.expr("split_part(split_part(url, '/', 3), '.', 1)").alias("skill"))
    checked = a.proposal_validation(proposals.withColumnRenamed("part", "before").withColumn("steps", steps), skills, VERSION)
    return checked.select("id", F.array_join("errors", ", ").alias("errors"))


view("base_files", "SELECT CAST(floor(page_id / 6) AS bigint) AS id, 'f' || CAST(page_id % 6 AS varchar(9)) AS path, coalesce(html, '') AS text FROM {pages}")
# step by step: a tag that stands once, what the first step wrote, a tag that stands often, a file that isn't there
view("base_changes", """
SELECT id, 10 AS k, path, '<body>' AS before, '<main>' AS after FROM {base_files} UNION ALL SELECT id, 20, path, '<main>', '<nav>' FROM {base_files} UNION ALL SELECT id, 30, path, '<p>', '<q>' FROM {base_files}
UNION ALL SELECT id, 40, path || 'x', '<p>', '' FROM {base_files} WHERE path = 'f1' UNION ALL SELECT id, 50, path, '', 'y' FROM {base_files} WHERE path = 'f2'
""")  # fmt: skip
view("base_removals", "SELECT id, 0 AS k, path FROM {base_files} WHERE path IN ('f3', 'f5') UNION ALL SELECT id, 1, 'f3' FROM {base_files} WHERE path = 'f4' UNION ALL SELECT id, 2, 'zz' FROM {base_files} WHERE path = 'f0'")
view("base_additions", "SELECT id, path, 'new ' || CAST(length(text) AS varchar(20)) AS text FROM {base_files} WHERE path IN ('f5', 'f0')")
FOUND = "(len(string_split({t}, '{b}')) - 1)"
STEPS_MADE = f"""a AS (SELECT *, {FOUND.format(t="text", b="<body>")} AS n1, CASE WHEN n1 = 1 THEN replace(text, '<body>', '<main>') ELSE text END AS t1, {FOUND.format(t="t1", b="<main>")} AS n2, CASE WHEN n2 = 1 THEN replace(t1, '<main>', '<nav>') ELSE t1 END AS t2,
 {FOUND.format(t="t2", b="<p>")} AS n3, CASE WHEN n3 = 1 THEN replace(t2, '<p>', '<q>') ELSE t2 END AS t3 FROM {{base_files}})"""


@query("base_files", "base_changes", "base_removals", "base_additions", sql=f"""WITH {STEPS_MADE} SELECT id, path, sha256(t3) AS hash FROM a WHERE path IN ('f1', 'f2', 'f4') UNION ALL SELECT id, path, sha256(text) FROM {{base_additions}}""")
def proposal_start(files, changes, removals, additions):
    return a.start_files(files, changes, removals, additions)[0].select("id", "path", F.sha2(F.col("text").cast("binary"), 256).alias("hash"))


@query("base_files", "base_changes", "base_removals", "base_additions", sql=f"""WITH {STEPS_MADE}, e AS (SELECT id, 'replacement' AS part, unnest([10, 20, 30])::BIGINT AS k, unnest([n1, n2, n3]) AS n FROM a)
SELECT id, part, k, 'before found ' || n || ' times' AS error FROM e WHERE n <> 1 UNION ALL SELECT id, 'replacement', unnest([40]), 'unknown file or no text' FROM a WHERE path = 'f1' UNION ALL SELECT id, 'replacement', 50, 'unknown file or no text' FROM a WHERE path = 'f2'
UNION ALL SELECT id, 'removal', 1, 'not there' FROM a WHERE path = 'f4' UNION ALL SELECT id, 'removal', 2, 'not there' FROM a WHERE path = 'f0'""")
def proposal_changes(files, changes, removals, additions):
    """Errors of changes; a removal of f3 in a last project without f3 is one more, as its file isn't there."""
    return a.start_files(files, changes, removals, additions)[1]


WORD = r"(?:^|[^A-Za-z])(?:the|de|la|der|el) ([A-Za-z]+)"
LOCAL = r"(?:^|\n)([A-Z][a-z]+)"


@query("documents", "part", sql=rf"""WITH RECURSIVE l AS (SELECT doc_id AS id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line, unnest(string_split(text, chr(10))) AS t FROM {{documents}}),
u AS (SELECT id, line, unnest(regexp_extract_all(t, '{WORD}', 1)) AS name FROM l), f AS (SELECT id, name, min(line)::INT AS line FROM u WHERE regexp_matches(name, '^[A-Z]') GROUP BY ALL),
d AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(text, '{LOCAL}', 1)) AS name FROM {{documents}}), k AS (SELECT DISTINCT upper(substring(p_name, 1, 1)) || substring(split_part(p_name, ' ', 1), 2) AS name FROM {{part}}),
o AS (SELECT f.id, f.line, f.name FROM f ANTI JOIN k ON f.name = k.name ANTI JOIN d ON f.id = d.id AND f.name = d.name), pairs AS (SELECT DISTINCT o.name AS query, k.name AS id FROM o, k), {ratios("pairs")},
n AS (SELECT query, string_agg(id, '; ' ORDER BY score DESC, id DESC) AS near FROM (SELECT * FROM ratios WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, id DESC) <= 3) GROUP BY query)
SELECT o.id, o.line, o.name, n.near FROM o LEFT JOIN n ON n.query = o.name""")
def unknown_types(documents, part):
    """Capitalised words after an article stand for type names; words that begin a line are the document's own declarations."""
    known = part.select(F.initcap(F.split("p_name", " ")[0]).alias("name"))
    return a.with_near_types(a.unknown_types(documents.select(F.col("doc_id").alias("id"), "text"), known, WORD, LOCAL), known)


GRID = {"speed": (100.0, 320.0, 10.0, 1), "duration": (0.05, 0.4, 0.05, 2)}
PLACES = {n: round((hi - lo) / step) + 1 for n, (lo, hi, step, _) in GRID.items()}
AT = lambda n: f"(('0x' || substring(sha256('{n}:' || o_orderkey), 1, 8))::BIGINT % {PLACES[n]})"
POINTS = f"p AS (SELECT min(o_orderkey) AS key, speed, duration FROM (SELECT o_orderkey, round(100.0 + 10.0 * {AT('speed')}, 1)::DOUBLE AS speed, round(0.05 + 0.05 * {AT('duration')}, 2)::DOUBLE AS duration FROM {{orders}}) GROUP BY speed, duration)"


@query("orders", sql=f"WITH {POINTS}, m AS (SELECT min(key) AS key, round(speed * duration, 0)::BIGINT AS reach FROM p GROUP BY 2) SELECT key, reach FROM m WHERE reach <> 20")
def parameter_grid_draw(orders):
    """Points drawn by order keys; of those with one effect (reach) the first stays, none with the start's."""
    points = a.parameter_grid_draw(orders.select(F.col("o_orderkey").alias("key")), GRID)
    measured = points.withColumn("reach", F.round(F.col("speed") * F.col("duration"), 0).cast("long"))
    start = orders.sparkSession.createDataFrame([(20,)], "reach bigint")
    return a.changed_draws(measured.select("key", "reach"), start, ["reach"])


@query("documents", sql="""WITH o AS (SELECT source AS grp, doc_id // 3 AS place, doc_id AS id, n_chars::BIGINT AS size, sha256(doc_id::VARCHAR) AS k FROM {documents}), x AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY grp, place ORDER BY k) = 1),
s AS (SELECT *, row_number() OVER w AS n, sum(size) OVER (PARTITION BY grp ORDER BY k ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM x WINDOW w AS (PARTITION BY grp ORDER BY k)), t AS (SELECT source AS grp, sum(n_chars) // 4 AS target FROM {documents} GROUP BY 1),
g AS (SELECT s.*, n = 1 OR total - size + CASE WHEN n > 2 THEN (total - size - first_value(size) OVER (PARTITION BY grp ORDER BY n)) / (n - 2) ELSE 1500.0 END / 2 < target AS goes FROM s JOIN t USING (grp))
SELECT grp, id, total FROM g WHERE n <= 90 AND n < coalesce((SELECT min(x.n) FROM g x WHERE x.grp = g.grp AND NOT x.goes), 1e9)""")
def balanced_until_budget(documents):
    """Documents of a source, one of three neighbours at most, until a quarter of the source's characters is reached."""
    examples = documents.select(F.col("source").alias("grp"), F.expr("doc_id div 3").alias("place"), F.col("doc_id").alias("id"), F.col("n_chars").cast("long").alias("size"))
    targets = documents.groupBy(F.col("source").alias("grp")).agg(F.expr("sum(n_chars) div 4").alias("target"))
    return a.balanced_until_budget(examples, targets)


@query("events", sql="""SELECT user_id AS report, CASE WHEN user_id % 3 = 2 THEN count(*) ELSE count(*) FILTER (event_type <> 'view' AND value > 40) END::BIGINT AS k, CASE WHEN user_id % 3 = 2 THEN count(*) + 1 ELSE count(*) FILTER (event_type <> 'view') END::BIGINT AS n FROM {events} GROUP BY user_id""")
def benchmark_score_file(events):
    """A report of JSON a user: two in three list their tasks, under either name, the others have totals only."""
    task = F.to_json(F.struct((F.col("value") > 40).alias("success"), (F.col("event_type") == "view").alias("skipped")))
    listed = F.concat(F.lit('": ['), F.array_join(F.collect_list(task), ", "), F.lit("]}"))
    totals = F.format_string('{"success": %d, "tasks_attempted": %d}', F.count(F.lit(1)), F.count(F.lit(1)) + 1)
    text = F.when(F.col("user_id") % 3 == 2, totals).otherwise(F.concat(F.lit('{"'), F.when(F.col("user_id") % 3 == 0, "tasks").otherwise("results"), listed))
    return a.benchmark_score(events.groupBy("user_id").agg(text.alias("text")).select(F.col("user_id").alias("report"), "text"))
