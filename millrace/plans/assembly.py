"""Queries of error hints, prompt contexts, notes and hunks, drawn faults, and of the sources that read files."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import assembly as a
from millrace.plans import registry
from millrace.plans.names import ratios
from millrace.plans.registry import query, view
from millrace.plans.vocabulary import CHAIN
from millrace.sources import folders

view("named_parents", "SELECT 'c' || CAST(child AS varchar(20)) AS child, 'c' || CAST(parent AS varchar(20)) AS parent FROM {parents}")
view("named_members", "SELECT 'c' || CAST(class AS varchar(20)) AS class, member, kind FROM {members}")
view("engine_errors", """
SELECT CAST(floor(o_orderkey / 20) AS bigint) AS verdict, o_orderkey AS pos, 'c' || CAST(o_custkey AS varchar(20)) AS own, CASE o_orderkey % 5
 WHEN 0 THEN 'Parse error: Function "m' || CAST(o_custkey % 90 AS varchar(9)) || '()" not found in base self.'
 WHEN 1 THEN 'Cannot find property "m' || CAST(o_custkey % 90 AS varchar(9)) || '" on base "c' || CAST(o_custkey % 70 AS varchar(20)) || '".'
 WHEN 2 THEN 'Nonexistent function ''m' || CAST(o_custkey % 90 AS varchar(9)) || ''' in base ''c' || CAST(o_custkey % 70 AS varchar(20)) || '''.'
 WHEN 3 THEN 'Identifier "m' || CAST(o_custkey % 90 AS varchar(9)) || 'x" not declared in the current scope.' ELSE o_orderpriority END AS message FROM {orders}
""", """
SELECT floor(o_orderkey / 20)::BIGINT AS verdict, o_orderkey AS pos, 'c' || CASE WHEN o_orderkey % 5 IN (1, 2) THEN o_custkey % 70 ELSE o_custkey END AS class, 'm' || (o_custkey % 90) || CASE o_orderkey % 5 WHEN 3 THEN 'x' ELSE '' END AS member FROM {orders} WHERE o_orderkey % 5 < 4
""")  # fmt: skip
view("member_docs", "SELECT 'c' || CAST(doc_id % 70 AS varchar(20)) || '.m' || CAST(doc_id % 40 AS varchar(9)) AS name, min(text) AS text FROM {documents} GROUP BY 1")


@query("engine_errors", "named_parents", "named_members", "member_docs", sql=f"""WITH RECURSIVE {CHAIN.replace("{parents}", "{named_parents}")}, i AS (SELECT c.child AS class, m.member, m.kind, arg_min(m.class, (c.depth, m.class)) AS origin FROM chain c JOIN {{named_members}} m ON m.class = c.ancestor WHERE c.child IN (SELECT class FROM {{engine_errors}}) GROUP BY ALL),
o AS (SELECT verdict, class, member, min(pos) AS pos FROM {{engine_errors}} WHERE class IN (SELECT child FROM {{named_parents}}) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY verdict ORDER BY pos, class, member)::INT AS place FROM o QUALIFY place <= 3),
k AS (SELECT class, member, min(kind) AS kind, arg_min(origin, (kind, origin)) AS origin FROM i GROUP BY ALL), p AS (SELECT DISTINCT class, member FROM r ANTI JOIN k USING (class, member)),
c AS (SELECT DISTINCT p.class, p.member AS query, i.member AS id FROM p JOIN i ON i.class = p.class), {ratios("c")}, s AS (SELECT class, query AS member, id, score FROM c JOIN ratios USING (query, id)),
n AS (SELECT class, member, string_agg(id, '; ' ORDER BY score DESC, id DESC) AS near FROM (SELECT * FROM s WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY class, member ORDER BY score DESC, id DESC) <= 3) GROUP BY ALL)
SELECT verdict, place, r.class, r.member, kind, origin, near, substring(d.text, 1, 600) AS excerpt FROM r LEFT JOIN k USING (class, member) LEFT JOIN n USING (class, member) LEFT JOIN {{member_docs}} d ON d.name = origin || '.' || r.member""")
def explain_errors(errors, parents, members, docs):
    return a.explain_errors(errors, parents, members, docs)


view("page_tasks", """
SELECT page_id AS id, CAST(floor(page_id / 8) AS bigint) AS project, CASE WHEN page_id % 3 = 0 THEN 'D1' ELSE 'K1' END AS skill,
 'Read res://src/p' || CAST(page_id AS varchar(20)) || '.gd. Then res://p' || CAST(page_id + 1 AS varchar(20)) || '.json and res://src/p' || CAST(page_id AS varchar(20)) || '.gd; ' || url AS instruction FROM {pages}
""")
view("page_files", """
SELECT CAST(floor(page_id / 8) AS bigint) AS project, CASE WHEN page_id % 8 = 7 THEN 'journal.txt' WHEN page_id % 8 = 6 THEN 'addons/a' || CAST(page_id AS varchar(20)) || '.gd' WHEN page_id % 2 = 0 THEN 'src/p' || CAST(page_id AS varchar(20)) || '.gd' ELSE 'p' || CAST(page_id AS varchar(20)) || '.json' END AS path,
 CASE WHEN page_id % 8 = 7 THEN 'error in res://p' || CAST(page_id - 2 AS varchar(20)) || '.json..' ELSE '' END || coalesce(html, '') AS text FROM {pages}
""")  # fmt: skip


@query("page_tasks", "page_files", sql=r"""WITH l AS (SELECT project, string_agg('res://' || path, chr(10) ORDER BY string_split(path, '/')) AS list FROM {page_files} WHERE NOT starts_with(path, 'addons/') GROUP BY project),
t AS (SELECT t.*, substring(j.text, 1, 12000) AS log FROM {page_tasks} t LEFT JOIN {page_files} j ON j.project = t.project AND j.path = 'journal.txt' AND t.skill = 'D1'),
c AS (SELECT id, project, unnest(range(len(x))) AS pos, unnest(x) AS raw FROM (SELECT id, project, regexp_extract_all(concat_ws(chr(10), instruction, log), 'res://[A-Za-z0-9_./-]+') AS x FROM t)),
u AS (SELECT id, project, rtrim(raw, '.') AS name, min(pos) AS pos FROM c GROUP BY ALL), b AS (SELECT u.id, u.pos, u.name, substring(f.text, 1, 12000) AS body FROM u JOIN {page_files} f ON f.project = u.project AND f.path = substring(u.name, 7) WHERE regexp_matches(u.name, '\.(gd|json)$')),
n AS (SELECT id, pos, name, CASE WHEN ends_with(name, '.gd') THEN list_aggregate(list_transform(string_split(body, chr(10)), lambda x, i: lpad(i::VARCHAR, greatest(4, length(i::VARCHAR))::INT, ' ') || '| ' || x), 'string_agg', chr(10)) ELSE body END AS body FROM b),
g AS (SELECT id, string_agg('=== ' || name || ' ===' || chr(10) || body, chr(10) || chr(10) ORDER BY pos) AS blocks FROM n GROUP BY id),
w AS (SELECT t.id, concat_ws(chr(10) || chr(10), 'Fichiers du projet :' || chr(10) || coalesce(list, ''), '=== journal.txt ===' || chr(10) || log, blocks) AS context FROM t LEFT JOIN l USING (project) LEFT JOIN g USING (id))
SELECT id, sha256(CASE WHEN length(context) > 40000 THEN substring(context, 1, 40000) || chr(10) || '[…contexte tronqué]' ELSE context END) AS hash FROM w""")
def prompt_context(tasks, files):
    return a.prompt_context(tasks, files).select("id", F.sha2(F.col("context").cast("binary"), 256).alias("hash"))


view("note_points", """
SELECT CAST(floor(doc_id / 10) AS bigint) AS note, doc_id % 10 AS point, CASE WHEN doc_id % 10 = 0 THEN 'the test of f' || CAST(doc_id % 7 AS varchar(9)) || '.gd' WHEN doc_id % 10 = 1 THEN 'all tests' WHEN doc_id % 20 = 2 THEN 'see src/f' || CAST(doc_id % 3 AS varchar(9)) || '.gd' ELSE source END AS title,
 coalesce(text, '') || ' f1.gd' AS text FROM {documents} WHERE doc_id % 10 < 4
""")  # fmt: skip
view("note_hunks", """
SELECT CAST(floor(doc_id / 10) AS bigint) AS note, doc_id AS hunk, 'src/' || CASE WHEN doc_id % 5 = 0 THEN 'test_' ELSE '' END || 'f' || CAST(doc_id % 3 AS varchar(9)) || '.gd' AS file, doc_id * doc_id AS at, coalesce(text, '') AS text FROM {documents} WHERE doc_id % 10 >= 4
""")
WORDS = r"[A-Z][a-z]{5,}"
SHARED = rf"list_distinct(list_filter(string_split(text, chr(10)), lambda x: length(x) > 6)) AS lines, list_distinct(regexp_extract_all(text, '{WORDS}')) AS names"


@query("note_points", "note_hunks", sql=rf"""WITH p AS (SELECT *, {SHARED} FROM {{note_points}}), h AS (SELECT *, string_split(file, '/')[-1] AS base, {SHARED} FROM {{note_hunks}}), t AS (SELECT note, count(*) AS n, max(point) AS last FROM p GROUP BY note),
w AS (SELECT note, name, ln(1 + n / f) AS w FROM (SELECT note, name, count(*) AS f FROM (SELECT note, unnest(names) AS name FROM p) GROUP BY ALL) JOIN t USING (note)),
nm AS (SELECT note, hunk, point, sum(w) AS s FROM (SELECT h.note, h.hunk, p.point, unnest(list_intersect(h.names, p.names)) AS name FROM h JOIN p USING (note)) JOIN w USING (note, name) GROUP BY ALL),
s AS (SELECT h.note, h.hunk, p.point, round(10 * len(list_intersect(h.lines, p.lines)) + coalesce(nm.s, 0) + CASE WHEN list_contains(regexp_extract_all(p.title, '[A-Za-z0-9_-]+\.[a-z]+'), h.base) THEN 10 WHEN list_contains(regexp_extract_all(p.text, '[A-Za-z0-9_-]+\.[a-z]+'), h.base) THEN 2 ELSE 0 END
 + CASE WHEN contains(h.base, 'test') AND contains(lower(p.title), 'test') THEN 5 ELSE 0 END, 6) AS s FROM h JOIN p USING (note) LEFT JOIN nm ON nm.note = h.note AND nm.hunk = h.hunk AND nm.point = p.point),
b AS (SELECT note, hunk, arg_min(point, (-s, point)) AS point FROM s WHERE s > 0.5 GROUP BY ALL), r AS (SELECT h.note, h.hunk, h.file, h.at, b.point, t.last FROM h JOIN t USING (note) LEFT JOIN b ON b.note = h.note AND b.hunk = h.hunk)
SELECT note, hunk, coalesce(point, (SELECT arg_min(v.point, (abs(v.at - r.at), v.at)) FROM r v WHERE v.note = r.note AND v.file = r.file AND v.point IS NOT NULL), last) AS point FROM r""")
def attach_hunks_to_notes(points, hunks):
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(x) > 6).alias("lines")
    names = F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)).alias("names")
    return a.attach_hunks(points.select("*", lines, names), hunks.select("*", lines, names))


FAULT_ROWS = "SELECT l_orderkey AS {}, l_linenumber AS id, 'f' || CAST(l_suppkey % 2 AS varchar(9)) || CASE WHEN l_linenumber % 3 = 0 THEN '.gdshader' ELSE '.gd' END AS file, l_partkey % 50 AS line, l_returnflag || l_linestatus AS kind FROM {{lineitem}}"
view("line_faults", FAULT_ROWS.format("`group`"), FAULT_ROWS.format('"group"'))
HASH = "md5(concat_ws('|', '7', {}))"
DIGIT = "(instr('0123456789abcdef', substring(md5(concat_ws('|', '7', '{}', \"group\")), 1, 1)) - 1) % 4"


@query("line_faults", sql=f"""WITH f AS (SELECT *, ends_with(file, '.gd') AS s FROM {{line_faults}}), e AS (SELECT "group", file, s FROM f GROUP BY ALL HAVING NOT s OR count(DISTINCT line) >= 2), c AS (SELECT "group", s, arg_min(file, ({HASH.format('"group", file')}, file)) AS file FROM e GROUP BY ALL),
m AS (SELECT f.* FROM f JOIN c ON c."group" = f."group" AND c.file = f.file WHERE f."group" IN (SELECT "group" FROM c WHERE s)), o AS (SELECT *, {HASH.format('"group", file, line, id')} AS h FROM m QUALIFY row_number() OVER (PARTITION BY "group", file, line ORDER BY h, id, kind) = 1),
t AS (SELECT *, CASE WHEN s THEN row_number() OVER (PARTITION BY "group", s, kind ORDER BY h, id) ELSE 1 END AS turn FROM o), k AS (SELECT * FROM t WHERE NOT s OR kind <> 'NO' OR turn = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY "group", s ORDER BY turn, CASE WHEN s THEN {HASH.format('"group", kind')} ELSE h END, h, id) AS place FROM k)
SELECT "group", id FROM p WHERE place <= CASE WHEN s THEN [2, 3, 3, 4][1 + {DIGIT.format("script")}] ELSE [0, 1, 1, 2][1 + {DIGIT.format("other")}] END""")
def mixed_draw(faults):
    return a.mixed_draw(faults, "7", "NO")


def _tasks(spark, sf_dir):
    """Every benchmark item as a task document in its own folder, read back; one in four lacks its origin."""
    root = folders.scratch(spark)
    items = registry.read(spark, sf_dir, "benchmark")
    docs = items.select(F.col("item_id").alias("folder"), F.concat(F.lit("t"), "item_id").alias("id"), F.lit("K1").alias("competence"), F.col("text").alias("consigne"), F.when(F.col("item_id") % 4 != 0, "given").alias("origine"), F.sha2(F.col("text").cast("binary"), 256).alias("empreinte"))
    docs.repartition("folder").write.partitionBy("folder").json(root)
    return folders.read_tasks(spark, root).select(F.split("folder", "=")[1].cast("bigint").alias("item"), "id", "empreinte", "missing")


registry.QUERIES["read_tasks"] = _tasks
registry.ORACLES["read_tasks"] = "SELECT item_id AS item, 't' || item_id AS id, sha256(text) AS empreinte, CASE WHEN text IS NULL THEN 'consigne,' ELSE '' END || CASE WHEN item_id % 4 = 0 THEN 'origine' ELSE '' END AS missing FROM benchmark"


def _tree(spark, sf_dir):
    """Every benchmark item as a text file of a tree, and again below an ignored folder; the first are read back."""
    root = folders.scratch(spark)
    items = registry.read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), F.coalesce("text", F.lit("")).alias("value")).repartition("item")
    items.write.partitionBy("item").text(f"{root}/tree")
    items.write.partitionBy("item").text(f"{root}/tree/reports")
    files = folders.read_file_tree(spark, f"{root}/tree")
    return files.select(F.regexp_extract("path", r"^item=(\d+)/", 1).cast("bigint").alias("item"), F.sha2(F.regexp_replace("text", r"\n\z", "").cast("binary"), 256).alias("hash"))


registry.QUERIES["read_file_tree"] = _tree
registry.ORACLES["read_file_tree"] = "SELECT item_id AS item, sha256(coalesce(text, '')) AS hash FROM benchmark"


def _session_files(spark, sf_dir):
    """Every conversation as a session file with a header line, read back."""
    root = folders.scratch(spark)
    m = registry.read(spark, sf_dir, "messages")
    folders.write_sessions(m, m.select("session").distinct(), f"{root}/rows")
    spark.read.parquet(f"{root}/rows").repartition("session").write.partitionBy("session").text(f"{root}/files")
    return folders.read_sessions(spark, f"{root}/files").select(F.col("session").cast("bigint").alias("session"), "pos", "role", F.sha2(F.col("content").cast("binary"), 256).alias("hash"))


registry.QUERIES["read_sessions"] = _session_files
registry.ORACLES["read_sessions"] = registry.ORACLES["write_sessions"]


def _junit(spark, sf_dir):
    """Every event as a case of an XML test report, read back."""
    root = folders.scratch(spark)
    events = registry.read(spark, sf_dir, "events")
    v = F.col("value")
    cases = events.select(F.col("event_type").alias("_classname"), F.col("event_id").alias("_name"), F.when(v > 90, "expected less").alias("failure"), F.when(v < 5, "too small").alias("error"), F.when((v >= 5) & (v < 10), "later").alias("skipped"))
    cases.write.format("xml").option("rootTag", "testsuite").option("rowTag", "testcase").save(root)
    return folders.read_junit(spark, root).select("name", "outcome")


registry.QUERIES["read_junit"] = _junit
registry.ORACLES["read_junit"] = "SELECT event_type || ':' || event_id AS name, CASE WHEN value > 90 THEN 'failure' WHEN value < 5 THEN 'error' WHEN value < 10 THEN 'skipped' ELSE 'ok' END AS outcome FROM events"
