"""Queries over texts, duplicates, protected sets and frozen samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import corpus, rounds
from millrace.plans.registry import query, view

view("texts", "SELECT doc_id AS id, lang AS grp, source, text FROM {documents}")
view("frozen_texts", "SELECT doc_id AS id, lang AS grp, text, CAST(doc_id / 20 AS bigint) AS position FROM {documents} WHERE doc_id % 20 = 0")
view("protected", """
SELECT CAST(item_id AS varchar(20)) AS item, item_id AS position, 'answer' AS side, text FROM {benchmark}
UNION ALL SELECT CAST(item_id AS varchar(20)), item_id, 'instruction', 'Write this: ' || text FROM {benchmark}
""")
view("tasks", "SELECT doc_id AS id, lang AS skill, source FROM {documents}")
view("layers", """
SELECT CAST(floor(doc_id / 40) AS bigint) AS project, 'f' || CAST(doc_id % 40 AS varchar(20)) AS path, 0 AS layer, text FROM {documents}
UNION ALL SELECT CAST(floor(doc_id / 40) AS bigint), 'f' || CAST(doc_id % 40 AS varchar(20)), 1, text || '!' FROM {documents} WHERE doc_id % 3 = 0
""")

TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[a-zà-ÿ_][a-zà-ÿ0-9_]*|[0-9]+(?:\.[0-9]+)?|[^\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}a-zà-ÿ0-9_]')"
SET = "list_distinct(list_transform(range(1, greatest(len(t) - 5, 1) + 1), lambda i: substring(sha256(array_to_string(t[i:i + 5], ' ')), 1, 16)))"


def shingled(name: str, source: str, columns: str) -> str:
    return f"{name} AS (SELECT {columns}, len(s)::BIGINT AS size, unnest(s) AS shingle FROM (SELECT {columns}, {SET} AS s FROM (SELECT {columns}, {TOKENS} AS t FROM {source}) WHERE len(t) > 0))"


@query("texts", sql=f"SELECT id, len(t)::BIGINT AS n, sha256(array_to_string(t, ' ')) AS tokens FROM (SELECT id, {TOKENS} AS t FROM {{texts}})")
def tokenize(texts):
    return texts.select("id", corpus.tokens("text").alias("t")).select("id", F.size("t").cast("long").alias("n"), F.sha2(F.array_join("t", " ").cast("binary"), 256).alias("tokens"))


@query("texts", sql=f"WITH {shingled('s', '{texts}', 'id')} SELECT t.id, count(s.shingle)::BIGINT AS n, coalesce(min(shingle), '') AS least, coalesce(max(shingle), '') AS most FROM {{texts}} t LEFT JOIN s USING (id) GROUP BY t.id")
def shingles(texts):
    s = texts.select("id", corpus.shingles("text").alias("s"))
    return s.select("id", F.size("s").cast("long").alias("n"), F.coalesce(F.array_min("s"), F.lit("")).alias("least"), F.coalesce(F.array_max("s"), F.lit("")).alias("most"))


@query("texts", sql="SELECT id, first_value(id) OVER w AS kept, id = first_value(id) OVER w AS accepted FROM {texts} WINDOW w AS (PARTITION BY sha256(text) ORDER BY grp, id)")
def first_hash_wins(texts):
    return corpus.first_hash_wins(texts, "id", ["grp"]).select("id", "kept", "accepted")


@query("texts", sql="SELECT sha256(text) AS hash, count(*)::BIGINT AS copies, min(id) AS first FROM {texts} GROUP BY 1 HAVING count(*) > 1")
def duplicate_examples(texts):
    return texts.groupBy(corpus.fingerprint("text").alias("hash")).agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first")).filter("copies > 1")


@query("texts", "frozen_texts", sql="SELECT id, sha256(text) AS hash FROM {texts} WHERE id NOT IN (SELECT id FROM {frozen_texts}) AND sha256(text) NOT IN (SELECT sha256(text) FROM {frozen_texts})")
def exclude_frozen_sessions(texts, frozen):
    rows = texts.select("id", corpus.fingerprint("text").alias("hash"))
    return corpus.exclude(rows, frozen.select("id", corpus.fingerprint("text").alias("hash"))).select("id", "hash")


NEAR = f"""WITH same AS (SELECT t.id, (SELECT f.id FROM {{frozen_texts}} f WHERE f.text = t.text ORDER BY position DESC LIMIT 1) AS match FROM {{texts}} t WHERE t.id % 20 <> 0),
{shingled("a", "{texts} WHERE id % 20 <> 0 AND id NOT IN (SELECT id FROM same WHERE match IS NOT NULL)", "id, grp")}, {shingled("b", "{frozen_texts}", "id, grp, position")},
pairs AS (SELECT a.id, b.id AS match, b.position, a.size AS n, b.size AS m, count(*) AS i FROM a JOIN b ON a.grp = b.grp AND a.shingle = b.shingle GROUP BY ALL),
found AS (SELECT id, match, 'same_hash' AS reason FROM same WHERE match IS NOT NULL UNION ALL SELECT id, arg_min(match, position), 'shingles' FROM pairs WHERE i >= 0.8 * (n + m - i) GROUP BY id)"""


@query("texts", "frozen_texts", sql=f"{NEAR} SELECT * FROM found")
def near_dup_against_index(texts, frozen):
    return corpus.near_index(texts.filter("id % 20 <> 0"), frozen)


@query("texts", "frozen_texts", sql=f"{NEAR} SELECT t.id, t.grp, coalesce(f.reason, 'kept') AS status FROM {{texts}} t LEFT JOIN found f USING (id) WHERE t.id % 20 <> 0 AND t.source <> 'src1'")
def evict_unprotected_duplicates(texts, frozen):
    """Rows that double a frozen one are listed with their reason, the others stay; rows of one trusted source aren't judged."""
    judged = texts.filter("id % 20 <> 0 AND source <> 'src1'")
    found = corpus.near_index(judged, frozen).select("id", "reason")
    return judged.join(found, "id", "left").select("id", "grp", F.coalesce("reason", F.lit("kept")).alias("status"))


HITS = f"""WITH {shingled("p", "{protected}", "item, position, side")}, {shingled("d", "{texts}", "id")},
hit AS (SELECT d.id, p.item, p.position, p.side, p.size, count(*) AS n FROM d JOIN p USING (shingle) WHERE p.size >= 4 GROUP BY ALL),
found AS (SELECT id, arg_min(item, position) AS item FROM hit WHERE n >= 0.6 * size GROUP BY id)"""


@query("texts", "protected", sql=f"{HITS} SELECT id, item FROM found")
def decontaminate_text(texts, protected):
    return corpus.protected_hits(texts, protected)


@query("texts", "protected", sql=f"{HITS} SELECT grp, count(*)::BIGINT AS scanned, count(found.id)::BIGINT AS leaks, coalesce(min(found.item::BIGINT), -1) AS first FROM {{texts}} t LEFT JOIN found USING (id) GROUP BY grp")
def leak_audit(texts, protected):
    """Rescan of the stored corpus: leaks of each group."""
    found = corpus.protected_hits(texts, protected)
    joined = texts.select("id", "grp").join(found, "id", "left")
    return joined.groupBy("grp").agg(F.count(F.lit(1)).alias("scanned"), F.count("item").alias("leaks"), F.coalesce(F.min(F.col("item").cast("long")), F.lit(-1)).alias("first"))


REASON = f"""{HITS} SELECT coalesce(reason, 'exported') AS reason, count(*)::BIGINT AS n FROM (SELECT CASE WHEN t.id IN (SELECT id FROM {{frozen_texts}}) OR sha256(t.text) IN (SELECT sha256(text) FROM {{frozen_texts}}) THEN 'frozen task'
WHEN found.id IS NOT NULL THEN 'repeats protected text' WHEN length(t.text) < 30 THEN 'bad format' END AS reason FROM {{texts}} t LEFT JOIN found USING (id)) GROUP BY 1"""


@query("texts", "frozen_texts", "protected", sql=REASON)
def export_summary(texts, frozen, protected):
    """Why rows aren't exported; a frozen task comes before repeated text, that before bad format."""
    hashed = texts.select("id", corpus.fingerprint("text").alias("hash"), F.length("text").alias("n"))
    ids = frozen.select("id", F.lit(True).alias("frozen_id"))
    hashes = frozen.select(corpus.fingerprint("text").alias("hash"), F.lit(True).alias("frozen_hash")).distinct()
    joined = hashed.join(ids, "id", "left").join(hashes, "hash", "left").join(corpus.protected_hits(texts, protected), "id", "left")
    reason = F.when(F.col("frozen_id") | F.col("frozen_hash"), "frozen task").when(F.col("item").isNotNull(), "repeats protected text").when(F.col("n") < 30, "bad format").otherwise("exported")
    return joined.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


DRAW = "sha256('7:' || skill || ':' || id::VARCHAR)"


@query("tasks", sql=f"WITH r AS (SELECT skill, id, row_number() OVER (PARTITION BY skill ORDER BY {DRAW}) AS r, count(*) OVER (PARTITION BY skill) AS n FROM {{tasks}}) SELECT skill, id FROM r WHERE r <= least(50, floor(0.25 * n))")
def freeze_sample(tasks):
    return corpus.freeze_sample(tasks, "7", 50, 0.25).select("skill", "id")


@query("tasks", sql=f"""WITH old AS (SELECT skill, id FROM {{tasks}} WHERE id % 97 = 0), c AS (SELECT skill, count(*) AS n FROM {{tasks}} GROUP BY skill), o AS (SELECT skill, count(*) AS k FROM old GROUP BY skill),
r AS (SELECT skill, id, row_number() OVER (PARTITION BY skill ORDER BY {DRAW}) AS r FROM {{tasks}} WHERE id NOT IN (SELECT id FROM old)),
f AS (SELECT skill, id FROM old UNION ALL SELECT r.skill, id FROM r JOIN c USING (skill) LEFT JOIN o USING (skill) WHERE r.r <= least(50, floor(0.25 * n)) - coalesce(k, 0))
SELECT c.skill, c.n::BIGINT AS available, count(f.id)::BIGINT AS frozen, count(f.id) >= 50 AS complete FROM c LEFT JOIN f USING (skill) GROUP BY c.skill, c.n""")
def freeze_manifest(tasks):
    return corpus.freeze_manifest(tasks, "7", 50, 0.25, tasks.filter("id % 97 = 0"))[1]


@query("part", sql="SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY sha256('s:' || p_partkey::VARCHAR)) AS r FROM {part}) WHERE r <= 7")
def capped_sample(part):
    drawn = part.select("p_brand", "p_partkey", corpus.draw_order("s", "p_partkey").alias("draw"))
    return rounds.first_n(drawn, "p_brand", ["draw"], 7).select("p_brand", "p_partkey")


@query("lineitem", sql="SELECT l_orderkey, arg_min(l_partkey, sha256(concat_ws(':', 's', l_orderkey, l_linenumber, l_partkey, l_suppkey))) AS l_partkey FROM {lineitem} GROUP BY l_orderkey")
def one_per_key(lineitem):
    drawn = lineitem.withColumn("draw", corpus.draw_order("s", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return drawn.groupBy("l_orderkey").agg(F.min_by("l_partkey", "draw").alias("l_partkey"))


FILES = "SELECT doc_id // 50 AS project, count(*)::BIGINT AS files, sha256(string_agg('d' || doc_id::VARCHAR || ' ' || sha256(text), chr(10) ORDER BY 'd' || doc_id::VARCHAR)) AS fingerprint FROM {documents} GROUP BY 1"


@query("documents", sql=FILES)
def content_fingerprint(documents):
    """File sets of fifty documents each, so that a set is bounded."""
    files = documents.select(F.expr("doc_id div 50").alias("project"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path"), "text")
    return corpus.tree_fingerprint(files, "project").withColumn("files", F.col("files").cast("long"))


view("task_documents", """
SELECT CAST(floor(doc_id / 50) AS bigint) AS task, chr(123) || '"z": [1, ' || chr(123) || '"b": null, "a": "x: y, z"' || chr(125) || '], "gelee": true,"empreinte":"' || min(lang) || '", "id":"t'
 || CAST(min(doc_id) AS varchar(20)) || '"  , "a":' || CAST(sum(length(text)) AS varchar(20)) || chr(125) AS document FROM {documents} GROUP BY 1
""")  # fmt: skip
view("task_parts", """
SELECT CAST(floor(doc_id / 50) AS bigint) AS task, CASE doc_id % 4 WHEN 0 THEN 'depart' WHEN 1 THEN 'reference' WHEN 2 THEN 'tests_caches' ELSE 'notes' END AS folder,
 CASE WHEN doc_id % 8 = 0 THEN 'b/' WHEN doc_id % 12 = 4 THEN '.godot/' WHEN doc_id % 12 = 8 THEN 'b-c' ELSE '' END || 'd' || CAST(doc_id AS varchar(20)) AS path, text FROM {documents}
""")  # fmt: skip


@query("task_documents", "task_parts", sql=r"""WITH f AS (SELECT task, count(*)::INT AS files, string_agg(chr(10) || folder || '/' || path || chr(10) || sha256(coalesce(text, '')), '' ORDER BY list_position(['depart', 'reference', 'tests_caches'], folder), string_split(path, '/')) AS body FROM {task_parts} WHERE folder <> 'notes' AND NOT starts_with(path, '.godot/') GROUP BY task),
h AS (SELECT doc_id // 50 AS task, chr(123) || '"a": ' || sum(length(text)) || ', "id": "t' || min(doc_id) || '", "z": [1, ' || chr(123) || '"a": "x: y, z", "b": null' || chr(125) || ']' || chr(125) AS head FROM {documents} GROUP BY 1)
SELECT task, coalesce(files, 0)::INT AS files, sha256(head || coalesce(body, '')) AS fingerprint FROM h LEFT JOIN f USING (task)""")
def task_fingerprint(tasks, files):
    return corpus.task_fingerprint(tasks, files)


view("run_layers", """
SELECT CAST(floor(doc_id / 40) AS bigint) AS run, CASE WHEN doc_id % 9 = 5 THEN NULL ELSE CAST(doc_id % 3 AS int) END AS layer, CASE WHEN doc_id % 11 = 0 THEN 'reports/x' WHEN doc_id % 13 = 0 THEN 'journal.txt' WHEN doc_id % 7 = 0 THEN 'é' || chr(9) || 'a' ELSE 'f' || CAST(doc_id % 5 AS varchar(9)) END AS path, min(text) AS text FROM {documents} GROUP BY 1, 2, 3
""")
view("judged_runs", "SELECT CAST(floor(doc_id / 40) AS bigint) AS run, CASE WHEN min(doc_id) % 3 = 0 THEN NULL ELSE max(source) || chr(34) END AS filter, CAST(count(*) AS bigint) AS repetition FROM {documents} GROUP BY 1")


@query("judged_runs", "run_layers", sql=r"""WITH p AS (SELECT run, CASE WHEN layer IS NULL THEN 'tests_juge/' ELSE '' END || path AS path, arg_max(sha256(coalesce(text, '')), (coalesce(layer, 9), sha256(coalesce(text, '')))) AS sha FROM {run_layers} WHERE path <> 'reports/x' AND (layer IS NULL OR path <> 'journal.txt') GROUP BY 1, 2),
f AS (SELECT run, string_agg('"' || replace(replace(path, 'é', '\u00e9'), chr(9), '\t') || '": "' || sha || '"', ', ' ORDER BY path) AS files FROM p GROUP BY run)
SELECT run, sha256(chr(123) || '"etapes": ["import", "run_tests"], "fichiers": ' || chr(123) || coalesce(files, '') || chr(125) || ', "filtre": ' || coalesce('"' || replace(filter, '"', '\"') || '"', 'null') || ', "godot": "4", "juge": "j1", "rep": ' || repetition || chr(125)) AS key FROM {judged_runs} LEFT JOIN f USING (run)""")
def verdict_key(runs, layers):
    steps = F.array(F.lit("run_tests"), F.lit("import"), F.lit("deploy"))
    return corpus.verdict_key(runs.withColumn("steps", steps), layers, {"godot": "4", "juge": "j1"})


OVER = "o AS (SELECT project, path, arg_max(text, layer) AS text, max(layer) AS layer FROM {layers} GROUP BY project, path HAVING path <> 'f3')"


@query("layers", sql=f"WITH {OVER} SELECT project, path, layer, sha256(text) AS hash FROM o")
def overlay_files(layers):
    removed = layers.filter("path = 'f3'").select("project", "path").distinct()
    return corpus.overlay(layers, removed, "project").select("project", "path", "layer", corpus.fingerprint("text").alias("hash"))


@query("layers", sql=f"WITH {OVER} SELECT project, count(*)::BIGINT AS files, sha256(string_agg(path || ' ' || sha256(text), chr(10) ORDER BY path)) AS fingerprint FROM o GROUP BY project")
def tree_fingerprint(layers):
    removed = layers.filter("path = 'f3'").select("project", "path").distinct()
    return corpus.tree_fingerprint(corpus.overlay(layers, removed, "project"), "project").withColumn("files", F.col("files").cast("long"))


@query("documents", sql="""WITH t AS (SELECT doc_id, text AS now, CASE WHEN doc_id % 17 = 0 THEN replace(text, ' the ', ' a ') ELSE text END AS old, CASE WHEN doc_id % 31 <> 0 THEN text END AS listed FROM {documents})
SELECT doc_id, CASE WHEN listed IS NULL THEN 'missing' WHEN sha256(old) <> sha256(now) OR sha256(listed) <> sha256(now) THEN 'modified' ELSE 'intact' END AS status FROM t""")
def frozen_integrity(documents):
    """Stored hash, hash of the text now and hash in the manifest must agree for every frozen row."""
    frozen = documents.select("doc_id", "text")
    then = F.when(F.col("doc_id") % 17 == 0, F.replace("text", F.lit(" the "), F.lit(" a "))).otherwise(F.col("text"))
    stored = frozen.select("doc_id", then.alias("text")).select("doc_id", corpus.fingerprint("text").alias("stored"))
    manifest = frozen.filter("doc_id % 31 <> 0").select("doc_id", corpus.fingerprint("text").alias("listed"))
    joined = frozen.join(stored, "doc_id").join(manifest, "doc_id", "left").withColumn("now", corpus.fingerprint("text"))
    status = F.when(F.col("listed").isNull(), "missing").when((F.col("stored") != F.col("now")) | (F.col("listed") != F.col("now")), "modified").otherwise("intact")
    return joined.select("doc_id", status.alias("status"))


@query("documents", sql="""SELECT CASE WHEN length(text) % 9 = 0 THEN 'failed' WHEN sha256(text) <> sha256(replace(text, 'the', 'a')) THEN 'modified' ELSE 'verified' END AS status, count(*)::BIGINT AS n FROM {documents} WHERE text IS NOT NULL GROUP BY 1""")
def verify_by_hash(documents):
    """Rows against what was recorded when they were verified: failed then, changed since, or verified."""
    documents = documents.filter("text IS NOT NULL")
    noted = documents.select("doc_id", (F.length("text") % 9 != 0).alias("passed"), corpus.fingerprint("text").alias("hash"))
    now = documents.select("doc_id", F.replace("text", F.lit("the"), F.lit("a")).alias("text"))
    joined = now.join(noted, "doc_id")
    status = F.when(~F.col("passed"), "failed").when(corpus.fingerprint("text") != F.col("hash"), "modified").otherwise("verified")
    return joined.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


RESIDUE = r"\{\{|\}\}|TODO|<[A-Z_]+>|\$\{"


@query("documents", sql=rf"SELECT doc_id FROM {{documents}} WHERE regexp_matches(text, '{RESIDUE.replace('{', chr(92) + 'x7B').replace('}', chr(92) + 'x7D').replace(chr(92) + chr(92), chr(92))}|\|')")
def template_residue(documents):
    return documents.filter(F.col("text").rlike(RESIDUE + r"|\|")).select("doc_id")


@query("documents", sql="SELECT doc_id, CASE WHEN length(text) > 200 THEN rtrim(substring(text, 1, 200), ' ') || ' […]' ELSE text END AS text FROM {documents}")
def truncate_with_mark(documents):
    return documents.select("doc_id", corpus.truncated("text", 200).alias("text"))


@query("part", sql="WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS stem FROM {part}) SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY stem) > 1 THEN stem || '_' || p_partkey::VARCHAR ELSE stem END AS slug FROM s")
def slug_id(part):
    """Slugs of name and brand; those that several rows would have get their key."""
    stems = part.select("p_partkey", corpus.slug("p_name", "p_brand").alias("stem"))
    counted = stems.groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    return stems.join(counted, "stem").select("p_partkey", F.when(F.col("n") > 1, F.concat_ws("_", "stem", "p_partkey")).otherwise(F.col("stem")).alias("slug"))


@query("documents", sql="""SELECT grp, count(*)::BIGINT AS rows, sum(m)::BIGINT AS total, round(avg(m), 6) AS mean, min(m) AS least, max(m) AS most, arg_max(k, (m, -k)) AS largest, sum((m > 5000)::INT)::BIGINT AS over
FROM (SELECT unnest(['all', 'lang/' || lang, 'lang+source/' || lang || '/' || source]) AS grp, n_chars AS m, doc_id AS k FROM {documents}) GROUP BY grp""")
def corpus_stats(documents):
    return corpus.corpus_stats(documents, [[], ["lang"], ["lang", "source"]], "n_chars", "doc_id", 5000).withColumn("mean", F.round("mean", 6))
