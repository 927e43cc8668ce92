"""Queries of edits, faults and helpers, over pairs made of documents."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from millrace.operators import corpus, edits, groups, orders
from millrace.plans.registry import query, view

view("revised", """
SELECT doc_id AS id, text AS before, CASE WHEN doc_id % 3 = 0 THEN replace(text, 'the ', 'a ') WHEN doc_id % 3 = 1 THEN text || chr(10) || 'var x = 1' ELSE text END AS after FROM {documents}
""")

LINES = """WITH l AS (SELECT id, unnest(range(1, len(string_split(after, chr(10))) + 1)) AS line, unnest(string_split(after, chr(10))) AS new, string_split(before, chr(10)) AS old FROM {revised})"""


@query("revised", sql=f"{LINES} SELECT id, line FROM l WHERE new IS DISTINCT FROM old[line]")
def changed_lines(revised):
    return edits.rows_of(revised, ["id", "before", "after"], lambda k, a, b: [(k, n) for n in edits.changed_lines(a, b)], "id bigint, line bigint")


@query("revised", sql=f"{LINES} SELECT id, coalesce(sum(1 + (line <= len(old))::INT) FILTER (new IS DISTINCT FROM old[line]), 0)::BIGINT AS lines FROM l GROUP BY id")
def patch_size(revised):
    return edits.rows_of(revised, ["id", "before", "after"], lambda k, a, b: [(k, edits.patch_size(a, b))], "id bigint, lines bigint")


view("files_before", "SELECT CAST(floor(doc_id / 20) AS bigint) AS project, CASE WHEN doc_id % 6 = 0 THEN 'addons/' WHEN doc_id % 10 = 3 THEN '.godot/' ELSE '' END || 'f' || CAST(doc_id AS varchar(20)) || CASE WHEN doc_id % 7 = 1 THEN '.png' ELSE '.gd' END AS path, coalesce(text, '') AS text, doc_id FROM {documents}")
# every third file gone, every third one line longer, one in twenty new
view("files_after", """
SELECT project, path, CASE WHEN doc_id % 3 = 1 THEN text || chr(10) || 'var added_' || CAST(doc_id AS varchar(20)) ELSE text END AS text, doc_id FROM {files_before} WHERE doc_id % 3 <> 2
UNION ALL SELECT project, 'new/' || CAST(doc_id AS varchar(20)) || '.md', text, doc_id FROM {files_before} WHERE doc_id % 20 = 9
""")  # fmt: skip
COUNTED_FILES = r"NOT starts_with(path, 'addons/') AND NOT starts_with(path, '.godot/') AND NOT ends_with(path, '.png')"
# lines as the helper splits them: by any line end, none after the last
LINE_COUNT = r"len(regexp_extract_all(text, '(?s)(?:[^\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]*(?:\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])|[^\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]+\z)'))"


@query("files_before", "files_after", sql=f"""WITH a AS (SELECT project, CASE WHEN doc_id % 3 = 2 THEN 1 ELSE doc_id % 3 END AS files, CASE doc_id % 3 WHEN 2 THEN {LINE_COUNT} ELSE doc_id % 3 + (text = '' AND doc_id % 3 = 1)::INT END AS lines FROM {{files_before}} WHERE {COUNTED_FILES}
 UNION ALL SELECT project, 1, {LINE_COUNT} FROM {{files_before}} WHERE doc_id % 20 = 9)
SELECT p.project, coalesce(sum(files), 0)::BIGINT AS files, coalesce(sum(lines), 0)::BIGINT AS lines, coalesce(sum(lines), 0) > 400 AS rejected FROM (SELECT DISTINCT project FROM {{files_before}}) p LEFT JOIN a USING (project) GROUP BY p.project""")
def project_patch(before, after):
    return edits.project_patch(before, after, 400)


@query("revised")
def answer_zones(revised):
    t = revised.select("id", corpus.tokens("before").alias("a"), corpus.tokens("after").alias("b")).filter("a <> b")
    return edits.rows_of(t, ["id", "a", "b"], lambda k, a, b: [(k, n, z) for n, z in enumerate(edits.answer_zones(list(a), list(b)))], "id bigint, zone bigint, text string")


@query("revised")
def task_signature(revised):
    """Shingles of the changed zones and of the first line of the text, for each changed row."""
    t = revised.select("id", corpus.tokens("before").alias("a"), corpus.tokens("after").alias("b")).filter("a <> b")
    zones = edits.rows_of(t, ["id", "a", "b"], lambda k, a, b: [(k, "\n".join(edits.answer_zones(list(a), list(b))))], "id bigint, text string")
    both = zones.join(revised.select("id", F.split("before", "\n")[0].alias("instruction")), "id")
    return both.select("id", F.size(corpus.shingles("text")).alias("answer_shingles"), F.size(corpus.shingles("instruction")).alias("instruction_shingles"))


@query("revised")
def unique_edits(revised):
    f = lambda k, a, b: [(k, n, o, w) for n, (o, w) in enumerate(edits.unique_edits(a, b) or [])]
    return edits.rows_of(revised, ["id", "before", "after"], f, "id bigint, step bigint, old string, new string")


@query("revised", sql="SELECT id, sha256(after) AS hash, true AS replayed FROM {revised}")
def replay_edits(revised):
    """Edits of each pair, applied in order: must give the expected text."""

    def f(k, a, b):
        made = edits.unique_edits(a, b)
        text, reason = edits.replay(a, made) if made is not None else (b, None)
        return [(k, hashlib.sha256(text.encode()).hexdigest(), reason is None and text == b)]

    return edits.rows_of(revised, ["id", "before", "after"], f, "id bigint, hash string, replayed boolean")


@query("events", sql="SELECT event_id, (props::JSON->>'k')::BIGINT AS k, CASE WHEN event_id % 9 = 0 THEN 'unreadable' END AS reason FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE props END AS props FROM {events})")
def answer_json(events):
    """JSON of an answer: the whole text, else the first object inside it, else null with a reason."""
    answers = events.select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit("no json here")).when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure: "), "props", F.lit(" done"))).otherwise(F.col("props")).alias("text"))

    def f(k, t):
        value, reason = edits.json_scan(t)
        return [(k, value["k"] if isinstance(value, dict) and "k" in value else None, reason)]

    return edits.rows_of(answers, ["event_id", "text"], f, "event_id bigint, k bigint, reason string")


@query("documents", sql="""WITH RECURSIVE o AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM {documents}),
f AS (SELECT source, i, 0::BIGINT AS pack, n_chars::BIGINT AS used FROM o WHERE i = 1 UNION ALL SELECT o.source, o.i, pack + (used + n_chars > 20000)::INT, CASE WHEN used + n_chars > 20000 THEN n_chars ELSE used + n_chars END FROM f JOIN o ON o.source = f.source AND o.i = f.i + 1),
s AS (SELECT source, pack, max(used) AS used FROM f GROUP BY ALL), l AS (SELECT source, max(pack) AS pack, arg_max(used, pack) AS used FROM s GROUP BY source)
SELECT o.source, doc_id, CASE WHEN f.pack = l.pack AND l.pack > 0 AND l.used < 2500 THEN f.pack - 1 ELSE f.pack END AS pack FROM o JOIN f ON f.source = o.source AND f.i = o.i JOIN l ON l.source = o.source""")
def pack_in_order(documents):
    """All documents of a source, in order, packed under a budget of characters; a short last pack joins the one before."""
    return orders.pack_in_order(documents.select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", 20_000, 2_500).select("source", "doc_id", "pack")


view("name_uses", "SELECT CAST(floor(l_orderkey / 4) AS bigint) AS grp, 'p' || CAST(l_partkey % 29 AS varchar(9)) AS a, 'p' || CAST((l_suppkey * 7 + l_linenumber) % 29 AS varchar(9)) AS b FROM {lineitem}")


@query("name_uses", sql="""WITH RECURSIVE e AS (SELECT DISTINCT grp, a, b FROM {name_uses}), n AS (SELECT grp, a AS node FROM e UNION SELECT grp, b FROM e), r AS (SELECT grp, a, b FROM e UNION SELECT r.grp, r.a, e.b FROM r JOIN e ON e.grp = r.grp AND e.a = r.b),
m AS (SELECT n.grp, n.node, coalesce(max(x.b), n.node) AS other FROM n LEFT JOIN (SELECT r.grp, r.a, r.b FROM r JOIN r s ON s.grp = r.grp AND s.a = r.b AND s.b = r.a) x ON x.grp = n.grp AND x.a = n.node GROUP BY n.grp, n.node), c AS (SELECT grp, node, greatest(node, other) AS component FROM m),
b AS (SELECT DISTINCT e.grp, x.component AS ca, y.component AS cb FROM e JOIN c x ON x.grp = e.grp AND x.node = e.a JOIN c y ON y.grp = e.grp AND y.node = e.b WHERE x.component <> y.component),
l AS (SELECT DISTINCT grp, component, 0 AS layer FROM c UNION SELECT b.grp, b.ca, layer + 1 FROM l JOIN b ON b.grp = l.grp AND b.cb = l.component), d AS (SELECT grp, component, max(layer) AS layer FROM l GROUP BY ALL),
p AS (SELECT grp, component, string_agg(node, '+' ORDER BY node) AS pieces, min(node) AS first FROM c GROUP BY ALL) SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY layer, first) - 1 AS place, layer, pieces FROM p JOIN d USING (grp, component)""")
def dependency_groups(uses):
    """Names of every four orders as pieces that use each other: mutual users are one group, in an order of use."""
    return groups.dependency_groups(uses).withColumn("pieces", F.array_join("pieces", "+"))


@query("documents", sql="""WITH RECURSIVE c AS (SELECT lang AS grp, source AS key, count(*) AS n FROM {documents} GROUP BY ALL), q AS (SELECT grp, list(key ORDER BY key) AS keys, list(round_even(137 * n / (SELECT sum(n) FROM c x WHERE x.grp = c.grp), 0)::BIGINT ORDER BY key) AS q FROM c GROUP BY grp),
r AS (SELECT grp, keys, q FROM q UNION ALL SELECT grp, keys, CASE WHEN list_sum(q) < 137 THEN list_transform(q, lambda x, i: x + (i = list_position(q, list_min(q)))::INT) ELSE list_transform(q, lambda x, i: x - (i = len(q) + 1 - list_position(list_reverse(q), list_max(q)))::INT) END FROM r WHERE list_sum(q) <> 137)
SELECT grp, unnest(keys) AS key, unnest(q) AS quota FROM r WHERE list_sum(q) = 137""")
def proportional_quotas(documents):
    """137 places of each language split by the documents of each source."""
    shares = documents.groupBy(F.col("lang").alias("grp"), F.col("source").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("share"))
    return orders.proportional_quotas(shares, 137)
