"""Queries of chunking and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import index, names, stems
from millrace.operators import retrieval as r
from millrace.operators import vocabulary as v
from millrace.plans.corpus import HITS
from millrace.plans.names import ratios
from millrace.plans.registry import query, view
from millrace.plans.vocabulary import CHAIN
from millrace.sources import folders

view("passages", "SELECT doc_id AS id, text FROM {documents}")
view("questions", "SELECT item_id AS query, text FROM {benchmark}")
view("vectors", "SELECT vec_id AS id, embedding AS vector FROM {embeddings}")
view("fragments", "SELECT doc_id AS id, CASE WHEN strpos(text, chr(10)) > 0 THEN substring(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS title, text, doc_id % 3 = 0 AS example FROM {documents}".replace("strpos", "instr"))
TERMS = r"regexp_extract_all(lower(coalesce({}, '')), '[a-z\x{{E0}}-\x{{FF}}]{{2,}}')"
KEPT = f"{HITS}, kept AS (SELECT f.*, {TERMS.format('title')} AS t, {TERMS.format('f.text')} AS b FROM {{fragments}} f WHERE id NOT IN (SELECT id FROM found))"
POSTED = f"""{KEPT}, ps AS (SELECT id, example, len(t) + len(b) AS size, unnest(list_concat(list_transform(t, lambda x: {{'term': x, 'title': 1}}), list_transform(b, lambda x: {{'term': x, 'title': 0}})), recursive := true) FROM kept),
tf AS (SELECT term, id, example, size, sum(title) AS in_title, sum(1 - title) AS in_body FROM ps GROUP BY ALL), df AS (SELECT term, count(*) AS df, sum(in_title + in_body) AS cf FROM tf GROUP BY term)"""
BM25 = f"""{POSTED}, st AS (SELECT count(*) AS n, sum(len(t) + len(b)) / greatest(count(*), 1) AS mean FROM kept), a AS (SELECT query, unnest(list_distinct({TERMS.format('text')})) AS term FROM {{questions}}), w AS (SELECT query, count(*) AS wanted FROM a GROUP BY query),
sc AS (SELECT a.query, tf.id, example, round(sum(ln(1 + (st.n - df.df + 0.5) / (df.df + 0.5)) * (8 * in_title + in_body) * 2.2 / (8 * in_title + in_body + 1.2 * (0.25 + 0.75 * tf.size / st.mean))), 6) AS score, count(*) = any_value(wanted) AS every FROM a JOIN w USING (query) JOIN df USING (term) JOIN tf USING (term), st GROUP BY ALL)"""


def built(fragments, protected):
    return index.build_index(fragments, protected, folders.scratch(fragments.sparkSession))


@query("fragments", "protected", sql=f"{POSTED} SELECT count(*)::BIGINT AS fragments, (SELECT count(*) FROM found)::BIGINT AS excluded, (SELECT count(*) FROM df)::BIGINT AS terms, (SELECT count(*) FROM tf)::BIGINT AS postings, round(sum(len(t) + len(b)) / count(*), 6) AS mean, (SELECT count(*) FROM {{protected}})::BIGINT AS protected, true AS current FROM kept")
def build_index(fragments, protected):
    """The meta row of the version that was written last, and whether the protected texts are still those it was built without."""
    root = folders.scratch(fragments.sparkSession)
    index.build_index(fragments, protected, root)
    found = index.open_index(fragments.sparkSession, root)
    meta = found.table("meta").select("fragments", "excluded", "terms", "postings", F.round("mean", 6).alias("mean"), "protected")
    return meta.join(index.is_current(found, protected))


@query("fragments", "protected", sql=f"{HITS} SELECT id, item FROM found")
def index_excluded(fragments, protected):
    return built(fragments, protected).table("excluded")


@query("fragments", "protected", sql=f"{POSTED} SELECT term, df::BIGINT AS df, cf::BIGINT AS cf, max(in_title)::BIGINT AS in_title FROM df JOIN tf USING (term) GROUP BY ALL")
def index_terms(fragments, protected):
    found = built(fragments, protected)
    most = found.table("postings").groupBy("bucket", "term").agg(F.max("in_title").alias("in_title"))
    return found.table("terms").join(most, ["bucket", "term"]).select("term", "df", "cf", "in_title")


@query("fragments", "protected", "questions", sql=f"{BM25} SELECT query, row_number() OVER w AS rank, id FROM sc WINDOW w AS (PARTITION BY query ORDER BY every DESC, score DESC, id) QUALIFY rank <= 5")
def fulltext_bm25(fragments, protected, questions):
    return index.bm25(built(fragments, protected), questions, 5).select("query", "rank", "id")


view("titles", "SELECT id AS query, title AS text FROM {fragments} WHERE id % 20 = 0")


@query("fragments", "protected", "titles", sql=f"{BM25.replace('{questions}', '{titles}')} SELECT query, row_number() OVER w AS rank, id FROM sc WHERE every WINDOW w AS (PARTITION BY query ORDER BY score DESC, id) QUALIFY rank <= 5")
def fulltext_all_terms(fragments, protected, titles):
    return index.bm25(built(fragments, protected), titles, 5, every=True).select("query", "rank", "id")


@query("vectors", sql="""WITH s AS (SELECT q.id AS query, v.id, round(list_cosine_similarity(q.vector::DOUBLE[], v.vector::DOUBLE[]), 6) AS score FROM {vectors} q, {vectors} v WHERE q.id % 20 = 0)
SELECT query, rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id)::INT AS rank FROM s) WHERE rank <= 5""")
def vector_neighbors(vectors):
    queries = vectors.filter("id % 20 = 0").select(F.col("id").alias("query"), "vector")
    return r.neighbours(vectors, queries, 5).select("query", "rank", "id", "score")


WIDTH = 16
EMBEDDED = "SELECT {0}, list_transform(range(16), lambda k: len(list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '' AND strpos('0123456789abcdef', md5(x)[1]) - 1 = k))::DOUBLE) AS v FROM {1}"


@query("passages", sql=f"SELECT id, len(v)::INT AS width, list_sum(v)::BIGINT AS words, array_to_string(list_transform(v, lambda x: x::BIGINT), ',') AS vector FROM ({EMBEDDED.format('id', '{passages}')})")
def embed_batches(passages):
    v = r.embed(passages, r.hashing_embedder, WIDTH)
    return v.select("id", F.size("vector").alias("width"), F.aggregate("vector", F.lit(0.0), lambda a, x: a + x).cast("long").alias("words"), F.array_join(F.transform("vector", lambda x: x.cast("long").cast("string")), ",").alias("vector"))


PLACES = 8
FILL = "s{k} AS (SELECT query, id, {k} AS stage, row_number() OVER (PARTITION BY query ORDER BY rank, id) AS r, '{by}' AS found_by, coalesce(placed, 0) AS placed FROM {rows} x LEFT JOIN (SELECT query, count(*) AS placed FROM u{j} GROUP BY query) USING (query) WHERE NOT EXISTS (SELECT 1 FROM u{j} u WHERE u.query = x.query AND u.id = x.id) QUALIFY r <= least({n} - placed, {most})), u{k} AS (SELECT * FROM u{j} UNION ALL SELECT query, id, stage, r, found_by FROM s{k})"


def fill(k: int, rows: str, by: str, most: int = PLACES) -> str:
    return FILL.format(k=k, j=k - 1, rows=rows, by=by, most=most, n=PLACES)


@query("fragments", "protected", "questions", sql=f"""{BM25}, kf AS (SELECT unnest(list_distinct(string_split(coalesce(text, ''), ' '))) AS w, id FROM kept), qw AS (SELECT query, unnest(list_distinct(string_split(coalesce(text, ''), ' '))) AS w FROM {{questions}}),
ex AS (SELECT query, min(f.id) AS id, 1 AS rank FROM qw JOIN (SELECT w, min(id) AS id FROM kf WHERE w <> '' GROUP BY w) f USING (w) GROUP BY query), te AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY every DESC, score DESC, id) AS rank FROM sc WHERE example QUALIFY rank <= 16), td AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY every DESC, score DESC, id) AS rank FROM sc WHERE NOT example QUALIFY rank <= 16),
ve AS ({EMBEDDED.format('id', 'kept')}), vq AS ({EMBEDDED.format('query', '{questions}')}), vn AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY coalesce(nullif(round(list_cosine_similarity(vq.v, ve.v), 6), 'nan'::DOUBLE), 0) DESC, id) AS rank FROM vq, ve QUALIFY rank <= 24),
u0 AS (SELECT 0::BIGINT AS query, 0::BIGINT AS id, 0 AS stage, 0::BIGINT AS r, '' AS found_by WHERE false), {fill(1, "ex", "exact", PLACES - PLACES // 2)}, {fill(2, "te", "text", PLACES // 2)}, {fill(3, "vn", "vector")}, {fill(4, "td", "text")}, {fill(5, "te", "text")}
SELECT query, row_number() OVER (PARTITION BY query ORDER BY stage, r)::INT AS place, id, found_by FROM u5""")
def hybrid_search(fragments, protected, questions):
    """Exact words as identifiers, verified examples up to half the places, vectors of a stand-in embedder, other text, examples again."""
    found = built(fragments, protected)
    kept = found.table("fragments")
    words = lambda: F.explode(F.array_distinct(F.split("text", " "))).alias("w")
    first = kept.select("id", words()).filter("w <> ''").groupBy("w").agg(F.min("id").alias("id"))
    exact = questions.select("query", words()).join(first, "w").groupBy("query").agg(F.min("id").alias("id")).withColumn("rank", F.lit(1)).checkpoint()
    asked = r.embed(questions.select(F.col("query").alias("id"), "text"), r.hashing_embedder, WIDTH).select(F.col("id").alias("query"), "vector")
    # few rows each, and stages read them several times
    near = r.neighbours(r.embed(kept, r.hashing_embedder, WIDTH), asked, 3 * PLACES).checkpoint()
    examples, others = (index.bm25(found, questions, 2 * PLACES, example=x).checkpoint() for x in (True, False))
    half = F.lit(PLACES // 2)
    stages = [("exact", exact, half), ("text", examples, half), ("vector", near, None), ("text", others, None), ("text", examples, None)]
    return r.staged(stages, PLACES)


@query("passages", sql=r"""WITH RECURSIVE x AS (SELECT id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda p: regexp_matches(p, '[^\s]')) AS p FROM {passages}),
j AS (SELECT id, 1 AS k, 0::BIGINT AS chunk, length(p[1]) + 1 AS used FROM x WHERE len(p) > 0 UNION ALL SELECT x.id, k + 1, chunk + (used + length(x.p[k + 1]) + 1 > 1800)::INT, CASE WHEN used + length(x.p[k + 1]) + 1 > 1800 THEN length(x.p[k + 1]) + 1 ELSE used + length(x.p[k + 1]) + 1 END FROM j JOIN x ON x.id = j.id WHERE k < len(x.p)),
y AS (SELECT j.id, chunk, string_agg(x.p[k], chr(10) ORDER BY k) AS text FROM j JOIN x ON x.id = j.id GROUP BY j.id, chunk) SELECT id, chunk, length(text)::BIGINT AS chars, sha256(text) AS hash FROM y""")
def chunk_paragraphs(passages):
    return r.chunk_paragraphs(passages).select("id", "chunk", F.length("text").cast("long").alias("chars"), F.sha2(F.col("text").cast("binary"), 256).alias("hash"))


view("page_lines", "SELECT doc_id AS page, CAST(p AS bigint) + 1 AS line, t AS text, (p + doc_id) % 5 AS level FROM {documents} LATERAL VIEW posexplode(split(text, '\\\\n')) x AS p, t", "SELECT page, line, t AS text, (line - 1 + page) % 5 AS level FROM (SELECT doc_id AS page, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line, unnest(string_split(text, chr(10))) AS t FROM {documents}) r")


@query("page_lines", sql="""WITH s AS (SELECT *, max(CASE WHEN level = 1 THEN line END) OVER w AS l1, max(CASE WHEN level = 2 THEN line END) OVER w AS l2, max(CASE WHEN level = 3 THEN line END) OVER w AS l3,
 last_value(CASE WHEN level = 1 THEN text END IGNORE NULLS) OVER w AS t1, last_value(CASE WHEN level = 2 THEN text END IGNORE NULLS) OVER w AS t2, last_value(CASE WHEN level = 3 THEN text END IGNORE NULLS) OVER w AS t3 FROM {page_lines} WINDOW w AS (PARTITION BY page ORDER BY line))
SELECT page, line, concat_ws(' > ', t1, CASE WHEN l2 > coalesce(l1, -1) THEN t2 END, CASE WHEN l3 > coalesce(l1, -1) AND l3 > coalesce(CASE WHEN l2 > coalesce(l1, -1) THEN l2 END, -1) THEN t3 END) AS path FROM s""")
def heading_path(lines):
    return r.heading_path(lines.drop("level"), F.pmod(F.col("line") - 1 + F.col("page"), F.lit(5)))


view("class_fragments", "SELECT 'C' || CAST(p_partkey AS varchar(20)) AS class, p_partkey AS id FROM {part}")
view("member_fragments", "SELECT CASE WHEN l_linenumber = 1 THEN 'run' ELSE 'get_' || CAST(l_suppkey % 50 AS varchar(9)) END AS member, 'C' || CAST(l_partkey AS varchar(20)) AS class, 1000000000 + l_orderkey * 10 + l_linenumber AS id FROM {lineitem}")
view("name_queries", """
SELECT o_orderkey AS query, CASE o_orderkey % 6 WHEN 0 THEN 'C' || CAST(o_custkey AS varchar(20)) || '.get_' || CAST(o_custkey % 50 AS varchar(9)) || '()' WHEN 1 THEN 'c' || CAST(o_custkey AS varchar(20)) || '.run'
 WHEN 2 THEN 'How does C' || CAST(o_custkey AS varchar(20)) || ' use get_' || CAST(o_custkey % 50 AS varchar(9)) || ' or run?' WHEN 3 THEN 'the c' || CAST(o_custkey AS varchar(20)) || ' and get_' || CAST(o_custkey % 50 AS varchar(9)) WHEN 4 THEN ' c' || CAST(o_custkey AS varchar(20)) ELSE 'run' END AS text FROM {orders}
""")  # fmt: skip
DOTTED = rf"^({r.IDENTIFIER})\.([A-Za-z_][A-Za-z0-9_]*)(\(\))?\z"


@query("name_queries", "class_fragments", "member_fragments", "named_parents", sql=rf"""WITH RECURSIVE {CHAIN}, up AS (SELECT 'C' || child AS child, 'C' || ancestor AS ancestor FROM chain),
q AS (SELECT query, trim(text) AS text, regexp_matches(trim(text), '{DOTTED}') AS dotted FROM {{name_queries}}), m AS (SELECT member, class, min(id) AS id FROM {{member_fragments}} GROUP BY ALL), x AS (SELECT query, regexp_extract_all(text, '{r.IDENTIFIER}') AS words FROM q WHERE NOT dotted),
w AS (SELECT query, len(words) AS n, unnest(range(len(words))) AS pos, unnest(words) AS word FROM x), wc AS (SELECT query, pos, arg_min(class, (class <> word, id)) AS found, arg_min(id, (class <> word, id)) AS id FROM w JOIN {{class_fragments}} ON lower(class) = lower(word) GROUP BY query, pos, n, word HAVING min(class <> word) = false OR n = 1),
d AS (SELECT query, regexp_extract(text, '{DOTTED}', 1) AS class, regexp_extract(text, '{DOTTED}', 2) AS member FROM q WHERE dotted), dc AS (SELECT query, member, arg_min(c.class, (c.class <> d.class, id)) AS found, arg_min(id, (c.class <> d.class, id)) AS id FROM d JOIN {{class_fragments}} c ON lower(c.class) = lower(d.class) GROUP BY query, member),
o AS (SELECT w.* FROM w ANTI JOIN wc ON wc.query = w.query AND wc.pos = w.pos WHERE n = 1 OR contains(word, '_')), f AS (SELECT query, 1 AS kind, pos, id FROM wc UNION ALL SELECT query, 1, 0, id FROM dc UNION ALL SELECT dc.query, 0, 0, min(m.id) FROM dc JOIN up ON up.child = dc.found JOIN m ON m.class = up.ancestor AND m.member = dc.member GROUP BY dc.query
 UNION ALL SELECT o.query, 0, o.pos, min(m.id) FROM o JOIN wc ON wc.query = o.query JOIN up ON up.child = wc.found JOIN m ON m.class = up.ancestor AND m.member = o.word GROUP BY o.query, o.pos
 UNION ALL SELECT o.query, 0, o.pos, e.id FROM o ANTI JOIN wc ON wc.query = o.query JOIN (SELECT member, id FROM {{member_fragments}} QUALIFY row_number() OVER (PARTITION BY member ORDER BY id) <= {r.MANY}) e ON e.member = o.word),
g AS (SELECT query, id, min((kind, pos)) AS x FROM f GROUP BY ALL) SELECT query, row_number() OVER (PARTITION BY query ORDER BY x, id)::INT AS rank, id FROM g""")
def exact_lookup(queries, classes, members, parents):
    upper = parents.select(F.upper("child").alias("child"), F.upper("parent").alias("parent"))
    return r.exact_lookup(queries, classes, members, v.closure(upper))


class Sql:
    """The operations of the stemmer's steps in DuckDB's SQL."""

    ends = staticmethod(lambda w, s: f"ends_with({w}, '{s}')")
    cut = staticmethod(lambda w, n: f"left({w}, length({w}) - {n})" if n else w)
    fits = staticmethod(lambda w, p: f"regexp_matches({w}, '{p}')")
    add = staticmethod(lambda w, s: f"({w} || '{s}')" if s else w)
    both = staticmethod(lambda a, b: f"({a} AND {b})")
    no = staticmethod(lambda a: f"(NOT {a})")
    choose = staticmethod(lambda cases, other: "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in cases) + f" ELSE {other} END")


def _stemmed() -> str:
    resolved = "regexp_replace(w, '^y', 'Y')"
    for _ in range(4):
        resolved = f"regexp_replace(regexp_replace({resolved}, '([aeiou1])y', '\\1Y', 'g'), '([^aeiou1y])y', '\\11', 'g')"
    ctes = [f"t AS (SELECT DISTINCT unnest({TERMS.format('text')}) AS term FROM {{passages}})", f"f AS (SELECT term, translate(term, '{stems.ACCENTED[0]}', '{stems.ACCENTED[1]}') AS w FROM t)", f"s0 AS (SELECT term, w AS whole, {resolved} AS w FROM f)"]
    for k, step in enumerate(stems.steps(Sql)):
        ctes.append(f"s{k + 1} AS (SELECT term, whole, {step('w')} AS w FROM s{k})")
    return f"WITH {', '.join(ctes)} SELECT term, CASE WHEN length(whole) > 2 THEN translate(w, '1Y', 'yy') ELSE whole END AS stem FROM s{len(ctes) - 3}"


@query("passages", sql=_stemmed())
def stem_terms(passages):
    return stems.stem_terms(passages.select(F.explode(r.terms("text")).alias("term")))


@query("part", sql=f"""WITH RECURSIVE a AS (SELECT DISTINCT '_' || p_name || 's' AS asked FROM {{part}} WHERE p_partkey % 20 = 0), k AS (SELECT DISTINCT p_name AS name FROM {{part}}),
pairs AS (SELECT asked AS query, name AS id FROM a JOIN k ON asked <> name), {ratios("pairs")}
SELECT query, rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id DESC)::INT AS rank FROM ratios WHERE score >= 0.6) WHERE rank <= 3""")
def close_names(part):
    asked = part.filter("p_partkey % 20 = 0").select(F.concat(F.lit("_"), F.col("p_name"), F.lit("s")).alias("name"))
    return names.close_names(asked, part.select(F.col("p_name").alias("name"))).select("query", "rank", "id", "score")
