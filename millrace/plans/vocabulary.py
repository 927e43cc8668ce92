"""Queries over class trees, references, names and settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import vocabulary as v
from millrace.plans.registry import query, view

view("parents", "SELECT p_partkey AS child, CASE WHEN p_partkey = 0 THEN NULL ELSE CAST(floor((p_partkey - 1) / 4) AS bigint) END AS parent FROM {part}")
view("members", "SELECT DISTINCT CAST(floor(l_partkey / 7) AS bigint) AS class, 'm' || CAST(l_suppkey % 40 AS varchar(9)) AS member, CASE WHEN l_linenumber < 4 THEN 'method' ELSE 'property' END AS kind FROM {lineitem}")
view("accesses", "SELECT o_orderkey AS access, o_custkey AS class, 'm' || CAST(o_orderkey % 120 AS varchar(9)) AS member FROM {orders}")
CHAIN = "chain AS (SELECT child, child AS ancestor, 0 AS depth FROM {parents} UNION ALL SELECT c.child, p.parent, c.depth + 1 FROM chain c JOIN {parents} p ON c.ancestor = p.child WHERE p.parent IS NOT NULL)"


@query("parents", sql=f"WITH RECURSIVE {CHAIN} SELECT * FROM chain")
def ancestor_closure(parents):
    return v.closure(parents)


@query("parents", "members", sql=f"WITH RECURSIVE {CHAIN}, i AS (SELECT c.child, m.member, m.kind, m.class AS origin, c.depth FROM chain c JOIN {{members}} m ON m.class = c.ancestor) SELECT child, member, kind, arg_min(origin, depth) AS origin FROM i GROUP BY ALL")
def member_lookup(parents, members):
    return v.nearest(v.members_of(v.closure(parents), members))


@query("parents", "members", sql=f"WITH RECURSIVE {CHAIN} SELECT c.child, m.kind, count(*)::BIGINT AS members, count(DISTINCT m.class)::BIGINT AS origins FROM chain c JOIN {{members}} m ON m.class = c.ancestor GROUP BY ALL")
def inherited_members(parents, members):
    return v.members_of(v.closure(parents), members).groupBy("child", "kind").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("origin").alias("origins"))


@query("parents", "members", sql=f"WITH RECURSIVE {CHAIN} SELECT DISTINCT c.ancestor AS class, m.member FROM chain c JOIN {{members}} m ON m.class = c.child WHERE c.depth > 0")
def descendant_member(parents, members):
    return v.in_descendants(v.closure(parents), members)


@query("accesses", "parents", "members", "nation", sql=f"""WITH RECURSIVE {CHAIN} SELECT access, class, member FROM {{accesses}} a WHERE member NOT IN (SELECT 'm' || (n_nationkey * 3 + 1)::VARCHAR FROM {{nation}})
AND NOT EXISTS (SELECT 1 FROM chain c JOIN {{members}} m ON m.class = c.ancestor WHERE c.child = a.class AND m.member = a.member) AND NOT EXISTS (SELECT 1 FROM chain c JOIN {{members}} m ON m.class = c.child WHERE c.ancestor = a.class AND m.member = a.member AND c.depth > 0)""")
def unknown_members(accesses, parents, members, nation):
    project = nation.select(F.concat(F.lit("m"), (F.col("n_nationkey") * 3 + 1).cast("string")).alias("member"))
    return v.unknown_members(accesses, v.closure(parents), members, project)


@query("lineitem", "part", sql="SELECT l_orderkey AS call, p_partkey AS name, l_linenumber AS given, l_suppkey AS line FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_linenumber < p_size % 4 OR (p_size % 5 <> 0 AND l_linenumber > p_size % 4 + 2)")
def arity_check(lineitem, part):
    calls = lineitem.select(F.struct("l_orderkey", "l_suppkey").alias("call"), F.col("l_partkey").alias("name"), F.col("l_linenumber").alias("given"))
    least = F.col("p_size") % 4
    signatures = part.select(F.col("p_partkey").alias("name"), least.alias("least"), F.when(F.col("p_size") % 5 != 0, least + 2).alias("most"))
    return v.arity(calls, signatures).select(F.col("call.l_orderkey").alias("call"), "name", "given", F.col("call.l_suppkey").alias("line"))


HREF = r'href="/([^"/?#]+)'
view("hosts", "SELECT page_id AS src, html AS text FROM {pages}")
EDGES = f"edges AS (SELECT DISTINCT src, unnest(regexp_extract_all(text, '{HREF}', 1)) AS dst FROM {{hosts}})"


@query("hosts", sql=f"WITH {EDGES} SELECT * FROM edges")
def resolve_references(hosts):
    return v.links(hosts, HREF)


FOLDER = "lower(substring({}, 1, 1))"


@query("hosts", sql=f"""WITH {EDGES}, f AS (SELECT src, dst, chr(97 + (src % 6)::INT) AS from_folder, {FOLDER.format("dst")} AS to_folder FROM edges)
SELECT * FROM f WHERE from_folder <> to_folder AND NOT ((from_folder = 'a' AND to_folder IN ('t', 'b')) OR (from_folder = 'b' AND to_folder = 't') OR (from_folder = 'c' AND to_folder IN ('e', 'd')))""")
def forbidden_dependencies(hosts):
    edges = v.links(hosts, HREF).withColumn("from_folder", F.substring(F.lit("abcdef"), (F.col("src") % 6 + 1).cast("int"), F.lit(1))).withColumn("to_folder", F.lower(F.substring("dst", 1, 1)))
    allowed = hosts.sparkSession.createDataFrame([("a", "t"), ("a", "b"), ("b", "t"), ("c", "e"), ("c", "d")], "from_folder string, to_folder string")
    return v.forbidden(edges, allowed)


@query("orders", sql="""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS src, o_orderkey % 1500 AS dst FROM {orders}), r AS (SELECT 3::BIGINT AS node UNION SELECT e.dst FROM r JOIN e ON r.node = e.src) SELECT node FROM r""")
def reachable_files(orders):
    edges = orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 1500).alias("dst")).distinct()
    return v.reachable(edges, orders.sparkSession.range(3, 4).select(F.col("id").alias("node"))).select("node")


@query("part", sql=r"""SELECT p_partkey, regexp_matches(replace(p_name, ' ', '_'), '^[a-z0-9_]+\z') AS stem_ok, lower(regexp_replace(regexp_replace(regexp_replace(c, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '[^A-Za-z0-9]+', '_', 'g')) AS snake
FROM (SELECT *, upper(substring(p_name, 1, 1)) || replace(substring(p_name, 2), ' ', 'X') || p_brand AS c FROM {part})""")
def naming_check(part):
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.replace(F.expr("substring(p_name, 2)"), F.lit(" "), F.lit("X")), "p_brand")
    return part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).rlike(r"^[a-z0-9_]+\z").alias("stem_ok"), v.snake(name).alias("snake"))


@query("pages", sql=r"""SELECT page_id, CASE WHEN folder = '' THEN 'root' WHEN folder NOT IN ('en', 'fr', 'de') THEN 'outside the plan' WHEN folder = 'de' AND contains(url, '?') THEN 'code in a data folder' ELSE 'ok' END AS status FROM (SELECT *, regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS folder FROM {pages})""")
def placement_check(pages):
    folder = F.regexp_extract("url", r"^https?://[^/]+/([^/?#]*)", 1)
    status = F.when(folder == "", "root").when(~folder.isin("en", "fr", "de"), "outside the plan").when((folder == "de") & F.col("url").contains("?"), "code in a data folder").otherwise("ok")
    return pages.select("page_id", status.alias("status"))


view("old_settings", "SELECT p_partkey AS node, 'size' AS name, CAST(p_size AS varchar(9)) AS value FROM {part} WHERE p_partkey % 11 <> 0 UNION ALL SELECT p_partkey, 'brand', p_brand FROM {part}")
view("new_settings", "SELECT p_partkey AS node, 'size' AS name, CAST(CASE WHEN p_partkey % 13 = 0 THEN p_size + 1 ELSE p_size END AS varchar(9)) AS value FROM {part} UNION ALL SELECT p_partkey, 'brand', p_brand FROM {part} WHERE p_partkey % 17 <> 0")


@query("old_settings", "new_settings", sql="""SELECT coalesce(a.node, b.node) AS node, coalesce(a.name, b.name) AS name, a.value AS old, b.value AS new, CASE WHEN a.node IS NULL THEN 'added' WHEN b.node IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM {old_settings} a FULL JOIN {new_settings} b ON a.node = b.node AND a.name = b.name WHERE a.value IS DISTINCT FROM b.value""")
def settings_diff(old, new):
    return v.settings_diff(old, new, ["node"])


view("frames", "SELECT CAST(ts AS date) AS day, event_type, user_id % 2 AS side, count(*) AS n FROM {events} GROUP BY 1, 2, 3")


@query("frames", sql="""WITH d AS (SELECT day, event_type, sum(n) FILTER (side = 0) AS a, sum(n) FILTER (side = 1) AS b FROM {frames} GROUP BY ALL)
SELECT day::VARCHAR AS day, coalesce(array_to_string((array_agg(event_type ORDER BY event_type) FILTER (a IS DISTINCT FROM b))[1:4], ','), '') AS differing, bool_or(a IS NULL OR b IS NULL) AS missing FROM d GROUP BY day""")
def signature_diff(frames):
    """Per frame (day) the kinds whose counts differ between two sides, the first four by name."""
    side = lambda k: F.sum(F.when(F.col("side") == k, F.col("n")))
    d = frames.groupBy("day", "event_type").agg(side(0).alias("a"), side(1).alias("b"))
    names = F.sort_array(F.collect_list(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("event_type"))))
    return d.groupBy(F.col("day").cast("string").alias("day")).agg(F.array_join(F.slice(names, 1, 4), ",").alias("differing"), F.bool_or(F.col("a").isNull() | F.col("b").isNull()).alias("missing"))


@query("lineitem", sql="""WITH w AS (SELECT l_suppkey, greatest(l_partkey - 3, 1) AS lo, least(l_partkey + l_linenumber + 3, 2000) AS hi FROM {lineitem}),
i AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 2 THEN 1 ELSE 0 END AS n FROM w),
g AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM i) SELECT l_suppkey, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY l_suppkey, island""")
def merge_ranges(lineitem):
    ranges = lineitem.select("l_suppkey", F.col("l_partkey").alias("lo"), (F.col("l_partkey") + F.col("l_linenumber")).alias("hi"))
    return v.merge_ranges(ranges, "l_suppkey", 3, 2, F.lit(2000))


@query("lineitem", "orders", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_linenumber BETWEEN o_custkey % 4 AND o_custkey % 4 + 1")
def mutants_in_changed_lines(lineitem, orders):
    """Mutants (file, line) whose line falls in a changed range of their file: an equi-join on the file, ranges as a filter."""
    changed = orders.select(F.col("o_orderkey").alias("file"), (F.col("o_custkey") % 4).alias("lo"), (F.col("o_custkey") % 4 + 1).alias("hi"))
    j = lineitem.join(changed, (F.col("l_orderkey") == F.col("file")) & F.col("l_linenumber").between(F.col("lo"), F.col("hi")))
    return j.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
