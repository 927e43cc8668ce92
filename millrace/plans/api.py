"""Queries of the tables of API descriptions, made of all suppliers (classes) and all parts (members)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import registry
from millrace.sources import api

#: Classes of a description, and which of them are built in.
CLASSES, BUILTIN = 20, 16


def described(supplier, owned):
    """Descriptions (api, document) of 20 suppliers each; a part is a member of each kind of one class, and names repeat."""
    numbered = lambda size, f: F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda j: j < size), f)
    argument = lambda j: F.struct(F.concat(F.lit("a"), j.cast("string")).alias("name"), F.when(j != 1, F.col("p_type")).alias("type"), F.when(j >= 2, F.col("p_name")).alias("default_value"))
    arguments = numbered(F.col("p_size") % 4, argument)
    name = lambda prefix, k: F.concat(F.lit(prefix), (F.col("p_partkey") % k).cast("string")).alias("name")
    method = F.struct(name("m", 31), F.col("p_brand").alias("return_type"), F.struct(F.col("p_brand").alias("type")).alias("return_value"), (F.col("p_size") > 25).alias("is_static"), F.when(F.col("p_size") > 10, F.col("p_size") > 40).alias("is_virtual"), F.when(F.col("p_size") > 45, True).alias("is_const"), arguments.alias("arguments"))
    signal = F.struct(name("s", 17), arguments.alias("arguments"))
    prop = F.struct(name("p", 41), F.col("p_type").alias("type"), F.col("p_name").alias("setter"), F.when(F.col("p_size") > 9, F.col("p_brand")).alias("getter"))
    constant = F.struct(name("c", 11), F.lit("float").alias("type"), F.col("p_size").alias("value"))
    value = lambda j: F.struct(F.concat(F.lit("v"), ((F.col("p_size") + j) % 3).cast("string")).alias("name"), (F.col("p_partkey") + j).alias("value"))
    enum = F.struct(name("e", 7), F.when(F.col("p_size") > 20, True).alias("is_bitfield"), numbered(F.lit(4), value).alias("values"))
    ordered = lambda x: F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", x.alias("x")))), lambda y: y["x"])
    kinds = {"methods": method, "signals": signal, "properties": prop, "constants": constant, "enums": enum}
    members = owned.groupBy("owner").agg(*(ordered(x).alias(k) for k, x in kinds.items()))
    s = supplier.join(members, F.col("s_suppkey") == F.col("owner"), "left").withColumn("api", F.floor(F.col("s_suppkey") / CLASSES))
    place = F.col("s_suppkey") % CLASSES
    named = F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("name")
    of_class = F.struct(named, F.when(place > 0, F.concat(F.lit("C"), (F.col("s_suppkey") - 1).cast("string"))).alias("inherits"), F.when(F.col("s_nationkey") % 2 == 0, F.lit("core")).alias("api_type"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_acctbal") > 0).alias("is_instantiable"), F.when(F.col("s_acctbal") > 5000, True).alias("is_refcounted"), *kinds)
    builtin = F.struct(named, "methods", F.col("properties").alias("members"), "constants", "enums")
    at = lambda x, test: F.transform(F.sort_array(F.collect_list(F.when(test, F.struct("s_suppkey", x.alias("x"))))), lambda y: y["x"])
    last = place == CLASSES - 1
    first = lambda column: F.flatten(at(F.col(column), last))
    whole = s.groupBy("api").agg(
        F.struct(F.lit(4).alias("version_major"), F.col("api").alias("version_minor"), F.when(F.col("api") % 2 == 0, F.lit(1)).alias("version_patch"), F.lit("stable").alias("version_status")).alias("header"),
        at(of_class, place < BUILTIN).alias("classes"), at(builtin, (place >= BUILTIN) & ~last).alias("builtin_classes"),
        first("methods").alias("utility_functions"), first("properties").alias("singletons"), first("constants").alias("global_constants"), first("enums").alias("global_enums"),
    )
    return whole.select("api", F.to_json(F.struct("header", "classes", "builtin_classes", "utility_functions", "singletons", "global_constants", "global_enums")).alias("document"))


# The same tables straight from suppliers and parts.
registry.view("api_owners", f"""
SELECT CAST(floor(s_suppkey / {CLASSES}) AS bigint) AS api, s_suppkey AS owner, CASE WHEN s_suppkey % {CLASSES} = {CLASSES - 1} THEN '{api.GLOBAL}' ELSE 'C' || CAST(s_suppkey AS varchar(20)) END AS class,
 CASE WHEN s_suppkey % {CLASSES} = {CLASSES - 1} THEN 'global' WHEN s_suppkey % {CLASSES} >= {BUILTIN} THEN 'builtin' ELSE 'class' END AS kind, s_suppkey, s_nationkey, s_acctbal FROM {{supplier}}
""")
registry.view("owned_parts", "SELECT p.*, p_partkey % (SELECT count(*) FROM {supplier}) AS owner FROM {part} p")
registry.view("api_members", "SELECT o.api, o.class, o.kind AS owned_by, p.* FROM {owned_parts} p JOIN {api_owners} o ON o.owner = p.owner")


def _last(keys: str, columns: str, rows: str, order: str = "p_partkey") -> str:
    return f"SELECT {keys}, {columns} FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order} DESC) = 1"


def _flag(test: str) -> str:
    return f"coalesce({test}, false)::INT"


NAMED = "SELECT api, class, owned_by, p_partkey, '{}' || (p_partkey % {}) AS name, p.* EXCLUDE (api, class, owned_by, p_partkey) FROM {{{{api_members}}}} p"
NUMBER = "SELECT *, unnest(range(p_size % 4)) AS position FROM ({})"
IN_CLASS = "WHERE owned_by = 'class'"


def _members(prefix: str, k: int) -> str:
    return NAMED.format(prefix, k).replace("{{", "{").replace("}}", "}")


SQL = {
    "meta": "SELECT api, unnest(['version_major', 'version_minor', 'version_patch', 'version_status', 'version_full_name', 'version']) AS key, unnest(['4', api::VARCHAR, CASE WHEN api % 2 = 0 THEN '1' ELSE '' END, 'stable', '', '4.' || api || '.' || CASE WHEN api % 2 = 0 THEN '1' ELSE '?' END]) AS value FROM (SELECT DISTINCT api FROM {api_owners})",
    "classes": f"""SELECT api, class AS name, CASE WHEN kind = 'class' AND owner % {CLASSES} > 0 THEN 'C' || (owner - 1) END AS parent, kind, CASE WHEN kind <> 'class' OR s_nationkey % 2 = 0 THEN 'core' END AS api_type,
 CASE kind WHEN 'class' THEN {_flag("owner % 3 > 0 AND s_acctbal > 0")} WHEN 'builtin' THEN 1 ELSE 0 END AS instantiable, CASE WHEN kind = 'class' THEN {_flag("s_acctbal > 5000")} ELSE 0 END AS refcounted FROM {{api_owners}}
 UNION ALL SELECT api, '{api.GLOBAL}', NULL, 'global', 'core', 0, 0 FROM {{api_owners}} GROUP BY api HAVING count(*) FILTER (kind = 'global') = 0""",
    "methods": _last("api, class, name", f"p_brand AS returns, {_flag('p_size > 25')} AS static, {_flag('p_size > 40')} AS virtual, {_flag('p_size > 45')} AS const, 0 AS vararg, (p_size % 4)::INT AS arguments, least(p_size % 4, 2)::INT AS required", _members("m", 31)),
    "arguments": _last("api, class, method, position", "'a' || position AS name, CASE WHEN position <> 1 THEN p_type END AS type, CASE WHEN position >= 2 THEN p_name END AS \"default\"", f"SELECT * EXCLUDE (position), position::INT AS position, name AS method FROM ({NUMBER.format(_members('m', 31))})"),
    "signals": _last("api, class, name", "(p_size % 4)::INT AS arguments", f"SELECT * FROM ({_members('s', 17)}) {IN_CLASS}"),
    "signal_arguments": _last("api, class, signal, position", "'a' || position AS name, CASE WHEN position <> 1 THEN p_type END AS type", f"SELECT * EXCLUDE (position), position::INT AS position, name AS signal FROM ({NUMBER.format(_members('s', 17))}) {IN_CLASS}"),
    "properties": _last("api, class, name", "p_type AS type, CASE WHEN owned_by = 'class' THEN p_name END AS setter, CASE WHEN owned_by = 'class' AND p_size > 9 THEN p_brand END AS getter", _members("p", 41)),
    "constants": _last("api, class, name", "CASE WHEN owned_by = 'builtin' THEN 'float' ELSE 'int' END AS type, p_size::VARCHAR AS value", _members("c", 11)),
    "enums": _last("api, class, name", f"{_flag('p_size > 20')} AS bitfield", _members("e", 7)),
    "enum_values": _last("api, class, enum, name", "(p_partkey + j)::BIGINT AS value", f"SELECT * EXCLUDE (name), name AS enum, 'v' || ((p_size + j) % 3) AS name FROM (SELECT *, unnest(range(4)) AS j FROM ({_members('e', 7)}))", "p_partkey DESC, j"),
}
for _name, _sql in SQL.items():
    registry.query("supplier", "owned_parts", name=f"flatten_api_{_name}", sql=_sql)(lambda supplier, owned, t=_name: api.flatten_api(described(supplier, owned))[t])
