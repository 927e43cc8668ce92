"""API descriptions: nested documents of classes, flattened into the tables that name and signature queries read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a description, and the name of the scope that belongs to no class.
_ARGUMENTS = "array<struct<name:string,type:string,default_value:string>>"
_METHODS = f"array<struct<name:string,return_type:string,return_value:struct<type:string>,is_static:boolean,is_virtual:boolean,is_const:boolean,is_vararg:boolean,arguments:{_ARGUMENTS}>>"
_CONSTANTS = "array<struct<name:string,type:string,value:string>>"
_ENUMS = "array<struct<name:string,is_bitfield:boolean,values:array<struct<name:string,value:bigint>>>>"
_PROPERTIES = "array<struct<name:string,type:string,setter:string,getter:string>>"
HEADER = ("version_major", "version_minor", "version_patch", "version_status", "version_full_name")
SCHEMA = (
    f"header struct<{','.join(f'{k}:string' for k in HEADER)}>, "
    f"classes array<struct<name:string,inherits:string,api_type:string,is_instantiable:boolean,is_refcounted:boolean,methods:{_METHODS},signals:array<struct<name:string,arguments:{_ARGUMENTS}>>,properties:{_PROPERTIES},constants:{_CONSTANTS},enums:{_ENUMS}>>, "
    f"builtin_classes array<struct<name:string,methods:{_METHODS},members:{_PROPERTIES},constants:{_CONSTANTS},enums:{_ENUMS}>>, "
    f"global_enums {_ENUMS}, global_constants {_CONSTANTS}, utility_functions {_METHODS}, singletons {_PROPERTIES}"
)
GLOBAL = "@GlobalScope"
SIGNALS = f"array<struct<name:string,arguments:{_ARGUMENTS}>>"


def _owner(name: Column, **fields: Column) -> Column:
    """One shape for classes, built-in classes and the global scope."""
    kinds = {
        "parent": "string", "kind": "string", "api_type": "string", "instantiable": "int", "refcounted": "int",
        "methods": _METHODS, "signals": SIGNALS, "properties": _PROPERTIES, "constants": _CONSTANTS, "enums": _ENUMS,
    }
    return F.struct(name.alias("name"), *(fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def _owners(parsed: DataFrame) -> DataFrame:
    """Rows (api, at, o): every owner of members, ``at`` its place: classes, then built-in classes, then the global scope."""
    integers = lambda c: F.transform(c, lambda k: k.withField("type", F.lit("int")))
    class_of = lambda c: _owner(c["name"], parent=c["inherits"], kind=F.lit("class"), api_type=c["api_type"], instantiable=_flag(c["is_instantiable"]), refcounted=_flag(c["is_refcounted"]), methods=F.transform(c["methods"], lambda m: m.withField("return_type", m["return_value"]["type"])), signals=c["signals"], properties=c["properties"], constants=integers(c["constants"]), enums=c["enums"])
    plain = lambda p: F.transform(p, lambda x: x.withField("setter", F.lit(None).cast("string")).withField("getter", F.lit(None).cast("string")))
    builtin = lambda c: _owner(c["name"], kind=F.lit("builtin"), api_type=F.lit("core"), instantiable=F.lit(1), refcounted=F.lit(0), methods=c["methods"], properties=plain(c["members"]), constants=c["constants"], enums=c["enums"])
    scope = _owner(F.lit(GLOBAL), kind=F.lit("global"), api_type=F.lit("core"), instantiable=F.lit(0), refcounted=F.lit(0), methods=F.col("d.utility_functions"), properties=plain(F.col("d.singletons")), constants=integers(F.col("d.global_constants")), enums=F.col("d.global_enums"))
    every = lambda c, f: F.transform(F.coalesce(c, F.array().cast(parsed.select(c).schema[0].dataType)), f)
    listed = F.concat(every(F.col("d.classes"), class_of), every(F.col("d.builtin_classes"), builtin), F.array(scope))
    return parsed.filter("d IS NOT NULL").select("api", F.posexplode(listed).alias("at", "o"))


def _last(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row for each key, the last by ``order``: a maximum of structs, so repeated keys combine before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x"))
    return best.select(*keys, *(F.col(f"x.{c}").alias(c) for c in rest))


def flatten_api(docs: DataFrame) -> dict[str, DataFrame]:
    """Ten tables of the descriptions (api, document), ``document`` being JSON text.

    meta (key, value), classes, methods, arguments, signals, signal_arguments, properties, constants, enums and enum_values, each
    with its api. Of repeated keys the last stands, as it would be read; a class comes after classes before it, built-in classes
    after all classes, the global scope last. Names that are missing are null; an argument is required if it has no default.
    Unreadable documents have no rows but empty values in meta; so do nulls.
    """
    parsed = docs.select("api", F.from_json("document", SCHEMA).alias("d"))
    entry = lambda k: F.struct(F.lit(k).alias("key"), F.coalesce(F.col(f"d.header.{k}"), F.lit("")).alias("value"))
    version = F.concat_ws(".", *(F.coalesce(F.col(f"d.header.{k}"), F.lit("?")) for k in HEADER[:3]))
    meta = parsed.select("api", F.inline(F.array(*map(entry, HEADER), F.struct(F.lit("version").alias("key"), version.alias("value")))))

    owners = _owners(parsed)
    own = owners.select("api", "at", F.col("o.name").alias("class"), "o.methods", "o.signals", "o.properties", "o.constants", "o.enums")
    each = lambda column: own.select("api", "class", "at", F.posexplode(column).alias("pos", "m"))
    below = lambda rows, column, name: rows.select("api", "class", F.col("m.name").alias(name), "at", "pos", F.posexplode(column).alias("position", "a"))
    methods, signals, enums = each("methods"), each("signals"), each("enums")
    arguments = F.coalesce("m.arguments", F.array().cast(_ARGUMENTS))
    required = F.size(F.filter(arguments, lambda a: a["default_value"].isNull()))
    order = ("at", "pos")
    return {
        "meta": meta,
        "classes": _last(owners.select("api", F.col("o.name").alias("name"), "at", "o.parent", "o.kind", "o.api_type", "o.instantiable", "o.refcounted"), ("api", "name"), ("at",)),
        "methods": _last(
            methods.select("api", "class", F.col("m.name").alias("name"), *order, F.col("m.return_type").alias("returns"), *(_flag(F.col(f"m.is_{k}")).alias(k) for k in ("static", "virtual", "const", "vararg")), F.size(arguments).alias("arguments"), required.alias("required")),
            ("api", "class", "name"), order,
        ),
        "arguments": _last(
            below(methods, "m.arguments", "method").select("api", "class", "method", "position", *order, "a.name", "a.type", F.col("a.default_value").alias("default")),
            ("api", "class", "method", "position"), order,
        ),
        "signals": _last(signals.select("api", "class", F.col("m.name").alias("name"), *order, F.size(arguments).alias("arguments")), ("api", "class", "name"), order),
        "signal_arguments": _last(
            below(signals, "m.arguments", "signal").select("api", "class", "signal", "position", *order, "a.name", "a.type"), ("api", "class", "signal", "position"), order
        ),
        "properties": _last(each("properties").select("api", "class", "m.name", *order, "m.type", "m.setter", "m.getter"), ("api", "class", "name"), order),
        "constants": _last(each("constants").select("api", "class", "m.name", *order, "m.type", "m.value"), ("api", "class", "name"), order),
        "enums": _last(enums.select("api", "class", "m.name", *order, _flag(F.col("m.is_bitfield")).alias("bitfield")), ("api", "class", "name"), order),
        "enum_values": _last(
            below(enums, "m.values", "enum").select("api", "class", "enum", F.col("a.name").alias("name"), *order, "position", F.col("a.value").alias("value")),
            ("api", "class", "enum", "name"), (*order, "position"),
        ),
    }
