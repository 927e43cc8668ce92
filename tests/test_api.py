"""API descriptions: a nested document with repeated names, missing fields, and documents that can't be read."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace.sources.api import flatten_api

DOC = {
    "header": {"version_major": 4, "version_minor": 7},
    "classes": [
        {"name": "Node", "api_type": "core", "is_instantiable": True, "methods": [
            {"name": "add", "arguments": [{"name": "a", "type": "int"}, {"name": "b", "type": "int", "default_value": "0"}], "return_value": {"type": "bool"}},
            {"name": "add", "is_static": True, "arguments": [{"name": "c"}]}],
         "signals": [{"name": "done"}, {"name": "hit", "arguments": [{"name": "by", "type": "Node"}]}],
         "properties": [{"name": "pos", "type": "V", "setter": "set_pos"}], "constants": [{"name": "K", "value": 3}, {"name": "K", "value": 4}],
         "enums": [{"name": "Mode", "values": [{"name": "A", "value": 0}, {"name": "B", "value": 2}, {"name": "A", "value": 9}]}]},
        {"name": "V", "inherits": "Node"}],
    "builtin_classes": [{"name": "V", "methods": [{"name": "len", "return_type": "float"}], "members": [{"name": "x", "type": "float", "setter": "no"}], "constants": [{"name": "ONE", "type": "V", "value": "V(1)"}]}],
    "global_constants": [{"name": "G", "value": 7}], "utility_functions": [{"name": "sin", "return_type": "float", "is_vararg": True}],
    "singletons": [{"name": "Input", "type": "Input"}], "global_enums": [{"name": "Side", "is_bitfield": True, "values": []}],
}


def tables(spark, rows):
    docs = spark.createDataFrame(rows, "api string, document string").withColumn("at", F.lit(1)).withColumn("d", F.lit(1))
    return {k: sorted((tuple(r) for r in v.collect()), key=str) for k, v in flatten_api(docs).items()}


def test_flatten_api(spark):
    got = tables(spark, [("x", json.dumps(DOC))])
    assert dict(r[1:] for r in got["meta"]) == {"version_major": "4", "version_minor": "7", "version_patch": "", "version_status": "", "version_full_name": "", "version": "4.7.?"}
    assert got["classes"] == [("x", "@GlobalScope", None, "global", "core", 0, 0), ("x", "Node", None, "class", "core", 1, 0), ("x", "V", None, "builtin", "core", 1, 0)]
    assert got["methods"] == [("x", "@GlobalScope", "sin", "float", 0, 0, 0, 1, 0, 0), ("x", "Node", "add", None, 1, 0, 0, 0, 1, 1), ("x", "V", "len", "float", 0, 0, 0, 0, 0, 0)]
    assert got["arguments"] == [("x", "Node", "add", 0, "c", None, None), ("x", "Node", "add", 1, "b", "int", "0")]
    assert got["signals"] == [("x", "Node", "done", 0), ("x", "Node", "hit", 1)] and got["signal_arguments"] == [("x", "Node", "hit", 0, "by", "Node")]
    assert got["properties"] == [("x", "@GlobalScope", "Input", "Input", None, None), ("x", "Node", "pos", "V", "set_pos", None), ("x", "V", "x", "float", None, None)]
    assert got["constants"] == [("x", "@GlobalScope", "G", "int", "7"), ("x", "Node", "K", "int", "4"), ("x", "V", "ONE", "V", "V(1)")]
    assert got["enums"] == [("x", "@GlobalScope", "Side", 1), ("x", "Node", "Mode", 0)]
    assert got["enum_values"] == [("x", "Node", "Mode", "A", 9), ("x", "Node", "Mode", "B", 2)]


def test_unreadable_documents(spark):
    got = tables(spark, [("a", None), ("b", "{"), ("c", "{}")])
    assert len(got["meta"]) == 18 and [r[:2] for r in got["classes"] if r[0] == "c"] == [("c", "@GlobalScope")]
    assert not got["methods"] and not got["enum_values"]
    assert all(not v for v in tables(spark, []).values())
