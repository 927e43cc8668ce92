"""Near names against the standard library's matcher: first letters that differ, ties, one block and many, within a class."""

from __future__ import annotations

from difflib import get_close_matches

import pytest

from millrace.operators import admission
from millrace.operators.names import close_names

KNOWN = ["process", "_process", "progress", "ready", "_ready", "Ready", "a", "b", "", "physics_process", "process", "axbxc", "set_text", "get_text", "text_set", "tset_ext"]
ASKED = ["_process", "proces", "xrocess", "ready", "c", "_physics_process", "nothing", "", "aybyc", "set_test", "ext_set"]


def frame(spark, rows, schema="name string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(("block", "ratio"), [(2000, 0.6), (3, 0.6), (2000, 0.7)])
def test_close_names(spark, block, ratio):
    want = {q: get_close_matches(q, set(KNOWN) - {q}, 3, ratio) for q in ASKED}
    both = [frame(spark, [(n,) for n in [*names, None]]) for names in (ASKED, KNOWN)]
    got: dict = {q: [] for q in ASKED}
    for r in sorted(close_names(*both, ratio=ratio, block=block).collect(), key=lambda r: r["rank"]):
        got[r["query"]].append(r["id"])
        assert r["score"] >= ratio and r["rank"] == len(got[r["query"]])
    assert got == want
    assert want["xrocess"][0] == "process" and (ratio > 0.6 or want["aybyc"] == ["axbxc"])


def test_close_names_within_a_class(spark):
    asked = frame(spark, [("A", "proces"), ("B", "proces"), ("C", "proces"), ("A", "proces")], "class string, name string")
    known = frame(spark, [("A", "process"), ("A", "progress"), ("B", "ready"), (None, "proces"), ("B", None)], "class string, name string")
    near = close_names(asked, known, within=["class"])
    assert sorted((r["class"], r["query"], r["rank"], r["id"]) for r in near.collect()) == [("A", "proces", 1, "process"), ("A", "proces", 2, "progress")]
    assert "NestedLoop" not in near._jdf.queryExecution().executedPlan().toString()
    assert close_names(asked.limit(0), known, within=["class"]).count() == 0


def test_types_with_near_names(spark):
    unknown = frame(spark, [(1, 3, "Nodd2D"), (2, 9, "Nodd2D"), (2, 1, "Zzz")], "id long, line int, name string")
    known = frame(spark, [("Node2D",), ("Node3D",), ("Label",), (None,)])
    got = sorted(map(tuple, admission.with_near_types(unknown, known).collect()))
    assert got == [(1, 3, "Nodd2D", "Node2D"), (2, 1, "Zzz", None), (2, 9, "Nodd2D", "Node2D")]
