"""Whole inputs: deep chains, long openings, words anywhere in a passage, more queries than one pass takes."""

from __future__ import annotations

import numpy as np

from millrace.operators import retrieval, vocabulary
from millrace.plans import load

REGISTRY = load()


def test_closure_and_reachable_have_no_last_step(spark):
    n = 131
    parents = spark.createDataFrame([(i, i - 1 if i else None) for i in range(n)], "child long, parent long")
    assert vocabulary.closure(parents).filter(f"child = {n - 1}").count() == n
    edges = spark.createDataFrame([(i, i + 1) for i in range(66)], "src long, dst long")
    got = {r["node"]: r["steps"] for r in vocabulary.reachable(edges, spark.range(1).select("id").withColumnRenamed("id", "node")).collect()}
    assert got == {i: i for i in range(67)}


def test_exact_words_anywhere_in_a_passage(spark, tmp_path):
    spark.createDataFrame([(0, "zz  yy"), (1, "aa bb target"), (2, "cc target")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, "target  qq")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = REGISTRY.QUERIES["hybrid_search"](spark, str(tmp_path)).collect()
    assert [(r["query"], r["place"], r["id"]) for r in got if r["found_by"] == "exact"] == [(4, 1, 1)]


def test_more_queries_than_one_pass(spark, monkeypatch):
    m = np.random.default_rng(3).normal(size=(60, 4))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, vector array<double>")
    monkeypatch.setattr(retrieval, "MAX_QUERIES", 20)
    got = {(r["query"], r["rank"]): r["id"] for r in retrieval.neighbours(vectors, vectors.withColumnRenamed("id", "query"), 3).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = np.round(unit @ unit.T, 6)
    assert got == {(q, k + 1): i for q in range(60) for k, i in enumerate(np.lexsort((np.arange(60), -near[q]))[:3])}


def test_long_openings_are_told_apart(spark, tmp_path):
    talks = [(1, 0, "user", "a" * 50 + "x"), (2, 0, "user", "a" * 50 + "y"), (2, 1, "assistant", "b"), (2, 2, "user", "c")]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = REGISTRY.QUERIES["stitch_sessions"](spark, str(tmp_path)).collect()
    assert sorted((r["exchanges"], r["messages"]) for r in got) == [(1, 1), (2, 3)]


def test_live_table_goes_on_after_a_restart(spark, tmp_path):
    from millrace.streaming.capture import live_table

    source, folder = f"{tmp_path}/in", f"file://{tmp_path}/table"
    for key, value in ((1, 10), (2, 20), (1, 11)):
        spark.createDataFrame([(key, value)], "key long, value long").coalesce(1).write.mode("append").parquet(source)
        out = live_table(spark.readStream.schema("key long, value long").parquet(source), folder, ["key"], ["value"])
    assert sorted(map(tuple, out.collect())) == [(1, 11), (2, 20)]


SF = "/root/testdata/sf0.001"


def test_sessions_of_all_conversations_against_one_list(spark):
    """The rule over all exchanges in order, without keys: the longest shared opening, then the same system text, then the last opened."""
    from millrace.plans import registry
    from millrace.streaming import capture

    exchanges = capture.accepted(registry.read(spark, SF, "exchanges")).collect()
    sessions: list[dict] = []
    for x in sorted(exchanges, key=lambda x: x["ts"]):
        said = [(m["role"], m["content"]) for m in x["request"]]
        talk, system = [m for m in said if m[0] != "system"], [m for m in said if m[0] == "system"]
        fits = []
        for i, s in enumerate(sessions):
            shared = next((k for k, (a, b) in enumerate(zip(talk, s["talk"], strict=False)) if a != b), min(len(talk), len(s["talk"])))
            if shared and len(talk) > len(s["talk"]):
                fits.append((shared, s["system"] == system, i))
        if fits:
            old = sessions[max(fits)[2]]
            old.update(talk=talk, system=system, last=x["ts"], n=old["n"] + 1)
        else:
            sessions.append({"talk": talk, "system": system, "first": x["ts"], "last": x["ts"], "n": 1})
    got = REGISTRY.QUERIES["stitch_sessions"](spark, SF).collect()
    assert sorted((r["first"], r["last"], r["exchanges"], r["messages"]) for r in got) == sorted((float(s["first"]), float(s["last"]), s["n"], len(s["talk"])) for s in sessions)


def test_edits_and_zones_of_all_documents(spark):
    from millrace.operators import corpus, edits
    from millrace.plans import registry

    pairs = {r["id"]: r for r in registry.read(spark, SF, "revised").select("id", "before", "after", corpus.tokens("before").alias("a"), corpus.tokens("after").alias("b")).collect()}
    steps: dict = {}
    for r in sorted(REGISTRY.QUERIES["unique_edits"](spark, SF).collect(), key=lambda r: r["step"]):
        steps.setdefault(r["id"], []).append((r["old"], r["new"]))
    assert set(steps) == {k for k, r in pairs.items() if r["before"] != r["after"]}
    assert all(edits.replay(pairs[k]["before"], s) == (pairs[k]["after"], None) for k, s in steps.items())
    zones: dict = {}
    for r in REGISTRY.QUERIES["answer_zones"](spark, SF).collect():
        zones.setdefault(r["id"], []).append(r["text"])
    changed = {k: r for k, r in pairs.items() if r["a"] != r["b"]}
    for k, r in changed.items():
        text, old = " ".join(r["b"]), set(r["a"])
        assert all(z in text for z in zones.get(k, [])) and all(any(w in z.split(" ") for z in zones[k]) for w in set(r["b"]) - old)
    signed = {r["id"]: r for r in REGISTRY.QUERIES["task_signature"](spark, SF).collect()}
    assert set(signed) == set(changed) and all(r["answer_shingles"] > 0 for k, r in signed.items() if zones.get(k))


def test_frozen_tasks_among_the_chosen_are_an_error(spark):
    import pytest

    from millrace.operators import rounds

    tasks = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "skill string, task long")
    frozen = spark.createDataFrame([(2,)], "task long")
    with pytest.raises(ValueError, match="frozen"):
        rounds.select_tasks(tasks, ["a"], 1, frozen)
    assert [r["task"] for r in rounds.select_tasks(tasks, ["b"], 1, frozen).collect()] == [3]


def test_closure_of_asked_classes(spark):
    parents = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "child string, parent string")
    asked = spark.createDataFrame([("c",), ("x",), ("nowhere",)], "child string")
    got = sorted(map(tuple, vocabulary.closure_of(parents, asked).collect()))
    assert got == [("c", "a", 2), ("c", "b", 1), ("c", "c", 0), ("x", "x", 0), ("x", "y", 1)]
