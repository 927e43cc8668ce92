"""Set joins against all pairs, result files with broken lines, rendered conversations, and the budget's moving mean."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import admission, corpus, messages
from millrace.sources import folders


def shingle_sets(spark, rows, key):
    df = spark.createDataFrame([(r[key], r[-1]) for r in rows], "k long, text string")
    return {r["k"]: set(r["s"]) for r in df.select("k", corpus.shingles("text").alias("s")).collect()}


@pytest.fixture(scope="module")
def near_texts():
    rng, rows = random.Random(11), []
    base = [[rng.choice("abcdefghij") for _ in range(40)] for _ in range(8)]
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice("xyz")
        rows.append((i, rng.choice(["en", "en", "fr"]), " ".join(words)))
    return [*rows, (200, "en", None), (201, "en", ""), (202, "en", "one"), (203, "en", "common line " * 60), (204, "en", "common line " * 61)]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_near_index_is_the_join_of_all_pairs(spark, near_texts, threshold):
    frozen = [(i + 1000, g, i % 7, t) for i, g, t in near_texts if i % 3 == 0]
    candidates = [r for r in near_texts if r[0] % 3]
    c = spark.createDataFrame(candidates, "id long, grp string, text string").withColumn("size", F.lit(1)).repartition(3)
    f = spark.createDataFrame(frozen, "id long, grp string, position long, text string").withColumn("df", F.lit(1))
    got = {r["id"]: (r["match"], r["reason"]) for r in corpus.near_index(c, f, threshold).collect()}
    a, b = shingle_sets(spark, candidates, 0), shingle_sets(spark, frozen, 0)
    want = {}
    for i, g, t in candidates:
        same = [(p, m) for m, _, p, x in frozen if (x or "") == (t or "")]
        near = [(p, m) for m, h, p, x in frozen if h == g and a[i] and b[m] and len(a[i] & b[m]) >= threshold * len(a[i] | b[m])]
        if same:
            want[i] = (max(same)[1], "same_hash")
        elif near:
            want[i] = (min(near)[1], "shingles")
    assert got == want and len(got) > 10
    assert corpus.near_index(c.limit(0), f).count() == 0 and corpus.near_index(c, f.limit(0)).count() == 0


def test_protected_hits_beyond_what_is_sent(spark, near_texts, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, _, t in near_texts], "id long, text string")
    protected = spark.createDataFrame([(f"t{i}", i, "answer", t) for i, _, t in near_texts if i % 10 == 0], "item string, position long, side string, text string")
    sent = sorted(map(tuple, corpus.protected_hits(docs, protected).collect()))
    monkeypatch.setattr(corpus, "SENT", 0)
    assert sent == sorted(map(tuple, corpus.protected_hits(docs, protected).collect())) and len(sent) > 10


def test_result_files(spark, tmp_path):
    line = lambda **x: json.dumps({"configuration": "base", "tache_id": "t1", "ok": True} | x)
    (tmp_path / "a.jsonl").write_text("\n".join([line(ok=False, tour="r1"), "", line(tour="r1"), line(tache_id="t2", ok=False), "not json", line(configuration=None), '{"configuration": "base"}']) + "\n")
    (tmp_path / "b.jsonl").write_text(line(tour="r1", etape="tests", ok=False) + "\n" + line(tour="r1")[:-4])
    got = sorted(map(tuple, folders.read_results(spark, f"file://{tmp_path}").select("tour", "configuration", "tache_id", "ok", "etape").collect()))
    assert got == [("", "base", "t2", False, None), ("r1", "base", "t1", False, "tests")]


def test_rendered_conversations(spark):
    rows = [
        (1, 0, "system", "s1", None), (1, 1, "user", "u", None), (1, 2, "assistant", "a", "call"), (1, 3, "tool", "x", None), (1, 4, "tool", "y", None), (1, 5, "assistant", "b", None),
        (2, 0, "user", "u", None), (2, 1, "user", "v", None), (2, 2, "assistant", "a", None), (3, 0, "system", "s", None), (3, 1, "system", "t", None), (3, 2, "user", "u", None), (3, 3, "assistant", "a", None),
        (4, 0, "user", "u", None), (5, 0, "system", "only", None), (6, 0, "user", "u", None), (6, 1, "assistant", "a", None), (6, 2, "system", "late", None), (6, 3, "assistant", "b", None),
    ]
    chat = spark.createDataFrame(rows, "session long, pos long, role string, content string, tool string")
    got = {r["session"]: r for r in messages.sharegpt_rendered(chat).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("human", "u"), ("gpt", "a\n<tool_call>call</tool_call>"), ("human", "<tool_response>\nx\n</tool_response>\n<tool_response>\ny\n</tool_response>"), ("gpt", "b")]
    assert {k: (r["system"], r["valid"], r["same"]) for k, r in got.items()} == {1: ("s1", True, True), 2: ("", False, True), 3: ("s\nt", True, False), 4: ("", False, True), 5: ("only", False, True), 6: ("", False, True)}


def test_budget_by_the_moving_mean(spark):
    import hashlib

    rng = random.Random(9)
    rows = [(g, i, i, rng.randint(100, 4000)) for g in range(12) for i in range(g * 40, g * 40 + rng.randint(1, 40))]
    targets = [(g, rng.choice([0, 500, 9000, 30_000, 10**6])) for g in range(12)]
    got = {}
    for r in admission.balanced_until_budget(spark.createDataFrame(rows, "grp long, place long, id long, size long"), spark.createDataFrame(targets, "grp long, target long"), most=25).collect():
        got.setdefault(r["grp"], set()).add(r["id"])
    for g, target in targets:
        taken, total, mean = [], 0, 1500.0
        for _, i, size in sorted((hashlib.sha256(str(i).encode()).hexdigest(), i, n) for x, _, i, n in rows if x == g):
            if taken and (len(taken) >= 25 or total + mean / 2 >= target):
                break
            taken.append((i, size))
            total += size
            mean = sum(n for _, n in taken[1:]) / (len(taken) - 1) if len(taken) > 1 else 1500.0
        assert got[g] == {i for i, _ in taken}
