"""The written index, names looked up through ancestors, and results filled stage by stage."""

from __future__ import annotations

import random
import re
from hashlib import md5

from pyspark.sql import functions as F

from millrace.operators import corpus, index
from millrace.operators import retrieval as r
from millrace.operators import vocabulary
from millrace.plans import load

LONG = "one two three four five six seven eight nine ten eleven twelve"
FRAGMENTS = [
    (1, "move the body", "text about speed", False), (2, "other", "move move move body", False), (3, None, None, True), (4, "leak", f"zz {LONG} yy", False),
    (5, "body", "move it", True), (6, "speed", "speed", False), (7, "", "", False),
]
PROTECTED = [("t1", 1, "answer", LONG)]


def frames(spark):
    return spark.createDataFrame(FRAGMENTS, "id long, title string, text string, example boolean"), spark.createDataFrame(PROTECTED, "item string, position long, side string, text string")


def ranked(df):
    out = {}
    for x in df.orderBy("query", "rank").collect():
        out.setdefault(x["query"], []).append(x["id"])
    return out


def test_versions_meta_and_excluded(spark, tmp_path):
    fragments, protected = frames(spark)
    root = f"file://{tmp_path}/index"
    first = index.build_index(fragments, protected, root)
    second = index.build_index(fragments.filter("id <> 6"), protected, root)
    assert index.open_index(spark, root).folder == second.folder != first.folder
    meta = first.table("meta").first()
    assert (meta["fragments"], meta["excluded"], meta["protected"]) == (6, 1, 1)
    assert second.table("meta").first()["fragments"] == 5
    assert [tuple(x) for x in first.table("excluded").collect()] == [(4, "t1")] and not first.table("fragments").filter("id = 4").count()
    assert index.is_current(first, protected).first()["current"]
    assert not index.is_current(first, protected.withColumn("text", F.lit("changed"))).first()["current"]
    row = first.table("postings").filter("term = 'move' AND id = 1").first()
    assert (row["in_title"], row["in_body"], row["size"]) == (1, 0, 6)
    empty = index.build_index(fragments.limit(0), protected.limit(0), root)
    queries = spark.createDataFrame([(1, "body")], "query long, text string")
    assert index.bm25(empty, queries, 3).count() == 0 and empty.table("meta").first()["terms"] == 0


def test_all_terms_first_and_title_weight(spark, tmp_path):
    fragments, protected = frames(spark)
    built = index.build_index(fragments, protected, f"file://{tmp_path}/index")
    queries = spark.createDataFrame([(1, "body Move, move"), (2, "speed"), (3, None), (4, "x ?"), (5, "nowhere body")], "query long, text string")
    got = ranked(index.bm25(built, queries, 9))
    assert set(got) == {1, 2, 5} and set(got[1]) == {1, 2, 5} and got[2] == [6, 1] and set(got[5]) == {1, 2, 5}
    assert got[1].index(5) < got[1].index(2)  # both terms, one in the title
    assert ranked(index.bm25(built, queries, 9, every=True)) == {1: got[1], 2: [6, 1]}
    assert ranked(index.bm25(built, queries, 9, example=True)) == {1: [5], 5: [5]}


def test_all_terms_of_many_queries(spark, tmp_path, monkeypatch):
    """Random texts against a loop; queries of equal terms are searched once."""
    rng = random.Random(3)
    words = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh"]
    text = lambda n: " ".join(rng.choice(words[: rng.randint(1, 8)]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 2)), text(rng.randint(0, 9)), i % 2 == 0) for i in range(120)]
    asked = [(i, text(rng.randint(0, 6))) for i in range(80)] + [(100, "aa zz"), (101, None), (102, "bb aa"), (103, "aa BB aa")]
    built = index.build_index(spark.createDataFrame(docs, "id long, title string, text string, example boolean"), frames(spark)[1], f"file://{tmp_path}/index")
    searched = []
    monkeypatch.setattr(index, "top_n", lambda scored, top, f=index.top_n: searched.append(scored.select("query").distinct().count()) or f(scored, top))
    queries = spark.createDataFrame(asked, "query long, text string")
    some = ranked(index.bm25(built, queries, 200))
    got = ranked(index.bm25(built, queries, 200, every=True))
    has = lambda q, d: set(re.findall("[a-z]+", (q or "").lower())) <= set(f"{d[1]} {d[2]}".split())
    want = {q: {d[0] for d in docs if has(t, d)} for q, t in asked if t}
    assert {q: set(ids) for q, ids in got.items()} == {q: ids for q, ids in want.items() if ids}
    assert all(some[q][: len(ids)] == ids for q, ids in got.items()) and got[102] == got[103]
    assert searched[0] == len({frozenset(t.lower().split()) for _, t in asked if t}) and searched[1] <= searched[0]


def test_postings_meet_queries_in_their_fragment(spark, tmp_path):
    """Rows of a query and a fragment aren't shuffled before the best are known."""
    fragments, protected = frames(spark)
    built = index.build_index(fragments, protected, f"file://{tmp_path}/index")
    queries = spark.createDataFrame([(1, "body move"), (2, "speed")], "query long, text string")
    plan = index.bm25(built, queries, 9)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id#" in plan and not re.search(r"hashpartitioning\(\w+#\d+L?, id#", plan)


def test_pairs_before_shingles(spark, monkeypatch):
    """Only shingles that begin as a protected one are made; hits are those of all shingles."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcdefgh,") for _ in range(n))
    secret = [(f"t{i}", i, "answer", text(rng.randint(0, 20))) for i in range(12)]
    docs = [(i, " ".join([text(rng.randint(0, 9)), rng.choice(secret)[3][rng.choice((0, 0, 4)) :], text(rng.randint(0, 9))])) for i in range(150)] + [(200, None), (201, "a"), (202, "")]
    documents, protected = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(secret, "item string, position long, side string, text string")
    few = sorted(tuple(x) for x in corpus.protected_hits(documents, protected, least=1).collect())
    made = documents.select(F.size(corpus.shingle_hashes("text", pairs=[1])).alias("n")).filter("n > 0").count()
    monkeypatch.setattr(corpus, "SENT", 0)
    assert few == sorted(tuple(x) for x in corpus.protected_hits(documents, protected, least=1).collect()) and len(few) > 50 and made == 0


def test_exact_lookup(spark):
    classes = spark.createDataFrame([("Node", 10), ("Node", 11), ("Body", 12), ("Input", 13)], "class string, id long")
    members = spark.createDataFrame([("move", "Node", 20), ("move", "Body", 21), ("get_x", "Node", 22), ("get_x", "Input", 19), ("run", "Body", 24)], "member string, class string, id long")
    chain = vocabulary.closure(spark.createDataFrame([("Node", None), ("Body", "Node"), ("Input", None)], "child string, parent string"))
    texts = {1: "Body.get_x()", 2: "body.move", 3: "Node.run", 4: "how does input use get_x", 5: "How does Body use get_x and move", 6: "run", 7: "input", 8: None, 9: "", 10: "Nothing.move", 11: "body ?"}
    got = ranked(r.exact_lookup(spark.createDataFrame(list(texts.items()), "query long, text string"), classes, members, chain))
    assert got == {1: [22, 12], 2: [20, 12], 3: [10], 4: [19, 22], 5: [22, 12], 6: [24], 7: [13], 11: [12]}


def test_staged_results(spark):
    rows = lambda *x: spark.createDataFrame([(1, i, k) for k, i in enumerate(x)], "query long, id long, rank long")
    got = r.staged([("a", rows(1, 2, 3), F.lit(2)), ("b", rows(2, 9, 8, 7), F.lit(2)), ("c", rows(1, 9, 6), None), ("b", rows(2, 9, 8, 7), None)], 6)
    assert [(x["place"], x["id"], x["found_by"]) for x in got.orderBy("place").collect()] == [(1, 1, "a"), (2, 2, "a"), (3, 9, "b"), (4, 8, "b"), (5, 6, "c"), (6, 7, "b")]


def test_embedder_counts_words():
    texts = ["aa bb aa  é", "", "bb"] * 2
    one = lambda t: [sum(int(md5(w.encode()).hexdigest()[0], 16) == k for w in t.split(" ") if w) for k in range(16)]
    assert r.hashing_embedder(texts).tolist() == [one(t) for t in texts]


def test_searches_of_stages_run_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"aa b{i} target") for i in range(9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, "target b3")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = []
    monkeypatch.setattr(r, "staged", lambda stages, n, f=r.staged: given.extend(stages) or f(stages, n))
    assert load().QUERIES["hybrid_search"](spark, str(tmp_path)).count() == 8
    for _, rows, _ in given:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" in plan and "Exchange" not in plan
