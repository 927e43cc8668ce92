"""Operators on hand-made rows."""

from __future__ import annotations

import pytest

from millrace.operators import corpus, edits, logs, retrieval, rounds, scores, vocabulary
from millrace.sources import folders
from millrace.streaming import capture


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_wilson_cases(spark):
    df = spark.createDataFrame([("a", "base", 5, 10), ("b", "base", 0, 10), ("c", "base", 10, 10), ("d", "base", 0, 0)], "skill string, configuration string, k long, n long")
    got = {r["skill"]: (round(r["low"], 4), round(r["high"], 4), r["rate"]) for r in scores.with_interval(df).collect()}
    assert got == {"a": (0.2366, 0.7634, 0.5), "b": (0.0, 0.2775, 0.0), "c": (0.7225, 1.0, 1.0), "d": (0.0, 1.0, None)}
    with pytest.raises(Exception, match="impossible"):
        scores.with_interval(df.selectExpr("skill", "configuration", "3L as k", "2L as n")).collect()


def test_rounds_need_a_choice(spark):
    df = spark.createDataFrame([("t0", "base", "S", 1, True), ("t1", "base", "S", 2, True)], "round string, configuration string, skill string, task int, ok boolean")
    with pytest.raises(ValueError, match="several rounds"):
        scores.counts(df)


def test_regression_cases(spark):
    old = spark.createDataFrame([("D1", 40, 50), ("F1", 30, 50), ("K1", 30, 50), ("S1", 20, 50), ("S2", 30, 50)], "skill string, k long, n long")
    new = spark.createDataFrame([("D1", 20, 50), ("F1", 28, 50), ("K1", 30, 50), ("S1", 25, 50), ("E", 5, 50)], "skill string, k long, n long")
    got = {r["skill"]: (r["status"], r["blocking"]) for r in scores.regression(old, new).collect()}
    assert got == {"D1": ("setback", True), "F1": ("drop", False), "K1": ("stable", False), "S1": ("rise", False), "S2": ("absent", True), "E": ("new", False)}


def test_best_attempt_prefers_clean_then_short(spark):
    df = spark.createDataFrame(
        [("a", 0, "True", 50, 0), ("a", 1, "True", 20, None), ("a", 2, "False", 5, 0), ("b", 0, "oui", 30, 2), ("b", 1, "1", 90, 1), ("c", 0, "False", 1, 0)],
        "task string, attempt long, ok string, length long, violations long",
    ).selectExpr("*", "cast(null as boolean) structure_ok", "true session_ok")
    assert rows(rounds.best_attempt(df), "task", "attempt") == [("a", 1), ("b", 1)]
    assert rows(rounds.to_retry(df), "task") == [("c",)]


def test_tokens_treat_all_blanks_alike(spark):
    df = spark.createDataFrame([(1, "Le Héros  court"), (2, "le héros court"), (3, ""), (4, "a b c d e f g h"), (5, None)], "id long, text string")
    got = {r["id"]: r["s"] for r in df.select("id", corpus.shingles("text").alias("s")).collect()}
    assert got[1] == got[2] and got[3] == [] and len(got[4]) == 3 and got[5] == []


def test_numbers_make_texts_differ(spark):
    near = "var speed = {} var jump = {} func move ( ) : return speed * jump"
    c = spark.createDataFrame([(1, "k", near.format(120, 640)), (2, "k", near.format(180, 300)), (3, "x", near.format(120, 640) + " # more")], "id long, grp string, text string")
    f = spark.createDataFrame([(9, "k", near.format(120, 640), 0), (8, "k", near.format(120, 640), 1)], "id long, grp string, text string, position long")
    assert rows(corpus.near_index(c, f), "id", "match", "reason") == [(1, 8, "same_hash")]


def test_draw_is_stable_and_bounded(spark):
    tasks = spark.range(330).selectExpr("case when id < 30 then 'a' else 'b' end skill", "id")
    first = rows(corpus.freeze_sample(tasks, "1", 50, 0.5), "skill", "id")
    assert [sum(s == k for s, _ in first) for k in "ab"] == [15, 50]
    assert first == rows(corpus.freeze_sample(tasks.orderBy(tasks.id.desc()), "1", 50, 0.5), "skill", "id")
    assert first != rows(corpus.freeze_sample(tasks, "2", 50, 0.5), "skill", "id")
    manifest, _ = corpus.freeze_manifest(tasks, "1", 50, 0.5)
    again, _ = corpus.freeze_manifest(tasks, "1", 50, 0.5, manifest)
    assert rows(again, "skill", "id") == rows(manifest, "skill", "id")


def test_log_errors(spark):
    text = ["\x1b[31mSCRIPT ERROR: Parse Error: bad\x1b[0m", "   at: f (res://addons/x.gd:1)", "   at: g (res://hero.gd:7)", "ERROR: 1 resources still in use at exit", "   at: clear (core/io.cpp:1)", "ERROR: res://c.tscn:9 - File not found: y", "ok"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "log long, line long, text string")
    got = logs.errors(logs.without_noise(lines))
    assert rows(got, "line", "file", "number", "category") == [(0, "res://hero.gd", 7, "parse_error"), (5, "res://c.tscn", 9, "missing_resource")]


def test_closure_stops_on_cycles(spark):
    parents = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", None)], "child string, parent string")
    got = rows(vocabulary.closure(parents), "child", "ancestor")
    assert ("a", "c") in got and ("d", "d") in got and len(got) == 10


def test_edit_helpers():
    a, b = "x\ny\nx\nz", "x\nY\nx\nz\nw"
    assert edits.changed_lines(a, b) == [2, 5] and edits.patch_size(a, b) == 3
    assert edits.replay(a, edits.unique_edits(a, b)) == (b, None)
    assert edits.occurrences("aaa", "aa") == 2 and edits.replay("aa", [("a", "b")])[1] == "found 2 times"
    assert edits.answer_zones(list("abcdefgh"), list("abcdXfgh"), 1) == ["d X f"]
    assert edits.json_scan('text {"k": 1} more') == ({"k": 1}, None) and edits.json_scan("none")[1] == "unreadable"


def test_random_edits_replay():
    import random

    random.seed(4)
    for _ in range(200):
        a = "\n".join(random.choice("abc") for _ in range(random.randint(1, 12)))
        b = "\n".join(random.choice("abc") for _ in range(random.randint(1, 12)))
        assert edits.replay(a, edits.unique_edits(a, b)) == (b, None) or a == b


def test_fold_and_stem():
    assert retrieval.fold_pack([5, 5, 9, 1, 20, 1], 10) == [0, 0, 1, 1, 2, 3]


def exchanges(spark, items):
    return spark.createDataFrame(items, "ts long, status int, path string, request array<struct<role:string,content:string>>")


ITEMS = [
    (1, 200, "/v1/chat/completions", [("system", "S"), ("user", "A")]),
    (2, 200, "/v1/chat/completions", [("user", "B")]),
    (3, 200, "/v1/chat/completions", [("system", "S"), ("user", "A"), ("assistant", "r"), ("user", "more")]),
    (4, 500, "/v1/chat/completions", [("user", "A")]),
    (5, 200, "/v1/chat/completions", [("system", "T"), ("user", "A")]),
]


def test_stitching_batch_equals_stream(spark, tmp_path):
    batch = capture.stitched_batch(capture.accepted(exchanges(spark, ITEMS)))
    want = sorted((r["exchanges"], r["messages"]) for r in batch.collect())
    assert want == [(1, 1), (1, 1), (2, 3)]
    for i, part in enumerate((ITEMS[:2], ITEMS[2:])):
        exchanges(spark, part).coalesce(1).write.json(f"{tmp_path}/in/{i}")
    schema = exchanges(spark, ITEMS).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    out = capture.run_to_table(capture.stitched_stream(capture.accepted(stream)), f"{tmp_path}/run", "update")
    last = {}
    for r in out.orderBy("batch").collect():
        last[r["key"], r["session"]] = (r["exchanges"], r["messages"])
    assert sorted(last.values()) == want


def test_sources(spark, tmp_path):
    for name, body in (("t1", '{"id": "t1", "competence": "K", "consigne": "c", "origine": "o", "empreinte": "e", "gelee": false}'), ("t2", '{"id": "t2"}')):
        (tmp_path / "tasks" / name).mkdir(parents=True)
        (tmp_path / "tasks" / name / "tache.json").write_text(body)
    assert rows(folders.read_tasks(spark, f"{tmp_path}/tasks"), "folder", "missing") == [("t1", ""), ("t2", "competence,consigne,origine,empreinte")]
    (tmp_path / "tree/.git").mkdir(parents=True)
    (tmp_path / "tree/a.gd").write_text("é")
    (tmp_path / "tree/.git/b.gd").write_text("x")
    assert rows(folders.read_file_tree(spark, f"{tmp_path}/tree"), "path", "text") == [("a.gd", "é")]
    (tmp_path / "s").mkdir()
    (tmp_path / "s/one.jsonl").write_text('{"tache_id": "t"}\n{"role": "user", "content": "hi"}\n{"role": "assistant", "content": "yo"}\n')
    assert rows(folders.read_sessions(spark, f"{tmp_path}/s"), "session", "pos", "role") == [("one", 0, "user"), ("one", 1, "assistant")]
    (tmp_path / "r.xml").write_text('<s><testcase classname="c" name="a"/><testcase classname="c" name="b"><failure>no</failure></testcase><testcase classname="c" name="d"><skipped>s</skipped></testcase></s>')
    tally = logs.junit_tally(folders.read_junit(spark, f"{tmp_path}/r.xml"))
    assert rows(tally, "total", "passed", "skipped", "failed") == [(3, 1, 1, "c:b")]
