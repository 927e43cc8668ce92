"""First gates on small hand-made rows: nulls, blanks, ties, empty tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from millrace.operators import admission as a
from millrace.sources import folders


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_task_format(spark):
    good = hashlib.sha256(b"depart/a.gd h1\ntests_caches/test_a.gd h2").hexdigest()
    plain = hashlib.sha256(b"depart/a.gd h1").hexdigest()
    files = spark.createDataFrame([(k, "depart/a.gd", "h1") for k in (1, 2, 3, 4)] + [(k, "tests_caches/test_a.gd", "h2") for k in (1, 2, 4)], "id int, path string, hash string")
    tasks = spark.createDataFrame([(1, good, "x"), (2, "other", "x"), (3, plain, "x"), (4, good, " "), (5, None, "x")], "id int, hash string, field string")
    assert rows(a.task_format_check(tasks, files, ("field",)), "id", "reason") == [(1, None), (2, "wrong hash"), (3, "no hidden test"), (4, "missing: field"), (5, "wrong hash")]
    assert a.task_format_check(tasks.limit(0), files, ("field",)).count() == 0


def test_safe_paths_and_occurrences(spark):
    paths = {"a.gd": True, "a/b.tscn": True, "/a.gd": False, "../a.gd": False, "a/../b.gd": False, "c:a.gd": False, "a\\b.gd": False, "a.exe": False, "a/.gd": False, "": False, None: False, "a..b.gd": True}
    df = spark.createDataFrame([(p, ok) for p, ok in paths.items()], "path string, ok boolean")
    assert df.filter(a.safe_path(F.col("path")) != F.col("ok")).collect() == []
    counts = spark.createDataFrame([("aXbXc", "X", 2), ("aaa", "aa", 1), ("a", "", 0), ("a", None, 0), (None, "a", 0)], "t string, p string, n int")
    assert counts.filter(a.occurrences(F.col("t"), F.col("p")) != F.col("n")).collect() == []


def test_proposal_lists_all_errors(spark):
    schema = "id int, format string, skill string, instruction string, path string, base_text string, before string, answer string, test_path string, test_text string, steps array<string>"
    good = (1, "v", "S1", "long enough instruction", "core/a.gd", "one two", "one", "x", "tests/test_a.gd", "extends GdUnitTestSuite", ["import"])
    bad = (2, *[None] * 10)
    df = spark.createDataFrame([good, bad], schema)
    skills = spark.createDataFrame([("S1",), ("S1",)], "skill string")
    got = {r["id"]: r["errors"] for r in a.proposal_validation(df, skills, "v").collect()}
    assert got == {1: [], 2: ["format", "skill", "instruction", "path", "before found 0 times", "answer", "test name", "test class"]}


def test_unknown_types(spark):
    scripts = spark.createDataFrame([(1, "class_name Own\nvar a: Own\nvar b: Far\nvar c: Far\nvar d: Node"), (2, None)], "id int, text string")
    known = spark.createDataFrame([("Node",)], "name string")
    assert rows(a.unknown_types(scripts, known, r": (\w+)", r"class_name (\w+)"), "id", "line", "name") == [(1, 3, "Far")]


def test_grid_draw(spark):
    grid = {"x": (0.0, 1.0, 0.5, 1), "y": (2.0, 2.0, 1.0, 1)}
    drawn = a.parameter_grid_draw(spark.range(50).select(F.col("id").alias("key")), grid).collect()
    assert sorted(r["x"] for r in drawn) == [0.0, 0.5, 1.0] and {r["y"] for r in drawn} == {2.0} and min(r["key"] for r in drawn) == 0
    effects = spark.createDataFrame([(1, 7), (2, 8), (3, 8), (4, None)], "key int, e int")
    start = spark.createDataFrame([(7,)], "e int")
    assert rows(a.changed_draws(effects, start, ["e"]), "key") == [(2,), (4,)]


def test_balanced_until_budget(spark):
    examples = spark.createDataFrame([("g", i // 2, i, 10) for i in range(400)] + [("h", 0, 0, 10)], "grp string, place int, id int, size int")
    targets = spark.createDataFrame([("g", 35)], "grp string, target int")
    got = a.balanced_until_budget(examples, targets, first_mean=8)
    assert sorted(r["total"] for r in got.collect()) == [10, 20, 30]  # 30 and half a mean of 10 reach the target
    order = sorted((min(range(2 * p, 2 * p + 2), key=lambda i: hashlib.sha256(str(i).encode()).hexdigest()) for p in range(200)), key=lambda i: hashlib.sha256(str(i).encode()).hexdigest())
    assert sorted(r["id"] for r in got.collect()) == sorted(order[:3])
    many = a.balanced_until_budget(examples, targets.withColumn("target", F.lit(10**6)))
    assert sorted(r["id"] for r in many.collect()) == sorted(order[:90])


def test_benchmark_score(spark):
    texts = [
        (1, '{"tasks": [{"success": true}, {"success": true, "skipped": true}, {"success": false}]}'),
        (2, '{"tasks": [], "results": [{"success": true}]}'),
        (3, '{"success": 3, "tasks_attempted": 5}'),
        (4, "broken"),
        (5, None),
    ]
    df = spark.createDataFrame(texts, "report int, text string")
    assert rows(a.benchmark_score(df), "report", "k", "n") == [(1, 1, 2), (2, 1, 1), (3, 3, 5), (4, None, None), (5, None, None)]


def test_sessions_are_rows(spark, tmp_path):
    said = spark.createDataFrame([(1, 1, "user", "a\nb"), (1, 2, "assistant", ""), (2, 1, "user", '"q" \\n')], "session int, pos int, role string, content string")
    folders.write_sessions(said, said.select("session").distinct(), f"{tmp_path}/s")
    back = folders.session_messages(spark.read.parquet(f"{tmp_path}/s"))
    assert rows(back, "session", "pos", "role", "content") == [(1, 0, "user", "a\nb"), (1, 1, "assistant", ""), (2, 0, "user", '"q" \\n')]
