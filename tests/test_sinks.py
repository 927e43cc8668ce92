"""Appended results, training sets with their declaration, raw logs, tools in code, changes of proposals, patches of projects."""

from __future__ import annotations

import difflib
import json

import pytest

from millrace.operators import admission, edits
from millrace.operators import messages as m
from millrace.sources import folders
from millrace.streaming import capture


def test_a_batch_written_again_takes_its_own_place(spark, tmp_path):
    lines = lambda n, *oks: spark.createDataFrame([("r", "c", f"t{i}", ok, n) for i, ok in enumerate(oks)], "tour string, configuration string, tache_id string, ok boolean, jetons_entree bigint")
    folder = f"{tmp_path}/results"
    folders.append_results(lines(1, True, False), folder, "b1")
    folders.append_results(lines(2, None, True), folder, "b2")
    folders.append_results(lines(3, False, False, True), folder, "b1")
    assert spark.read.text(f"{folder}/*").count() == 5
    got = sorted((r["tache_id"], r["ok"], r["jetons_entree"]) for r in folders.read_results(spark, f"{folder}/*").collect())
    assert got == [("t0", None, 2), ("t1", True, 2), ("t2", True, 3)]
    with pytest.raises(ValueError, match="batch name"):
        folders.append_results(lines(1), folder, "../x")


def test_sft_is_read_as_declared(spark, tmp_path):
    chat = spark.createDataFrame([(1, [("user", "hé"), ("assistant", "yo")])], "session bigint, messages array<struct<role:string,content:string>>")
    turns = spark.createDataFrame([(1, "S", [("human", "hé"), ("gpt", "yo")]), (2, None, [])], "session bigint, system string, conversations array<struct<from:string,value:string>>")
    folders.write_sft(chat, turns, f"{tmp_path}/set", "talks")
    info = json.loads((tmp_path / "set/dataset_info.json").read_text())
    assert info["talks"]["file_name"] == "talks_sharegpt.jsonl" and info["talks"]["tags"]["user_tag"] == "human"
    assert sorted(map(tuple, folders.read_sft(spark, f"{tmp_path}/set", "talks").collect())) == [(1, "S", 0, "human", "hé"), (1, "S", 1, "gpt", "yo")]
    folders.write_sft(chat.limit(0), turns.limit(0), f"{tmp_path}/set", "talks")
    assert folders.read_sft(spark, f"{tmp_path}/set", "talks").count() == 0


def test_raw_log_of_batch_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([("2026-01-02 03:04:05", "a"), ("2026-01-03 00:00:00", "b"), (None, "c")], "ts string, body string").selectExpr("cast(ts AS timestamp) AS ts", "body")
    capture.raw_log(rows, f"{tmp_path}/batch")
    capture.raw_log(rows.limit(1), f"{tmp_path}/batch")
    assert spark.read.parquet(f"{tmp_path}/batch/raw").count() == 4
    rows.write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        capture.raw_log(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/stream")
    assert sorted((r["day"] or "") and str(r["day"]) for r in spark.read.parquet(f"{tmp_path}/stream/raw").collect()) == ["", "2026-01-02", "2026-01-03"]


def test_tools_by_name_and_in_code(spark):
    calls = [(1, 1, "srv_run", None), (1, 2, "execute", 'await tools["srv"].read({}); tools[\\"srv\\"] . write_file()'), (1, 3, None, "srv.read tools['other'].x"), (1, 4, "srv_a", "tools['srv'].b")]
    got = m.served_tools(spark.createDataFrame(calls, "session int, pos int, tool string, arguments string"), "srv")
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0, "run"), (1, 2, 0, "read"), (1, 2, 1, "write_file"), (1, 4, 0, "a"), (1, 4, 1, "b")]


def test_changes_of_proposals(spark):
    frame = spark.createDataFrame
    files = frame([(1, "a", "one two"), (1, "b", "x"), (1, "c", None), (2, "a", "one one")], "id int, path string, text string")
    changes = frame([(1, 2, "a", "three", "four"), (1, 1, "a", "two", "three"), (1, 3, "a", "nothing", ""), (1, 4, "zz", "x", "y"), (1, 5, "b", "x", None), (1, 6, "c", "x", "y"), (2, 1, "a", "one", "1"), (2, 2, "a", None, "1")], "id int, k int, path string, before string, after string")
    removals = frame([(1, 1, "b"), (1, 2, "b"), (1, 3, "none"), (2, 1, "a")], "id int, k int, path string")
    additions = frame([(2, "a", "back"), (1, "n", "new")], "id int, path string, text string")
    start, errors = admission.start_files(files, changes, removals, additions)
    assert sorted(map(tuple, start.collect())) == [(1, "a", "one four"), (1, "c", ""), (1, "n", "new"), (2, "a", "back")]
    lacking, found = "unknown file or no text", "before found {} times".format
    assert sorted(map(tuple, errors.collect())) == [
        (1, "removal", 2, "not there"), (1, "removal", 3, "not there"), (1, "replacement", 3, found(0)), (1, "replacement", 4, lacking), (1, "replacement", 5, lacking),
        (1, "replacement", 6, found(0)), (2, "replacement", 1, found(2)), (2, "replacement", 2, lacking),
    ]
    start, errors = admission.start_files(files, changes.limit(0), removals.limit(0), additions.limit(0))
    assert start.count() == 4 and errors.count() == 0


def test_patches_of_projects(spark):
    long = "\n".join(["}" if i % 3 else f"line {i}" for i in range(400)])
    before = [(1, "a.gd", "x\ny\nz"), (1, "b.gd", long), (1, "addons/c.gd", "q"), (1, "same.md", "s"), (1, "gone.txt", "1\r\n2\n"), (1, "p.png", "q"), (3, "a.gd", "x")]
    after = [(1, "a.gd", "x\n--y\nz\nw"), (1, "b.gd", long.replace("line 30\n", "other\n}\n")), (1, "same.md", "s"), (1, "new.cfg", "a"), (2, "n.gd", None)]
    want = sum(
        sum(1 for x in list(difflib.unified_diff(a.splitlines(), b.splitlines(), lineterm="", n=0))[2:] if x[0] in "+-")
        for a, b in [("x\ny\nz", "x\n--y\nz\nw"), (long, long.replace("line 30\n", "other\n}\n")), ("1\r\n2\n", ""), ("", "a")]
    )
    schema = "project int, path string, text string"
    got = edits.project_patch(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), 5).collect()
    assert sorted(map(tuple, got)) == [(1, 4, want, want > 5), (2, 0, 0, False), (3, 1, 1, False)]
