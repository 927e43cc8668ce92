"""Fingerprints of tasks and keys of verdicts against Python's json and hashlib."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from millrace.operators import corpus


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


DOCUMENTS = {
    "a": {"z": [1, {"b": None, "a": "x: y, \"q\" \\ é\n/"}], "empreinte": "e", "gelee": True, "k": {"j": [], "i": {}}, "n": 3},
    "b": {"id": "ü😀", "deep": {"gelee": 1}},
}


def test_task_fingerprint(spark):
    tasks = [(k, json.dumps(v, ensure_ascii=k == "a")) for k, v in DOCUMENTS.items()] + [("c", "[1]"), ("d", None), ("e", "no json")]
    files = [("a", "reference", "x/é.gd", "t"), ("a", "depart", "x.gd", None), ("a", "depart", "x/y.gd", "u"), ("a", "depart", "x-.gd", "w"), ("a", "notes", "n", "v"), ("a", "depart", "p/.godot/q", "v"), ("gone", "depart", "n", "v")]
    out = corpus.task_fingerprint(spark.createDataFrame(tasks, "task string, document string"), spark.createDataFrame(files, "task string, folder string, path string, text string"))
    got = {r["task"]: (r["files"], r["fingerprint"]) for r in out.collect()}
    want = {}
    for k, v in DOCUMENTS.items():
        head = json.dumps({x: y for x, y in v.items() if x not in corpus.VOLATILE}, sort_keys=True, ensure_ascii=False)
        mine = sorted((corpus.TASK_FOLDERS.index(f), p.split("/"), f, p, t) for i, f, p, t in files if i == k and f in corpus.TASK_FOLDERS and ".godot" not in p.split("/"))
        want[k] = (len(mine), sha(head + "".join(f"\n{f}/{p}\n{sha(t)}" for _, _, f, p, t in mine)))
    assert got == {**want, "c": (0, None), "d": (0, None), "e": (0, None)}


def test_quoted_is_ascii_json(spark):
    texts = ["", "plain", 'a"b\\c', "é\tü\n\n\r", "😀x\u0001\x7f", "\n", "\u2028 end", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(corpus.quoted(F.col("t"))).collect()]
    assert got == [None if t is None else json.dumps(t) for t in texts]


def test_verdict_key(spark):
    layers = [(1, 0, "a.gd", "old"), (1, 1, "a.gd", "new"), (1, 0, "journal.txt", "l"), (1, 0, "sub/journal.txt", "l"), (1, 0, "x.uid", "u"), (1, 0, "reports/r", "u"), (1, None, "journal.txt", "t"), (1, None, "é.gd", None)]
    runs = [(1, ["run_tests", "nope", "import"], None, 2), (2, None, "f\"x", 1)]
    out = corpus.verdict_key(spark.createDataFrame(runs, "run int, steps array<string>, filter string, repetition int"), spark.createDataFrame(layers, "run int, layer int, path string, text string"), {"godot": "4.x", "juge": "v"})
    files = {"a.gd": sha("new"), "sub/journal.txt": sha("l"), "tests_juge/journal.txt": sha("t"), "tests_juge/é.gd": sha("")}
    key = lambda **x: sha(json.dumps({"godot": "4.x", "juge": "v", **x}, sort_keys=True))
    assert dict(map(tuple, out.collect())) == {1: key(fichiers=files, etapes=["import", "run_tests"], filtre=None, rep=2), 2: key(fichiers={}, etapes=[], filtre='f"x', rep=1)}
