"""Hints, contexts, hunks and draws on small fixtures, with nulls and empty tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import assembly as a


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_explain_errors(spark):
    errors = spark.createDataFrame(
        [
            (1, 1, 'Function "move()" not found in base self.', "Sub"), (1, 2, 'Cannot find member "movess" in base "Sub".', None), (1, 3, 'Cannot find member "movess" in base "Sub".', None),
            (1, 4, "Nonexistent function 'x' in base 'Nowhere'.", "Sub"), (1, 5, "Nonexistent function 'zzzzzz' in base 'Top'.", "Sub"), (1, 6, 'Identifier "late" not declared in the current scope.', "Sub"),
            (2, 1, None, "Sub"), (2, 2, "all is well", "Sub"), (2, 3, 'Identifier "move" not declared in the current scope.', None),
        ],
        "verdict bigint, pos bigint, message string, own string",
    )
    parents = spark.createDataFrame([("Top", None), ("Sub", "Top")], "child string, parent string")
    members = spark.createDataFrame([("Top", "move", "method"), ("Top", "moves", "method"), ("Sub", "jump", "method")], "class string, member string, kind string")
    docs = spark.createDataFrame([("Top.move", "y" * 700)], "name string, text string")
    got = rows(a.explain_errors(errors, parents, members, docs), "verdict", "place")
    assert got == [
        (1, 1, "Sub", "move", "method", "Top", None, "y" * 600),
        (1, 2, "Sub", "movess", None, None, "moves; move", None),
        (1, 3, "Top", "zzzzzz", None, None, None, None),
    ]
    assert a.explain_errors(errors.limit(0), parents, members, docs).count() == 0


def test_prompt_context(spark):
    tasks = spark.createDataFrame([(1, 1, "D1", "see res://b.gd. and res://b.gd, res://gone.gd"), (2, 1, "K1", None), (3, 9, "K1", "res://b.gd"), (4, 2, "K1", "res://long.json")], "id bigint, project bigint, skill string, instruction string")
    files = spark.createDataFrame(
        [(1, "b.gd", "one\ntwo"), (1, "a/z.json", "{}"), (1, "journal.txt", "bad res://a/z.json"), (1, "addons/x.gd", "no"), (1, "b.gd.uid", "no"), (2, "long.json", "x" * 13000), *((2, f"p{i:05}.md", None) for i in range(4000))],
        "project bigint, path string, text string",
    )
    got = dict(rows(a.prompt_context(tasks, files), "id"))
    head = "Fichiers du projet :\nres://a/z.json\nres://b.gd\nres://journal.txt"
    assert got[1] == f"{head}\n\n=== journal.txt ===\nbad res://a/z.json\n\n=== res://b.gd ===\n   1| one\n   2| two\n\n=== res://a/z.json ===\n{{}}"
    assert got[2] == head
    assert got[3] == "Fichiers du projet :\n"
    assert len(got[4]) == 40_000 + len(a.CUT_MARK) and got[4].endswith("\n" + a.CUT_MARK.strip()) and "p00000.md" in got[4]


def test_attach_hunks(spark):
    points = spark.createDataFrame(
        [(1, 0, "first", "about b.gd", ["a line here"], ["Name"]), (1, 1, "the a.gd file", None, [], ["Name", "Other"]), (1, 2, "Tests", None, None, None)],
        "note bigint, point bigint, title string, text string, lines array<string>, names array<string>",
    )
    hunks = spark.createDataFrame(
        [
            (1, 10, "x/c.gd", 5, ["a line here", "a line here"], []), (1, 11, "x/c.gd", 9, None, None), (1, 12, "x/c.gd", 15, [], ["Other"]), (1, 13, "x/c.gd", 12, [], []),
            (1, 14, "x/a.gd", 1, [], ["Name"]), (1, 15, "x/b.gd", 1, [], []), (1, 16, "x/test_q.gd", 1, [], []), (1, 17, "alone.gd", 1, [], []), (2, 18, "x/a.gd", 1, [], []),
        ],
        "note bigint, hunk bigint, file string, at bigint, lines array<string>, names array<string>",
    )
    assert rows(a.attach_hunks(points, hunks), "hunk") == [(1, 10, 0), (1, 11, 0), (1, 12, 1), (1, 13, 1), (1, 14, 1), (1, 15, 0), (1, 16, 2), (1, 17, 2)]


def test_mixed_draw(spark):
    kinds = ["odd", "swap", "drop", "mask"]
    faults = spark.createDataFrame(
        [(g, g * 1000 + i, f"f{i % 2}.gd", i % 40, kinds[i % 4]) for g in range(40) for i in range(80)]
        + [(g, g * 1000 + 500 + i, "s.gdshader", i, "tint") for g in range(20) for i in range(5)]
        + [(99, 1, "one.gd", 3, "odd"), (99, 2, "one.gd", 3, "swap"), (99, 3, "s.gdshader", 3, "odd")],
        "group bigint, id bigint, file string, line bigint, kind string",
    )
    drawn = a.mixed_draw(faults, "s", "mask")
    again = a.mixed_draw(faults.repartition(7, F.rand(3)), "s", "mask")
    assert rows(drawn, "group", "id") == rows(again, "group", "id")
    full = drawn.join(faults, ["group", "id"]).collect()
    groups = {}
    for r in full:
        groups.setdefault(r["group"], []).append(r)
    assert set(groups) == set(range(40))
    sizes = set()
    for g in groups.values():
        script = [r for r in g if r["file"].endswith(".gd")]
        other = [r for r in g if not r["file"].endswith(".gd")]
        assert len({r["file"] for r in script}) == 1 and len({r["line"] for r in script}) == len(script)
        assert sum(r["kind"] == "mask" for r in script) <= 1
        sizes.add((len(script), len(other)))
    assert {s for s, _ in sizes} <= {2, 3, 4} and len({s for s, _ in sizes}) > 1 and {o for _, o in sizes} <= {0, 1, 2}
