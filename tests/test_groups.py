"""Strong components against reachability on random graphs, and an order of use."""

from __future__ import annotations

import random

from millrace.operators import groups


def reach(starts, edges):
    seen, work = set(starts), list(starts)
    while work:
        for x in edges.get(work.pop(), ()):
            if x not in seen:
                seen.add(x)
                work.append(x)
    return seen


def components(pairs):
    """By definition: nodes that reach each other; each strong component is found once, from its first node."""
    forth, back = {}, {}
    for a, b in pairs:
        forth.setdefault(a, set()).add(b)
        back.setdefault(b, set()).add(a)
    out, left = {}, {x for p in pairs for x in p}
    while left:
        one = min(left)
        both = reach([one], forth) & reach([one], back)
        out |= dict.fromkeys(both, max(both))
        left -= both
    return out


def test_components_and_order(spark):
    rng, rows = random.Random(7), []
    for n, m in ((300, 330), (200, 500)):
        rows += [(f"g{n}", f"n{rng.randrange(n):04}", f"n{rng.randrange(n):04}") for _ in range(m)]
    rows += [("self", "a", "a"), ("ring", "a", "b"), ("ring", "b", "c"), ("ring", "c", "a"), ("ring", "c", "d"), ("ring", "z", "c"), ("null", None, "x"), ("null", "y", "x")]
    uses = spark.createDataFrame(rows * 2, "grp string, a string, b string").repartition(4)
    got = {}
    for r in groups.strong_components(uses).collect():
        got.setdefault(r["grp"], {})[r["node"]] = r["component"]
    for g in ("g300", "g200", "self", "ring"):
        assert got[g] == components([(a, b) for x, a, b in rows if x == g])
    assert got["null"] == {"x": "x", "y": "y"} and len(set(got["g200"].values())) < 150
    placed = {}
    for r in groups.dependency_groups(uses).collect():
        placed.setdefault(r["grp"], {})[r["place"]] = r["pieces"]
    assert placed["ring"] == {0: ["d"], 1: ["a", "b", "c"], 2: ["z"]}
    for g in ("g300", "g200"):
        at = {x: k for k, pieces in placed[g].items() for x in pieces}
        assert sorted(placed[g]) == list(range(len(placed[g])))
        assert all(at[b] < at[a] or got[g][a] == got[g][b] for x, a, b in rows if x == g)
    assert groups.dependency_groups(uses.limit(0)).count() == 0


def test_small_groups_in_tasks(spark, monkeypatch):
    """Groups of few rows are ordered inside tasks as by rounds of joins, over several batches; only large groups take rounds."""
    rng = random.Random(9)
    rows = [(g, f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for g in range(60) for n in [rng.randint(1, 8)] for _ in range(rng.randint(1, 16))]
    rows += [(None, "a", "b"), (70, None, "b"), (71, "é", "z"), (71, "z", "é"), (71, "Z", "z")]
    uses = spark.createDataFrame(rows * 2, "grp long, a string, b string").repartition(3)
    one = groups.large_groups(uses)
    by_rounds = sorted(tuple(r) for r in one.collect())
    rounds = []
    monkeypatch.setattr(groups, "large_groups", lambda rows, f=groups.large_groups: rounds.append(rows.select("grp").distinct().count()) or f(rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        few = groups.dependency_groups(uses)
        assert few.dtypes == one.dtypes and sorted(tuple(r) for r in few.collect()) == by_rounds and not rounds
        monkeypatch.setattr(groups, "SMALL", 20)
        assert sorted(tuple(r) for r in groups.dependency_groups(uses).collect()) == by_rounds and 0 < rounds[0] < 60
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
