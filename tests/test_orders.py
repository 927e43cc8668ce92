"""Running sums, packing in order, quotas and extremes against loops over small groups, hot keys and nulls."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import orders
from millrace.operators.retrieval import fold_pack


def test_running(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 9), rng.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    got = [tuple(r) for r in orders.running(df, ["k"], ["o", "v"], {"total": F.col("v")}).collect()]
    want = []
    for k in ("a", "b", None):
        total = 0
        for i, (o, v) in enumerate(sorted((o, v) for x, o, v in rows if x == k)):
            total += v
            want.append((k, o, v, i + 1, total))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert orders.running(df.limit(0), ["k"], ["o"]).count() == 0


@pytest.mark.parametrize("least", [0, 6])
def test_pack_in_order(spark, least):
    rng = random.Random(2)
    rows = [(g, i, rng.choice([0, 1, 2, 3, 5, 8, 13, None])) for g, n in (("hot", 200), ("one", 1), ("two", 7), (None, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, size int").withColumn("pack0", F.lit(1)).repartition(4)
    got = {(r["g"], r["i"]): r["pack"] for r in orders.pack_in_order(df, "g", ["i"], "size", 10, least).collect()}
    for g in ("hot", "one", "two", None):
        sizes = [x or 0 for h, _, x in rows if h == g]
        want = fold_pack(sizes, 10)
        last = want[-1]
        if last and sum(n for n, p in zip(sizes, want, strict=True) if p == last) < least:
            want = [min(p, last - 1) for p in want]
        assert [got[(g, i)] for i in range(len(sizes))] == want
    assert orders.pack_in_order(df.limit(0), "g", ["i"], "size", 10, least).count() == 0


def loop_quotas(shares: dict, total: int) -> dict:
    out = {k: round(total * v / (sum(shares.values()) or 1)) for k, v in shares.items()}
    while sum(out.values()) != total:
        if sum(out.values()) < total:
            out[min(out, key=lambda k: (out[k], k))] += 1
        else:
            out[max(out, key=lambda k: (out[k], k))] -= 1
    return out


def test_proportional_quotas(spark):
    rng, groups = random.Random(3), {}
    for g in range(60):
        groups[g] = {f"k{j}": rng.choice([0, 1, 1, 1, 2, 3, 7, 50]) for j in range(rng.randint(1, 12))}
    rows = [(g, k, float(v)) for g, s in groups.items() for k, v in s.items()]
    df = spark.createDataFrame(rows, "grp long, key string, share double")
    for total in (0, 1, 10, 57):
        got = {}
        for r in orders.proportional_quotas(df, total).collect():
            got.setdefault(r["grp"], {})[r["key"]] = r["quota"]
        assert got == {g: loop_quotas(s, total) for g, s in groups.items()}


def test_extremes(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 1, 9, 7, 3)] + [(None,)], "v double")
    assert sorted(map(tuple, orders.extremes(df, "v", 2).collect())) == [(1.0, "low"), (1.0, "low"), (5.0, "middle"), (7.0, "high"), (9.0, "high")]
    assert orders.extremes(df.limit(0), "v").count() == 0
