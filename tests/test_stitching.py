"""Sessions found by prefixes against a scan of all of them; hot openings, rewritten histories, ties, batch and stream."""

from __future__ import annotations

import random
import time

from millrace.streaming import capture


def scan(exchanges: list[tuple]) -> list[list]:
    """The rule as it reads: every session is looked at for every exchange."""
    sessions: list[list] = []
    for ts, talk, system, tools in exchanges:
        best = None
        for i, (_, _, _, old, s, t) in enumerate(sessions):
            shared = next((k for k, (a, b) in enumerate(zip(old, talk, strict=False)) if a != b), min(len(old), len(talk)))
            if shared and len(talk) > len(old):
                best = max(best or (0,), (shared, s == system, t == tools, i))
        if best is None:
            sessions.append([ts, ts, 1, talk, system, tools])
        else:
            old = sessions[best[3]]
            sessions[best[3]] = [old[0], ts, old[2] + 1, talk, system, tools]
    return sessions


def drawn(seed: int, n: int, opening: str | None) -> list[tuple]:
    """Talks that grow, branch, start again, lose their end and change their system text or tools."""
    rng = random.Random(seed)
    talks = [[opening or "a"]]
    out = []
    for ts in range(n):
        talk = list(rng.choice(talks[-6:]))
        if rng.random() < 0.25:
            talk = talk[: rng.randint(1, len(talk))]
        if rng.random() < 0.15:
            talk = [opening or rng.choice("ab")]
        talk += [rng.choice("abc") for _ in range(rng.randint(0, 2))]
        talks.append(talk)
        out.append((float(ts), talk, rng.choice("ST"), rng.choice("xy")))
    return out


def test_index_equals_scan():
    for seed in range(60):
        exchanges = drawn(seed, 150, "a" if seed % 2 else None)
        sessions = capture.Sessions()
        for x in exchanges:
            sessions.take(*x)
        assert sessions.rows == scan(exchanges), seed
        again = capture.Sessions(capture.Sessions(sessions.rows).rows)
        more = (999.0, exchanges[-1][1] + ["z"], "S", "x")
        again.take(*more)
        sessions.take(*more)
        assert again.rows == sessions.rows


def test_a_hot_opening_isnt_quadratic():
    sessions, start = capture.Sessions(), time.monotonic()
    for i in range(20_000):
        sessions.take(float(i), ["hello", f"talk {i}"], "s", "t")
    for i in range(20_000):
        sessions.take(20_000.0 + i, ["hello", f"talk {i}", "more"], "s", "t")
    assert len(sessions.rows) == 20_000 and all(r[2] == 2 for r in sessions.rows)
    assert time.monotonic() - start < 30


SCHEMA = "ts double, status int, path string, request array<struct<role:string,content:string>>, tools array<string>, extra string"


def frame(spark, exchanges):
    ok = (200, "/v1/chat/completions")
    rows = [(ts, *ok, [("system", system), *(("user" if i % 2 == 0 else "assistant", m) for i, m in enumerate(talk))], [tools, "all", tools], None) for ts, talk, system, tools in exchanges]
    return spark.createDataFrame(rows, SCHEMA)


def test_batch_and_stream_equal_scan(spark, tmp_path):
    exchanges = drawn(7, 120, None)
    want = sorted((s[2], len(s[3]), s[0], s[1]) for s in scan(exchanges))
    got = capture.stitched_batch(capture.accepted(frame(spark, exchanges).repartition(5)))
    assert sorted((r["exchanges"], r["messages"], r["first"], r["last"]) for r in got.collect()) == want
    for i in range(3):
        frame(spark, exchanges[i * 40 : i * 40 + 40]).repartition(2).write.json(f"{tmp_path}/in/{i}")
    for i in range(3):
        stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/in/{{{','.join(map(str, range(i + 1)))}}}")
        out = capture.run_to_table(capture.stitched_stream(capture.accepted(stream)), f"{tmp_path}/run", "update")
    last = {(r["key"], r["session"]): (r["exchanges"], r["messages"], r["first"], r["last"]) for r in out.orderBy("batch").collect()}
    assert sorted(last.values()) == want


def test_nulls_empty_requests_and_no_rows(spark):
    ok = (200, "/v1/chat/completions")
    rows = [(1.0, *ok, [("system", "S")], None, None), (2.0, *ok, [("system", "S")], None, None), (3.0, *ok, [("user", None)], None, None), (4.0, *ok, [("user", None), ("assistant", "x")], ["t"], None), (None, *ok, None, None, None), (5.0, *ok, [], None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["exchanges"], r["messages"]) for r in capture.stitched_batch(capture.accepted(df)).collect())
    assert got == [(1, 0), (1, 0), (2, 2)]
    assert capture.stitched_batch(capture.accepted(df.limit(0))).count() == 0
