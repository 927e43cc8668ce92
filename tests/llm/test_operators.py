"""Training-data operators on awkward rows: nulls, blanks, long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, common, decontam, lm, near_join, ogg, packing, quality, substring_dedup, suffix_dedup, token_counts, warc

random.seed(5)
BASE = [" ".join(random.choice(["a", "b", "c", "dd", "é", "fff"]) for _ in range(random.randint(30, 90))) for _ in range(6)]
TEXTS = {i: " ".join(random.sample(BASE, random.randint(1, 3))) for i in range(40)}
TEXTS |= {40: None, 41: "", 42: " \n\t ", 43: "x", 44: "a " * 3000, 45: TEXTS[3], 46: TEXTS[3] + " tail", 47: "w" * 2000, 48: "w" * 2000 + "v", 49: "ÀÉ ß <|endoftext|> 日本"}
#: Columns whose names operators use for their own ends.
CLASH = ("crc", "anchor", "span", "parts", "slot", "_t", "_crc", "row", "places", "node", "score", "length", "size", "bucket")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def twice(docs):
    """Every row two times, under its own doc_id."""
    return docs.unionByName(docs)


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize(("n", "shard"), [(50, 1024), (50, 1), (7, 2)])
def test_passages(docs, n, shard):
    assert result(substring_dedup.digests(docs, n, shard)) == substring_dedup.brute_force(TEXTS, n)


def test_passages_of_repeated_rows(twice, nothing, docs):
    got = [tuple(r) for r in substring_dedup.digests(twice).collect()]
    want = substring_dedup.brute_force(TEXTS)
    assert sorted(got) == sorted((k, *v) for k, v in want.items() for _ in range(2))
    assert substring_dedup.digests(nothing).count() == 0
    kept = {r["doc_id"]: r["text"] for r in substring_dedup.remove(docs).collect()}
    assert all((hashlib.sha256(" ".join((kept[k] or "").encode().decode().split(" ")).encode()).hexdigest() == v[2]) for k, v in want.items() if v[1])
    assert kept[40] is None and substring_dedup.remove(docs).columns == docs.columns


@pytest.mark.parametrize(("n", "shard"), [(400, 4096), (400, 1), (31, 2)])
def test_byte_strings(docs, n, shard):
    assert result(suffix_dedup.digests(docs, n, shard)) == suffix_dedup.brute_force(TEXTS, n)


def test_byte_strings_of_repeated_rows(twice, nothing):
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digests(twice).collect()}
    assert all(v[1] == (v[0] if v[0] >= 400 else 0) for v in got.values())
    assert suffix_dedup.digests(nothing).count() == 0
    assert suffix_dedup.remove(nothing).columns == nothing.columns


def test_passages_go_by_bytes_or_by_words(spark):
    """Of 60 words that two documents share, op5 counts words and op8 bytes: 399 bytes stay, 400 go from both documents."""
    draw = random.Random(3)
    rows, passages = [], {399: 40, 400: 41}
    for size, longer in passages.items():
        words = ["".join(draw.choices("abcdefghij", k=6 if i < longer else 5)) for i in range(60)]
        passage = " ".join(words)
        assert len(passage) == size
        # the blanks beside the passage differ, so no longer string is shared
        rows += [(10 * size, f"k {passage} l"), (10 * size + 1, f"m\t{passage}\nn")]
    few = spark.createDataFrame(rows, "doc_id long, text string")
    by_bytes, by_words = result(suffix_dedup.digests(few)), result(substring_dedup.digests(few))
    kept = {k: hashlib.sha256(t.encode()).hexdigest() for k, t in rows} | {4000: hashlib.sha256(b"k  l").hexdigest(), 4001: hashlib.sha256(b"m\t\nn").hexdigest()}
    assert by_bytes == {k: (len(t), 400 * (k >= 4000), 1 * (k >= 4000), kept[k]) for k, t in rows}
    assert {k: v[:2] for k, v in by_words.items()} == {3990: (62, 0), 3991: (62, 60), 4000: (62, 0), 4001: (62, 60)}


def test_near_join(docs, nothing, monkeypatch):
    monkeypatch.setattr(near_join, "CHUNK", 4)
    monkeypatch.setattr(near_join, "BLOCK", 4)
    want = near_join.brute_force(TEXTS)
    assert result(near_join.join(docs)) == want
    kept = near_join.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({v[0] for v in want.values()}) and kept.columns == docs.columns
    assert near_join.join(nothing).count() == 0


def test_near_join_of_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, ""), (2, "")], "doc_id long, text string")
    got = sorted(map(tuple, near_join.join(df).collect()), key=str)
    assert got == sorted([(1, 1, 0, 2), (1, 1, 0, 2), (None, None, 0, 1), (2, 2, 0, 1), (2, 2, 0, 1)], key=str)
    assert sorted(map(str, (r["doc_id"] for r in near_join.keep_one(df).collect()))) == ["1", "2", "2", "None"]


def test_posterior_keeps_what_may_reach_the_threshold():
    least = near_join.least_agreements(0.8, 1e-6)
    assert least[16] < 16 * 0.8 and least[128] < 128 * 0.8 and least[128] > 128 * 0.5


def test_packing(docs, nothing):
    rows = packing.pack(docs).collect()
    encode = bpe.encoder(bpe.default_path()).whole
    for k, text in TEXTS.items():
        ids = np.array([*encode.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == k)
        assert sum(x[1] for x in mine) == len(ids) == mine[0][3]
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c, _ in mine)
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 1024 and sorted(filled) == list(range(len(filled)))
    assert packing.pack(nothing).count() == 0


def test_cutting_stock_serves_every_piece():
    rng = random.Random(1)
    histogram = Counter(rng.randint(1, 128) for _ in range(4000))
    planned = packing.plan(dict(histogram), 128)
    served = Counter()
    for pattern, times in planned:
        assert sum(s * n for s, n in pattern.items()) <= 128
        served.update({s: n * times for s, n in pattern.items()})
    assert served == histogram
    assert sum(t for _, t in planned) <= 1.01 * sum(s * n for s, n in histogram.items()) / 128 + 2


def test_token_ids_equal_the_library():
    e = bpe.encoder(bpe.default_path())
    pieces = ["a", " the", "  ", "\n", "'s", "1", "é", "!", "\x1c", "\x85", "<|endoftext|>", "日本", "🙂", "\r\n"]
    for _ in range(2000):
        s = "".join(random.choice(pieces) for _ in range(random.randint(0, 12)))
        assert e.ids(s) == e.whole.encode(s, add_special_tokens=False).ids


def test_edited_counts_equal_a_new_count():
    e = bpe.encoder(bpe.default_path())
    pieces = ["a", " the", " ", "  ", "\n", "1", "é", " word", " of and to", "<|endoftext|>", "x" * 30, ","]
    for _ in range(300):
        s = "".join(random.choice(pieces[:9]) for _ in range(random.randint(0, 200)))
        tree = token_counts.TokenTree(s, e, random.choice([1, 10, 40]))
        for _ in range(6):
            a, c, p = random.randint(-1, len(s) + 3), random.randint(0, 60), "".join(random.choice(pieces) for _ in range(random.randint(0, 4)))
            tree.edit(a, c, p)
            a = min(max(a, 0), len(s))
            s = s[:a] + p + s[a + min(c, len(s) - a) :]
            assert tree.total == len(e.ids(s)) and "".join(tree.leaves) == s


def test_token_counts_frame(docs, nothing):
    got = {r["doc_id"]: r for r in token_counts.count_edited(token_counts.sample_edits(docs)).collect()}
    e = bpe.encoder(bpe.default_path())
    assert all(got[k]["n_tokens"] == len(e.ids(v or "")) for k, v in TEXTS.items())
    assert token_counts.count_edited(token_counts.sample_edits(nothing)).count() == 0


def test_ogg(docs, nothing):
    got = {r["doc_id"]: r for r in ogg.decode_media(ogg.encode_media(docs)).collect()}
    for k, v in TEXTS.items():
        data = (v or "").encode()
        full = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        assert (got[k]["n_bytes"], got[k]["payload_bytes"], got[k]["payload_sha256"], got[k]["tail_crc32"]) == (len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert got[3]["media_sha256"] == got[45]["media_sha256"] and ogg.decode_media(ogg.encode_media(nothing)).count() == 0


def test_ogg_padding():
    assert [len(ogg.padded(b"x" * n)) for n in (0, 1, 63, 64, 65, 127, 128, 129)] == [64, 64, 64, 64, 128, 128, 128, 192]
    assert ogg.padded(b"") == bytes(64) and ogg.padded(b"x" * 64) == b"x" * 64


def test_ogg_of_repeated_rows(twice):
    got = Counter(map(tuple, ogg.decode_media(ogg.encode_media(twice)).collect()))
    assert len(got) == len(TEXTS) and set(got.values()) == {2}


def test_ogg_checksum_and_damage():
    def slow(data):
        c = 0
        for b in data:
            c ^= b << 24
            for _ in range(8):
                c = ((c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else (c << 1) & 0xFFFFFFFF
        return c

    assert all(ogg.checksum(x) == slow(x) for x in (b"", b"a", bytes(range(256))))
    for n in (0, 255, 4096, 70_000):
        payload = bytes(random.randrange(256) for _ in range(n))
        streams = ogg.demux(ogg.mux(payload))
        assert b"".join(p for p, _ in streams[ogg.AUDIO]["packets"][1:]) == payload and streams[ogg.AUDIO]["last"] == n
    bad = bytearray(ogg.mux(b"abc" * 100))
    bad[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        ogg.demux(bytes(bad))


def test_warc(spark):
    big, rows = "é" * 80, []
    rows = [(1, "u\r\nx", None), (2, None, ""), (3, "u", big), (4, "u", big), (5, "u", "small"), (6, "u", "small"), (7, "u", big + "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("size", F.lit(2))
    got = result(warc.digests(warc.warc_round_trip(pages, archive_bytes=300)))
    for k, _, html in rows:
        data = (html or "").encode()
        kind = ("revisit", 3) if k == 4 else ("response", None)
        assert got[k] == (len(data), hashlib.sha256(data).hexdigest(), *kind)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_warc_of_null_and_repeated_ids(spark):
    big = "x" * 200
    rows = [(None, "u", big), (5, None, big), (5, "u", big), (7, "u", big), (8, "u", None), (8, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "payload": F.lit(2)})
    got = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.digests(warc.warc_round_trip(pages)).collect())
    assert got == {(None, "response", None): 1, (5, "response", None): 2, (7, "revisit", 5): 1, (8, "response", None): 2}


def test_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(30)], "page_id long, url string, html string")
    members = warc.normalize(warc.write_archives(warc.plan_records(pages), 500))
    files = warc.export_files(members, f"file://{tmp_path}").collect()
    assert files and all((tmp_path / r["archive"]).stat().st_size == r["bytes"] and (tmp_path / f"{r['archive']}.idx").exists() for r in files)


def brute_hits(texts, items, size=10):
    import re

    words = lambda t: re.findall(decontam.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = {}
    for k, t in texts.items():
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (g := grams.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= g
        out[k] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


ITEMS = [(1, TEXTS[0]), (2, "DD-fff É a"), (3, None), (4, ""), (10, TEXTS[3][:80].upper()), (5, "x"), (6, "x")]


def test_decontamination(spark, docs, nothing):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute_hits(TEXTS, ITEMS)
    assert result(decontam.report(docs, bench)) == want
    assert {r["doc_id"]: r["n"] for r in decontam.hits(docs, bench, max_heads=1).select("doc_id", F.size(decontam.covered_words()).alias("n")).collect()} == {k: v[1] for k, v in want.items()}
    assert decontam.report(nothing, bench).count() == 0
    assert not decontam.report(docs, bench.limit(0)).filter("contaminated").count()
    kept = decontam.clean(docs, bench, 0.0)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in want.items() if not v[4]) and kept.columns == docs.columns
    after = {r["doc_id"]: r["text"] for r in decontam.clean(docs, bench).collect()}
    assert all(after[k] == TEXTS[k] for k, v in want.items() if not v[4])
    assert all(len(brute_hits({k: after[k]}, [])[k]) and brute_hits({k: after[k]}, [])[k][0] == want[k][0] - want[k][1] for k in after)


def test_quality(spark, docs, nothing):
    good = ["The cat sat on the mat, and it was warm today."] * 3
    rows = [(i, " ".join(good) + f" number {i}.") if i % 2 else (i, "BUY!!! NOW!!! " * (5 + i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows] + [(None, 1, 0), (999, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(df, labels)
    got = quality.score(df, model).join(labels.filter("quality is not null"), "doc_id").filter("held_out").select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert got > 0.97 and len(model.rules) > 0
    scores = quality.score(docs, model).collect()
    assert len(scores) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.score(nothing, model).count() == 0 and quality.keep_good(docs, model).columns == docs.columns
    empty = quality.train(df, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, empty).collect()} == {0.5}


def test_lm_trains_on_every_text(spark):
    """Texts of all rounds, one word each: the logits after each word move away from their start."""
    words = ["the", "and", "for", "with", "that", "have", "from", "not", "can", "see", "all", "new"]
    turn, kept = (lambda i: zlib.crc32(str(i).encode()) // 7 % lm.ROUNDS), (lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    ids = [next(i for i in range(1000) if turn(i) == t and kept(i)) for t in range(len(words))]
    model = lm.fit(spark.createDataFrame([(i, f"{w} " * 5) for i, w in zip(ids, words, strict=True)], "doc_id long, text string"))
    assert sorted(model.words) == sorted(w.encode() for w in words)
    assert model.p["last"][: len(words)].any(axis=1).all()


def naive_logs(form, p, x, y):
    """log10 of each class, place by place: the same windows, no batches."""
    rows = np.array([p["e"][form.ids[a:b]].sum(axis=0) for a, b in zip(form.starts[:-1], form.starts[1:], strict=True)])
    out, step = [], form.window - form.context
    for i in range(len(x)):
        first = 0 if i < form.window else (i - form.context) // step * step
        seen = rows[x[first : i + 1]]
        s = (seen[-1] @ p["q"]) @ (seen @ p["k"]).T / math.sqrt(lm.WIDTH) + p["far"][np.arange(i - first, -1, -1)]
        a = np.exp(s.clip(-lm.MOST, lm.MOST))
        z = (a / a.sum()) @ (seen @ p["v"]) @ p["o"] + p["last"][form.class_of[x[i]]] + p["bias"]
        out.append((z[y[i]] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10))
    return out


def test_lm_scores_equal_a_naive_model(spark, docs):
    model = lm.fit(docs)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()}
    counts = {bytes(r["word"]): r["c"] for r in model.counts.collect()}
    x, spelling = model.lexicon, model.lexicon.spelling
    index = {w: i for i, w in enumerate(model.words)}
    for k, text in TEXTS.items():
        codes, inside = [], 0.0
        for w in (text or "").encode().lower().split():
            code = index.get(w)
            if code is None:
                ids, starts = lm.spell([w], spelling.path)
                g = int(spelling.near[ids].sum(axis=0).argmax())
                before = [lm.VOCABULARY, *ids[:-1]]
                spelled = sum(naive_logs(spelling.form(), spelling.p, [lm.VOCABULARY + g, *ids], [*spelling.class_of[ids], lm.STOP])) + spelling.table[before, ids].sum()
                inside += math.log10((max(0, counts.get(w, 0) - lm.DISCOUNT) + lm.DISCOUNT * x.rare_d[g] * 10**spelled) / x.rare_n[g]) if spelled > -300 or w in counts else math.log10(lm.DISCOUNT * x.rare_d[g] / x.rare_n[g]) + spelled
                code = len(index) + g
            else:
                inside += x.inside[code]
            codes.append(code)
        begin = len(index) + lm.GROUPS
        classes = [int(x.class_of[c]) for c in codes]
        if len(codes) > 500:
            continue
        assert math.isclose(got[k], inside + sum(naive_logs(x.form(), model.p, [begin, *codes], [*classes, lm.END])), rel_tol=1e-4), k


def test_lm(docs, nothing):
    got = {r["doc_id"]: r for r in lm.score_corpus(docs).collect()}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in TEXTS}
    counts = Counter()
    for k, v in TEXTS.items():
        if not out[k]:
            counts.update((v or "").encode().lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    for k, text in TEXTS.items():
        words = [*(text or "").encode().lower().split(), None]
        assert (got[k]["held_out"], got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (out[k], len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(got[k]["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        assert got[k]["score"] < 0
    assert lm.score_corpus(nothing).count() == 0


def test_lm_of_repeated_rows(spark):
    rows = [(3, "a b"), (3, "a b"), (3, "a c"), (None, None)]
    got = [tuple(r)[2:6] for r in lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("n_tokens").collect()]
    assert [g[:3] for g in got] == [(1, 1, 10), (3, 3, 10), (3, 3, 10), (3, 3, 10)]


def test_lm_gradients_and_windows():
    rng = np.random.default_rng(0)
    matrix = rng.integers(0, 5, (lm.SIDE, lm.SIDE)).astype(float)
    spelling = lm.Spelling.of(matrix, "")
    table = 10.0 ** spelling.table.astype(float)
    assert all(np.allclose(table[:, spelling.class_of == c].sum(axis=1), 1, atol=1e-3) for c in set(spelling.class_of.tolist()))
    form = spelling.form()
    model = lm.Attention(form, {k: v + rng.normal(0, 0.1, v.shape) for k, v in spelling.p.items()}, np.float64)
    x, y = rng.integers(0, lm.VOCABULARY, (2, form.window)), rng.integers(0, form.classes, (2, form.window))
    real = np.ones(x.shape, bool)
    real[1, 5:] = False
    g = model.gradients(x, y, real)
    g["e"] = lm.by_row(x.ravel(), g.pop("rows"), form.vectors)
    for name, at in (("q", (1, 2)), ("k", (3, 0)), ("v", (4, 4)), ("far", (3,)), ("o", (2, 5)), ("last", (x[0, 2], 1)), ("bias", (7,)), ("e", (x[0, 3], 2))):
        sides = []
        for step in (1e-4, -1e-4):
            p = {k: v.copy() for k, v in model.p.items()}
            p[name][at] += step
            sides.append(-lm.Attention(form, p, np.float64).log_p(x, y)[real].sum())
        assert abs((sides[0] - sides[1]) / 2e-4 - g[name][at]) < 1e-5, name
    for sizes in ([1], [24], [25], [500, 1, 7]):
        at, _, scored = lm.windows(np.array(sizes), 24, 8)
        assert sorted(at[scored].tolist()) == list(range(sum(sizes)))


def test_lm_far_scores_stay_finite():
    form = lm.Spelling.of(np.ones((lm.SIDE, lm.SIDE)), "").form()
    p = {k: np.full(v, 30.0) if k in "eqk" else np.zeros(v) for k, v in form.shapes().items()} | {"far": np.full(form.window, -9e9)}
    model, x = lm.Attention(form, p), np.zeros((1, form.window), np.int64)
    assert np.isfinite(model.log_p(x, x)).all() and all(np.isfinite(g).all() for g in model.gradients(x, x, x == 0).values())


def test_lm_holds_few_copies_of_the_list():
    """A round over one short text with 100 000 listed words of 4 ids: the tables of the words and little besides."""
    rng, n = np.random.default_rng(3), 100_000
    form = lm.Form(rng.integers(0, lm.VOCABULARY, 4 * n), np.arange(0, 4 * n + 1, 4), rng.integers(0, lm.K, n), lm.VOCABULARY, lm.K, 16, 4)
    p = {k: rng.normal(0, 0.1, v) for k, v in form.shapes().items()}
    x, y = rng.integers(0, n, 40), rng.integers(0, lm.K, 40)
    tracemalloc.start()
    gradient = lm.Gradient(lm.Attention(form, p))
    gradient.add(x, y, np.array([30, 10]))
    flat = gradient.flat()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    table, sums = 4 * 4 * lm.WIDTH * n, 8 * lm.WIDTH * n
    assert most < 1.5 * (table + sums)
    e = p["e"].astype(np.float32)
    assert np.allclose(gradient.model.table[:, : lm.WIDTH], e[form.ids].reshape(n, 4, -1).sum(axis=1), atol=1e-6)
    assert np.allclose(gradient.model.table[:, -lm.WIDTH :], gradient.model.table[:, : lm.WIDTH] @ p["v"].astype(np.float32), atol=1e-5)
    assert np.array_equal(form.parts(flat)["e"], lm.by_row(form.ids, np.repeat(gradient.rows, 4, axis=0), lm.VOCABULARY))


def test_lm_does_not_depend_on_partitions(docs):
    models = [lm.fit(docs.repartition(n)) for n in (1, 5)]
    assert all(np.allclose(models[0].p[k], models[1].p[k], atol=1e-4) for k in models[0].p)


def test_window_minima_and_rolling_hash():
    v = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    for w in (1, 2, 19, 64, 101):
        got = common.window_minima(v, w, block=700)
        assert all(got[i] == i + np.argmin(v[i : i + w] >> np.uint64(24)) for i in range(len(got)))
    v[100:200] = v[1000:1100]
    h = common.RollingHash(v).every(50)
    assert h[120] == h[1020] != h[121]
