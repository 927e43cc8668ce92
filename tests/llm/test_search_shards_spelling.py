"""Ranked search, hash tree and spelling variants: brute force, awkward rows, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import hash_tree, ranked_search, spelling

random.seed(13)
POOL = ["".join(random.choice("abéß") for _ in range(random.randint(1, 4))) for _ in range(60)]
TEXTS = [(i, " ".join(random.choice(POOL) for _ in range(random.randint(1, 60)))) for i in range(150)]
TEXTS += [(150, None), (151, ""), (152, " \n.,;"), (153, "AB ab;Ab_aB"), (None, "ab é"), (None, "ab é"), (154, TEXTS[3][1]), (3, TEXTS[3][1]), (155, "ab " * 60_000), (156, "x" * 120_000)]
ITEMS = [(1, "ab É b."), (2, None), (2, "ß"), (None, "ab ab zzz"), (4, ""), (5, "nowhere"), (6, " ".join(POOL)), (7, "AB-é")]
CLASH = ("no", "rank", "score", "bucket", "shard", "slot", "size", "_row", "_part", "_at", "word", "n", "sig", "run", "id", "h")


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns).repartition(3).withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS)


@pytest.mark.parametrize(("top", "block"), [(50, 2_000_000), (3, 1)])
def test_ranked_search(spark, docs, top, block):
    items = frame(spark, ITEMS, "item_id long, text string")
    got = [tuple(r) for r in ranked_search.search(docs, items, top, block).collect()]
    assert sorted(got, key=str) == sorted(ranked_search.brute_force(TEXTS, ITEMS, top), key=str)


def test_ranked_search_without_rows(spark, docs):
    items = frame(spark, ITEMS, "item_id long, text string")
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs.filter("doc_id BETWEEN 150 AND 152"), items).count() == 0


def test_guards_keep_to_whole_terms():
    scan = ranked_search.automaton([b"a", b"aa", "é".encode()])
    text = "A aa a-é éa a".encode().translate(ranked_search.FOLD)
    term, tf = ranked_search.counted(scan, text)
    assert dict(zip(term.tolist(), tf.tolist(), strict=True)) == {0: 3, 1: 1, 2: 1}


def drawn(key: str, tree: hash_tree.Tree) -> int:
    """The tree descended one key at a time."""
    node = ""
    for level in tree.children():
        draw = lambda c: (-math.log((int(hashlib.md5(f"{key}:{c[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / c[1], c[0])
        node = min(level[node], key=draw)[0]
    return int(node.split("/")[-1])


def test_assignment(spark, docs):
    rows = hash_tree.assign(docs).collect()
    tree = hash_tree.Tree.regular(16)
    want = Counter()
    for k, t in TEXTS:
        data, key = (t or "").encode(), "" if k is None else str(k)
        want[(k, len(data) + 1, zlib.crc32(data), "key", drawn(key, tree), drawn(key, tree.grown()))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in rows) == want
    for s in range(16):
        mine = sorted((r for r in rows if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in mine] == list(range(len(mine)))
        order = [(r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in mine]
        assert order == sorted(order)
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    assert hash_tree.assign(docs.limit(0)).count() == 0


def test_movement_stays_in_changed_subtrees(spark):
    ids = spark.range(4000).select(F.col("id").alias("doc_id"))
    tree = hash_tree.Tree.regular(16)
    moved = tree.weighted(5, 3.0)
    both = hash_tree.place(hash_tree.place(ids, tree), moved, shard="later")
    rows = both.collect()
    changed = [r for r in rows if r["shard"] != r["later"]]
    assert changed and all(r["later"] // 4 == 1 for r in changed)  # into the region of shard 5 only
    assert all(r["later"] // 2 == 2 for r in changed if r["shard"] // 4 == 1)  # within it into its rack only
    assert all(r["later"] == 5 for r in changed if r["shard"] // 2 == 2)  # within that into the shard only
    share = Counter(r["later"] for r in rows)
    assert abs(share[5] / 4000 - 3 / 18) < 0.03 and abs(share[0] / 4000 - 1 / 18) < 0.02
    gone = {r["shard"] for r in hash_tree.place(ids, tree.weighted(7, 0.0)).collect()}
    assert gone == set(range(16)) - {7}
    grown = hash_tree.place(hash_tree.place(ids, tree), tree.grown(), shard="later").collect()
    into = [r for r in grown if r["shard"] != r["later"]]
    assert all(r["later"] == 16 for r in into) and abs(len(into) / 4000 - 1 / 17) < 0.02
    with pytest.raises(ValueError, match="different numbers"):
        hash_tree.Tree((("r", "k", 0, 1.0), ("r", "k", 0, 1.0)))


def test_slots_of_one_hot_key(spark):
    rows = spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    got = hash_tree.assign(rows).collect()
    assert sorted(r["slot"] for r in got) == list(range(5000)) and len({r["shard"] for r in got}) == 1


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(texts):
    count = Counter()
    for k, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += len(w) >= 7
    words = {w: n for w, n in count.items() if n >= 2}
    out = {}
    for w, n in words.items():
        mine = [x for x in words if near(w, x)]
        best = min(mine, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = [form, w, n, len(mine), words.get(form)]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


@pytest.fixture(scope="module")
def prose():
    rng, stems = random.Random(4), ["letterst", "strettle", "Éaßlettr", "aaaaaaaa", "ÀÉÎÕÜßÿ÷", "tsrettel", "lettrest"]
    texts = []
    for i in range(260):
        words = []
        for _ in range(rng.randint(1, 40)):
            w = rng.choices(stems, [400, 40, 40, 30, 30, 4, 4])[0]
            if rng.random() < 0.25:
                p, c = rng.randrange(len(w)), rng.choice("aelrstß×")
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + c + w[p:], w[:p] + c + w[p + 1 :], w.upper()])
            words.append(w)
        texts.append((i, rng.choice([" ", "-", "1"]).join(words)))
    return [*texts, (900, None), (901, ""), (902, "short words"), (None, "letterst letterst lettersx"), (1, texts[1][1]), (1, texts[1][1]), (903, "lettersts " * 12_000), *((920 + i, "letterstö " * 12 + "letterstöö") for i in range(5))]


@pytest.mark.parametrize("groups", [{}, {"replaced": 2, "inserted": 1}, {"replaced": 9, "inserted": 12}])
def test_spelling_variants(spark, prose, groups):
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(frame(spark, prose), **groups).collect()}
    want = brute_variants(prose)
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 5 and any(v[1] not in (w, v[0]) for w, v in want.items())


def test_spelling_variants_without_rows(spark, prose):
    docs = frame(spark, prose)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("doc_id = 902")).count() == 0


def test_every_near_pair_shares_a_signature(spark):
    rng = random.Random(2)
    words = list({"".join(rng.choice("abc") for _ in range(rng.randint(7, 8))) for _ in range(700)})
    vocabulary = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r["word"], r["near"]) for r in spelling.near_pairs(vocabulary).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}
