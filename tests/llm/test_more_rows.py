"""Training-data operators and pipeline stages on repeated rows, very long texts, empty tables and clashing columns."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, near_join, packing, quality, token_counts
from tests.llm.test_operators import CLASH, ITEMS, TEXTS, brute_hits

LONG = bpe.LONG


@pytest.fixture(scope="module")
def twice(spark):
    rows = [r for r in TEXTS.items() if r[0] not in (44, 47, 48)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_repeated_rows(spark, twice):
    n = twice.count()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute_hits(TEXTS, ITEMS)
    assert Counter(map(tuple, decontam.report(twice, bench).collect())) == Counter({(k, *v): 2 for k, v in want.items() if k not in (44, 47, 48)})
    counted = token_counts.count_edited(token_counts.sample_edits(twice)).collect()
    assert len(counted) == n and all(len({tuple(r) for r in counted if r["doc_id"] == k}) == 1 for k in (1, 40, 41))
    packed = packing.pack(twice).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("whole")).collect()
    assert all(r["n"] == 2 * r["whole"] for r in packed) and len(packed) == n // 2
    model = quality.RuleModel(list(quality.statistics()), bias=0.3)
    assert quality.score(twice, model).count() == n


def test_token_ids_of_very_long_texts(spark):
    encoder = bpe.encoder(bpe.default_path())
    texts = {0: "x" * (LONG + 5), 1: " " * (LONG + 5), 2: "word " * (LONG // 4), 3: "é" * LONG, 4: "a" * (LONG - 1)}
    packed = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for k, text in texts.items():
        ids = np.array([*encoder.whole.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r["start"], r["length"], r["ids_crc32"]) for r in packed if r["doc_id"] == k)
        assert sum(n for _, n, _ in mine) == len(ids) and all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in mine)


def test_rule_column_equals_the_model(spark):
    """The compiled column against the model's own prediction from the same statistics."""
    rng = random.Random(6)
    words = ["the", "cat", "BUY", "!!!", "123", "http://x.y", "é", "a\n", "\n\n", "lorem"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(300)] + [(900, None), (901, ""), (902, "w " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("BUY" not in t), 0) for i, t in rows[:300]], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    names = list(quality.statistics())
    x = quality.with_statistics(docs).select("d.doc_id", *(F.col(f"_s_{k}").alias(k) for k in names)).toPandas()
    want = dict(zip(x["doc_id"], model.predict(x[names].to_numpy(float)), strict=True))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(model.rules) > 0 and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stages")
    rows = [(k, v, "en", "s", None) for k, v in TEXTS.items() if k not in (47, 48)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in TEXTS], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, t) for i, t in ITEMS if i not in (3, 4)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return f"file://{path}", docs


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_repeated_and_clashing_rows(spark, tables, name):
    path, docs = tables
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    assert stage(spark, docs.limit(0), path).count() == 0
    clash = docs.unionByName(docs).withColumns({c: F.lit(7) for c in CLASH if c not in docs.columns})
    out = stage(spark, clash, path)
    if last:
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
        return
    assert out.columns == clash.columns
    kept = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    if name == "n-gram jaccard join":
        assert set(kept) == {v[0] for v in near_join.brute_force({k: v for k, v in TEXTS.items() if k not in (47, 48)}).values()}
        assert all(n == (2 if k in (40, 41, 42) else 1) for k, n in kept.items())  # texts without words are no copies of each other
    else:
        assert set(kept.values()) <= {2}
    assert out.filter("crc <> 7 OR row <> 7").count() == 0
