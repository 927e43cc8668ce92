"""The pipeline over a small folder against stage-by-stage brute force."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from millrace.llm import near_join, substring_dedup
from tests.llm.test_operators import brute_hits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random.seed(8)
    path = tmp_path_factory.mktemp("sf")
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n)) + "."
    passage, item = text(70), text(25)
    docs = [(i, text(150), "en", "s", 0) for i in range(160)]
    docs += [(160, docs[3][1], "en", "s", 0), (161, docs[4][1] + " more", "en", "s", 0)]
    docs += [(162 + i, f"{text(60)} {passage} {text(60)}", "en", "s", 0) for i in range(3)]
    docs += [(170, f"{text(90)} {item} {text(90)}", "en", "s", 0), (171, item, "en", "s", 0), (172, None, "en", "s", None)]
    docs += [(200 + i, "SPAM!!! " * (20 + i), "en", "s", 0) for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, *_ in docs if i < 150 or i >= 200], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return f"file://{path}", item


def test_stages(spark, folder):
    path, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (docs, out))
        kept.append((before, after))
        docs = spark.createDataFrame(out.collect(), out.schema)
    (a0, a1), (b0, b1), (c0, c1), (d0, d1) = kept
    assert not [k for k in a1 if k >= 200] and [k for k in a1 if k < 170] == [k for k in a0 if k < 170]
    assert set(b1) == {v[0] for v in near_join.brute_force(b0).values()} and 160 not in b1 and 161 not in b1
    want = substring_dedup.brute_force(c0)
    assert all(len((c1[k] or "").split()) == v[0] - v[1] for k, v in want.items()) and sum(v[1] > 0 for v in want.values()) == 2
    hit = brute_hits(d0, [(1, item)])
    assert set(d1) == {k for k, v in hit.items() if v[1] <= 0.5 * v[0]} and 171 not in d1
    assert brute_hits(d1, [(1, item)])[170][1] == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r["doc_id"] for r in packed} == set(d1)


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).count() > 100
