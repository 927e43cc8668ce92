"""Ranked lexical search by scanning documents with an automaton of all item terms; no index of the documents is made.

A term is a maximal run of digits, letters and non-ASCII characters, lower-cased A-Z only. Items go in blocks whose terms hold at
most ``BLOCK_BYTES``, so what travels to the tasks is bounded however many items there are (a single longer item is a block).
For each block an Aho-Corasick automaton holds every term between two guards: separators become one guard byte, so a pattern
``guard term guard`` matches whole terms only, and neighbours share a guard because the automaton reports overlapping matches.

Two scans a block: the first counts documents holding each term; N and L are counted once for all blocks. The second knows the
weights, scores each document for all items of the block (an automaton output leads from a term to the items that hold it), and
keeps the best of its partition. The best of all partitions are ranked within hash buckets of an item first, then by item.
A task holds the scores of ``common.SLICE`` documents and the ``top`` best of each item.

Defined results: null or empty texts have no terms (such a document counts in no statistic, such an item has no rows); repeated
documents are ranked each; equal scores go by ascending doc_id, null ids last; repeated or null item_ids are items of their own,
each with its ranks; without documents or items there are no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SLICE, materialize

TOP = 50
BLOCK_BYTES = 2_000_000
#: Hash buckets in which the best of an item are ranked before they meet.
BUCKETS = 64
#: A document's terms, as bytes: A-Z lower-cased, other ASCII but digits and letters a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class Block:
    """Items of a bounded number of bytes: their different terms, and for each item the numbers of its terms."""

    def __init__(self) -> None:
        self.items: list[int] = []
        self.number: dict[bytes, int] = {}
        self.of_item: list[list[int]] = []
        self.size = 0

    def add(self, no: int, terms: list[bytes]) -> None:
        self.items.append(no)
        self.of_item.append([self.number.setdefault(t, len(self.number)) for t in terms])
        self.size += sum(map(len, terms))

    def arrays(self) -> dict:
        """What the tasks need: terms in order of number; terms of all items end to end with their starts."""
        lengths = [len(x) for x in self.of_item]
        return {
            "terms": list(self.number), "items": np.array(self.items, np.int64), "flat": np.array([t for x in self.of_item for t in x], np.int64),
            "starts": np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64),
        }


def blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Blocks of the rows (no, text); the driver holds one at a time."""
    block = Block()
    for row in items.toLocalIterator():
        terms = list(dict.fromkeys(terms_of(row["text"])))
        if not terms:
            continue
        if block.items and block.size + sum(map(len, terms)) > most:
            yield block
            block = Block()
        block.add(row["no"], terms)
    if block.items:
        yield block


def automaton(terms: list[bytes]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word(f" {term.decode('latin-1')} ", i)
    out.make_automaton()
    return out


@lru_cache(1)
def worker_automaton(key: str, block):
    """The block's automaton, built once in a Python worker."""
    return automaton(block.value["terms"])


class Broadcast:
    """A broadcast block that hashes by its key, so that a worker builds its automaton once."""

    def __init__(self, key: str, block):
        self.key, self.block = key, block

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return self.key == other.key

    @property
    def value(self):
        return self.block.value


def counted(scan, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms in a folded text and how often each occurs."""
    found = Counter(map(itemgetter(1), scan.iter(f" {data.decode('latin-1')} ")))
    return np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        text = batch.column("text").cast(pa.binary())
        yield batch.column("doc_id"), [(t.as_py() or b"").translate(FOLD) for t in text]


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""

    def run(batches):
        n = total = 0
        for _, texts in folded(batches):
            sizes = [len(t.split()) for t in texts]
            n, total = n + sum(x > 0 for x in sizes), total + sum(sizes)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])

    row = docs.mapInArrow(run, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return int(row["n"] or 0), int(row["total"] or 0)


def document_frequencies(docs: DataFrame, shared: Broadcast, width: int) -> np.ndarray:
    """For each term of the block the documents that hold it."""

    def run(batches):
        scan, df = worker_automaton(shared.key, shared), np.zeros(width, np.int64)
        for _, texts in folded(batches):
            for t in texts:
                df[counted(scan, t)[0]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    out = np.zeros(width, np.int64)
    for row in docs.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[row["term"]] = row["df"]
    return out


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


class Best:
    """The ``top`` best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.score = [np.zeros(0, np.int64)] * items
        self.doc = [np.zeros(0, np.int64)] * items
        self.null = [np.zeros(0, bool)] * items

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores``: a row for each document, a column for each item."""
        for j in range(scores.shape[1]):
            full = len(self.score[j]) >= self.top
            rows = np.flatnonzero(scores[:, j] >= (self.score[j][-1] if full else 1))
            if len(rows):
                s, d, z = (np.concatenate(x) for x in ((self.score[j], scores[rows, j]), (self.doc[j], doc[rows]), (self.null[j], null[rows])))
                order = np.lexsort((d, z, -s))[: self.top]
                self.score[j], self.doc[j], self.null[j] = s[order], d[order], z[order]


def best_of_parts(docs: DataFrame, shared: Broadcast, w: np.ndarray, n_docs: int, total: int, top: int) -> DataFrame:
    """Rows (no, doc_id, score): for each partition the best documents of each item."""

    def run(batches):
        block, scan = shared.value, worker_automaton(shared.key, shared)
        best, row = Best(len(block["items"]), top), np.zeros(len(w), np.int64)
        for ids, texts in folded(batches):
            scores = np.zeros((len(texts), len(block["items"])), np.int64)
            for i, t in enumerate(texts):
                term, tf = counted(scan, t)
                if len(term):
                    m = 100 - 50 + (50 * len(t.split()) * n_docs) // total
                    row[term] = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                    scores[i] = np.add.reduceat(row[block["flat"]], block["starts"])
                    row[term] = 0
            null = np.asarray(ids.is_null())
            best.add(scores, ids.cast(pa.int64()).fill_null(0).to_numpy(), null)
        for no, s, d, z in zip(block["items"], best.score, best.doc, best.null, strict=True):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), no)), pa.array(d, mask=z), pa.array(s)], names=["no", "doc_id", "score"])

    return docs.mapInArrow(run, "no long, doc_id long, score long")


def ranked(candidates: DataFrame, top: int) -> DataFrame:
    """The best of each item, ranked from 1: first within buckets of an item, so that no task holds all its candidates."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = candidates.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("no", "bucket").orderBy(*order))).filter(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(*order))).filter(F.col("rank") <= top).drop("bucket")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each item its ``top`` best documents with a score above 0."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    asked = materialize(items.select(F.monotonically_increasing_id().alias("no"), "item_id", "text"), "items")
    n_docs, total = corpus_size(docs)
    found = None
    for i, block in enumerate(blocks(asked.select("no", "text"), block_bytes) if n_docs else ()):
        value = block.arrays()
        shared = Broadcast(f"{spark.sparkContext.applicationId}-{id(value)}-{i}", spark.sparkContext.broadcast(value))
        w = weights(document_frequencies(docs, shared, len(value["terms"])), n_docs)
        best = materialize(ranked(best_of_parts(docs, shared, w, n_docs, total, top), top), "ranked")
        found = best if found is None else found.unionByName(best)
        shared.block.unpersist()
    if found is None:
        found = spark.createDataFrame([], "no long, doc_id long, score long, rank int")
    return found.join(asked.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")


def brute_force(texts: list[tuple[int | None, str | None]], items: list[tuple[int | None, str | None]], top: int = TOP) -> list[tuple]:
    """Every document against every item, one pair at a time."""
    import math
    import re

    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    cut = lambda t: pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = [(k, Counter(cut(t))) for k, t in texts]
    docs = [(k, c) for k, c in docs if c]
    n_docs, total, df = len(docs), sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for k, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(cut(text)) if c[t])
            if s > 0:
                scored.append((-s, k is None, k or 0, k))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return out


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_TERM}) AS t FROM documents),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, {_TERM})) AS term FROM benchmark),
o AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
f AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term),
s AS (SELECT item_id, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // total))))::BIGINT AS score
  FROM f JOIN w USING (term) JOIN q USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {TOP}
"""
