"""Removal of word passages that an earlier document already has, by suffix automata of reference spans.

A passage is ``n`` consecutive words; it goes from every document but the one with the least doc_id. References are the spans
(see ``spans``) whose anchor occurs in several documents; equal spans count once, for their first document. Documents with the
text of an earlier one lose every passage without a search. A shard holds the
spans of one anchor: a suffix automaton is built over them in document order, and each span is first streamed through the
automaton of the spans of smaller documents for its matching statistics; where these reach ``n``, a passage repeats. A shard
is sent to the task that streams its spans rather than broadcast to all, as all references together grow with the corpus.

Anchors with more than ``SHARD`` different spans (the borders of a very common passage) are settled by aggregations over
blocks of their windows, which need no bound on a shard, with equal results.

Defined results: null and empty texts have no words; texts under ``n`` words lose nothing; passages repeated within one
document only, or in rows of one doc_id, stay; an empty table gives an empty result; ``remove`` keeps extra columns.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import attach, covered, map_batches, materialize, restored, utf8
from millrace.llm.spans import by_document, candidates, collapse, open_spans, settle, settle_large, shards, with_texts

WORDS = 50
#: Spans of one anchor that one automaton is built over: some tens of MB.
SHARD = 1024


class SuffixAutomaton:
    """Substrings of several sequences of integers; transitions in dictionaries."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:  # another sequence has been here
            return known if self.length[known] == self.length[last] + 1 else self._split(last, c, known)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        half = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = half
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = half
            p = self.link[p]
        return half

    def statistics(self, sequence: list[int]) -> list[int]:
        """At each place, the length of the longest known substring that ends there."""
        state, size, out = 0, 0, []
        moves, link, length = self.next, self.link, self.length
        for c in sequence:
            while state and c not in moves[state]:
                state = link[state]
                size = length[state]
            to = moves[state].get(c)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            out.append(size)
        return out


def settle_shards(spans: DataFrame, n: int) -> DataFrame:
    """Rows (anchor, span, at): windows of a span, by place, that a smaller document has. One shard at a time is in memory."""

    def stream(shard: list[tuple]) -> list[tuple[int, int, int]]:
        automaton, out, waiting, last = SuffixAutomaton(), [], [], None
        for anchor, span, doc, words in shard:
            if doc != last:
                for w in waiting:
                    automaton.add(w)
                waiting, last = [], doc
            sequence = np.frombuffer(words, np.uint64).tolist()
            if len(automaton.next) > 1:
                out += [(anchor, span, i - n + 1) for i, size in enumerate(automaton.statistics(sequence)) if size >= n]
            waiting.append(sequence)
        return out

    return shards(spans, stream, ["anchor", "span", "doc_id", "data"], "anchor bigint, span bigint, at int", [pa.int64(), pa.int64(), pa.int32()])


def repeated_passages(docs: DataFrame, n: int = WORDS, shard: int = SHARD) -> DataFrame:
    """Rows (doc_id, crc, lo, hi): runs of words that go, of documents whose texts all differ."""
    found, kinds = candidates(docs, "word", n, n // 2, across=True)
    spans = open_spans(docs, kinds, "word", n)
    settled = settle_shards(spans.filter(F.col("kinds") <= shard), n)
    large = spans.filter(F.col("kinds") > shard)
    if large.limit(1).count():
        settled = settled.unionByName(settle_large(large, "word", n, n // 2, across=True).select("anchor", "span", "at"))
    settled = settled.groupBy("anchor", "span").agg(F.collect_list("at").alias("ats"))  # at most n - n / 2 + 1 places
    # every candidate meets its kind once; the written table serves both cases below
    first = kinds.select("anchor", "span", F.col("doc_id").alias("least"))
    placed = materialize(found.join(first, ["anchor", "span"]), "placed")
    later = placed.filter("doc_id > least").select("doc_id", "crc", F.col("first").alias("lo"), (F.col("first") + F.col("count") + (n - 1)).alias("hi"))
    own = placed.filter("doc_id = least").join(materialize(settled, "settled"), ["anchor", "span"]).select("doc_id", "crc", "first", F.explode("ats").alias("at"))
    return later.unionByName(own.select("doc_id", "crc", (F.col("first") + F.col("at")).alias("lo"), (F.col("first") + F.col("at") + n).alias("hi")))


def dedup(docs: DataFrame, n: int = WORDS, shard: int = SHARD) -> DataFrame:
    """Documents that lose words: doc_id, crc (of the text), n_removed, kept (remaining words joined by one space, as bytes)."""

    def run(batch: pa.RecordBatch) -> list:
        out = []
        for text, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = text.split()
            lo, hi = covered(np.array([p["lo"] for p in parts]), np.array([p["hi"] for p in parts]))
            edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(words)]
            left = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
            out.append((len(words) - len(left), b" ".join(left)))
        kinds = [pa.int64(), pa.binary()]
        return [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))]

    def lengths(batch: pa.RecordBatch) -> list:
        return [*batch.columns[:2], pa.array([len(t.split()) for t in batch.column(2).to_pylist()], pa.int64())]

    docs = docs.filter("doc_id IS NOT NULL")
    key = docs.schema["doc_id"].dataType.simpleString()
    each, many, copies = collapse(docs)
    texts = with_texts(each, by_document(repeated_passages(each, n, shard), "lo", "hi"))
    first = map_batches(texts, run, f"doc_id {key}, crc bigint, n_removed bigint, kept binary")
    # a copy has all its passages from the least document with its text
    later = materialize(copies.filter("doc_id > least").select("least", "crc", "doc_id").distinct(), "copies")
    long = map_batches(many, lengths, f"least {key}, crc bigint, n_removed bigint").filter(F.col("n_removed") >= n)
    gone = later.join(materialize(long, "long_copied"), ["least", "crc"])
    return first.unionByName(gone.select("doc_id", "crc", "n_removed", F.lit(b"").alias("kept")))


def digests(docs: DataFrame, n: int = WORDS, shard: int = SHARD) -> DataFrame:
    def run(batch: pa.RecordBatch) -> list:
        out = []
        for text in batch.column(1).to_pylist():
            words = text.split()
            out.append((zlib.crc32(text), len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        return [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.string()], strict=True))]

    changed = dedup(docs, n, shard).select("doc_id", "crc", "n_removed", F.sha2("kept", 256).alias("sha"))
    key = docs.schema["doc_id"].dataType.simpleString()
    every = map_batches(docs.select("doc_id", utf8("text").alias("text")), run, f"doc_id {key}, crc bigint, n_words bigint, sha string")
    return settle(every, changed).select("f.doc_id", "n_words", F.coalesce("x.n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("x.sha", "f.sha").alias("kept_sha256"))


def remove(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """Documents without their repeated passages: changed texts are the remaining words joined by one space."""
    changed = dedup(docs, n).select("doc_id", "crc", F.col("kept").cast("string").alias("kept")).dropDuplicates(["doc_id", "crc"])
    return attach(docs, changed).select(*restored(docs.columns, F.coalesce("x.kept", "d.text")))


def brute_force(texts: dict[int, str | None], n: int = WORDS) -> dict[int, tuple[int, int, str]]:
    """For tests: the least document of every window in a dictionary."""
    words = {k: (v or "").encode().split() for k, v in texts.items()}
    least: dict[tuple, int] = {}
    for k in sorted(words):
        for i in range(len(words[k]) - n + 1):
            least.setdefault(tuple(words[k][i : i + n]), k)
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if least[tuple(w[i : i + n])] < k:
                gone[i : i + n] = [True] * n
        out[k] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out
