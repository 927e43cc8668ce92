"""Exact removal of repeated byte strings by hashes of windows at anchors.

Prefixes of ``n / 2`` bytes at anchor positions (see ``spans``) are named first, and what is unique is dropped. Spans that
occur twice as a whole are settled there. For what is left, both halves of each window get rolling hashes straight from the
text, and one sort of the pairs inside a task per anchor marks equal pairs: repeated windows. No rank is made from earlier
ranks, so this isn't prefix doubling. Anchors with more than ``SHARD`` kinds of span name ever longer pieces by hash, each
round a grouping by Spark that drops unique names (``spans.settle_large``).

Names are 64-bit hashes of byte strings, so nothing needs a global numbering.

Defined results: null or empty texts and texts under ``n`` bytes lose nothing; of repeated strings every copy goes, also
within one document and in repeated rows; an empty table gives an empty result; extra columns are ignored (``dedup``) or kept
(``remove``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import attach, covered, map_batches, materialize, restored, utf8
from millrace.llm.spans import by_document, candidates, collapse, open_spans, rolling_of, settle, settle_large, shards, with_texts

LENGTH = 400
#: Spans of one anchor that one task ranks in memory: some tens of MB.
SHARD = 4096


def settle_shards(spans: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, crc, lo, hi): repeated windows of single spans, by rank pairs within the spans of one anchor."""

    def rank(shard: list[tuple]) -> list[tuple]:
        pairs, half = [], n // 2
        for _, _, _, _, count, data, _ in shard:
            rolling, at = rolling_of(data, "byte"), np.arange(count)
            # the rank at a window's place and the rank half a window on
            pairs.append(np.stack([rolling.of(at, half), rolling.of(at + half, n - half)], 1))
        owner = np.repeat(np.arange(len(shard)), [len(p) for p in pairs])
        both = np.concatenate(pairs)
        order = np.lexsort((both[:, 1], both[:, 0]))
        ranked = both[order]
        same = (ranked[1:] == ranked[:-1]).all(axis=1)
        repeated = np.zeros(len(both), bool)
        repeated[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        out = []
        begin = np.cumsum([0, *(len(p) for p in pairs)])
        for i in np.unique(owner[repeated]).tolist():
            _, doc, crc, first, count, _, copies = shard[i]
            if copies == 1:
                mark = np.concatenate(([False], repeated[begin[i] : begin[i + 1]], [False])).astype(np.int8)
                for lo, hi in zip(np.flatnonzero(np.diff(mark) > 0).tolist(), np.flatnonzero(np.diff(mark) < 0).tolist(), strict=True):
                    out.append((doc, crc, first + lo, first + hi - 1 + n))
        return out

    key = spans.schema["doc_id"].dataType
    schema = f"doc_id {key.simpleString()}, crc bigint, lo int, hi int"
    return shards(spans, rank, ["anchor", "doc_id", "crc", "first", "count", "data", "copies"], schema, [to_arrow_type(key), pa.int64(), pa.int32(), pa.int32()])


def repeated_windows(docs: DataFrame, n: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Rows (doc_id, crc, lo, hi): runs of bytes covered by repeated windows, possibly overlapping."""
    found, kinds = candidates(docs, "byte", n, n // 2, across=False)
    whole = found.join(kinds.filter("copies > 1").select("anchor", "span"), ["anchor", "span"], "left_semi")
    out = whole.select("doc_id", "crc", F.col("first").alias("lo"), (F.col("first") + F.col("count") + (n - 1)).alias("hi"))
    spans = open_spans(docs, kinds, "byte", n)
    out = out.unionByName(settle_shards(spans.filter(F.col("kinds") <= shard), n))
    large = spans.filter(F.col("kinds") > shard)
    if large.limit(1).count():
        rest = settle_large(large, "byte", n, n // 2, across=False).join(kinds.filter("copies = 1").select("anchor", "span"), ["anchor", "span"], "left_semi")
        lo = F.col("first") + F.col("at")
        out = out.unionByName(rest.select("doc_id", "crc", lo.alias("lo"), (lo + n).alias("hi")))
    return out


def runs_of(parts: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return covered(np.array([p["lo"] for p in parts]), np.array([p["hi"] for p in parts]))


def without(data: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def dedup(docs: DataFrame, n: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Documents that lose bytes: doc_id, crc (of the text), n_removed, n_spans, kept (bytes that remain)."""

    def run(batch: pa.RecordBatch) -> list:
        out = []
        for text, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            lo, hi = runs_of(parts)
            out.append((int((hi - lo).sum()), len(lo), without(text, lo, hi)))
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))]

    key = docs.schema["doc_id"].dataType.simpleString()
    each, _, copies = collapse(docs)
    # every string of a text with copies starts elsewhere too
    gone = materialize(copies.filter(F.col("bytes") >= n).select("doc_id", "crc", F.col("bytes").cast("long").alias("n_removed")).distinct(), "copies")
    parts = by_document(repeated_windows(each, n, shard), "lo", "hi").alias("p")
    parts = parts.join(gone.alias("g"), F.col("p.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("p.crc") == F.col("g.crc")), "left_anti")
    first = map_batches(with_texts(each, parts), run, f"doc_id {key}, crc bigint, n_removed bigint, n_spans bigint, kept binary")
    return first.unionByName(gone.select("*", F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")))


def digests(docs: DataFrame, n: int = LENGTH, shard: int = SHARD) -> DataFrame:
    changed = dedup(docs, n, shard).select("doc_id", "crc", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    text = utf8("text")
    every = docs.select("doc_id", F.crc32(text).alias("crc"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    zero = F.lit(0).cast("long")
    return settle(every, changed).select(
        "f.doc_id", "n_bytes", F.coalesce("x.n_removed", zero).alias("n_removed"), F.coalesce("x.n_spans", zero).alias("n_spans"),
        F.coalesce("x.sha", "sha").alias("kept_sha256"),
    )


def remove(docs: DataFrame, n: int = LENGTH) -> DataFrame:
    """Documents without repeated byte strings, all columns kept; a cut may fall inside a character, whose rest is replaced."""
    changed = dedup(docs, n).select("doc_id", "crc", F.decode("kept", "UTF-8").alias("kept")).dropDuplicates(["doc_id", "crc"])
    return attach(docs, changed).select(*restored(docs.columns, F.coalesce("x.kept", "d.text")))


def brute_force(texts: dict[int, str | None], n: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """For tests: every window in a dictionary."""
    seen: dict[bytes, int] = {}
    data = {k: (v or "").encode() for k, v in texts.items()}
    for b in data.values():
        for i in range(len(b) - n + 1):
            seen[b[i : i + n]] = seen.get(b[i : i + n], 0) + 1
    out = {}
    for k, b in data.items():
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                mark[i : i + n] = True
        kept = np.frombuffer(b, np.uint8)[~mark].tobytes()
        out[k] = (len(b), int(mark.sum()), int((mark & ~np.concatenate(([False], mark[:-1]))).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest())
    return out
