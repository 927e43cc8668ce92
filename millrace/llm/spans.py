"""Candidate search for repeated windows of fixed length: content-chosen anchors instead of every position.

Each document is a sequence of units (bytes or words). Of every window of ``n`` units the anchor is the leftmost gram of ``k``
units with the least hash. Equal windows have equal anchors at equal offsets, so a window can only be repeated where its
anchor is. Windows that share an anchor are consecutive; such a run with all its units is a *span*, and documents shrink to
about 2 / (n - k) spans a unit. The choice drops nothing: every window lies in exactly one span.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import RollingHash, map_batches, materialize, mix64, utf8, window_minima, word_hashes


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def units_of(data: bytes, unit: str) -> np.ndarray:
    """Hash of each unit; words are runs of bytes between ASCII blanks."""
    return word_hashes(data.split()) if unit == "word" else byte_values()[np.frombuffer(data, np.uint8)]


def spans_of(units: np.ndarray, n: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, span identity, first window, number of windows) of each span of one document."""
    if len(units) < n:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    rolling = RollingHash(units)
    grams = rolling.every(k)
    at = window_minima(grams, n - k + 1)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    count = np.diff(np.append(first, len(at)))
    anchor = grams[at[first]]
    shape = mix64((at[first] - first).astype(np.uint64) * np.uint64(1 << 32) + count.astype(np.uint64))
    identity = mix64(rolling.of(first, count + n - 1) ^ shape)
    return anchor.view(np.int64), identity.view(np.int64), first, count


def find_spans(docs: DataFrame, unit: str, n: int, k: int) -> DataFrame:
    """Rows (anchor, span, doc_id, crc, first, count); ``crc`` tells texts (no nulls) under one doc_id apart."""

    def run(batch: pa.RecordBatch) -> list:
        data = batch.column(1).to_pylist()
        found = [spans_of(units_of(x, unit), n, k) for x in data]
        sizes = np.array([len(f[0]) for f in found])
        rows = np.repeat(np.arange(len(data)), sizes)
        column = lambda i: np.concatenate([f[i] for f in found])
        crc = np.array([zlib.crc32(x) for x in data], np.int64)
        return [column(0), column(1), batch.column(0).take(pa.array(rows)), crc[rows], column(2).astype(np.int32), column(3).astype(np.int32)]

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, f"anchor bigint, span bigint, doc_id {key}, crc bigint, first int, count int")


def candidates(docs: DataFrame, unit: str, n: int, k: int, across: bool) -> tuple[DataFrame, DataFrame]:
    """Spans whose anchor is repeated (``across``: in documents of different id), and one row for each kind of span.

    Kinds have (anchor, span, copies, doc_id, crc, first, count) of their first occurrence by doc_id.
    """
    spans = materialize(find_spans(docs, unit, n, k), "spans")
    if across:
        repeated = spans.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("anchor")
    else:
        repeated = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    # a written table leaves both sides of the join as plain shuffles, of which Spark splits large partitions
    found = materialize(spans.join(materialize(repeated, "repeated"), "anchor", "left_semi"), "candidates")
    kinds = found.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "crc", "first", "count")).alias("x"))
    return found, materialize(kinds.select("anchor", "span", "copies", "x.*"), "kinds")


def by_document(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per (doc_id, crc) with the columns as an array of structs ``parts``; at most a few for each unit of the text."""
    return rows.groupBy("doc_id", "crc").agg(F.collect_list(F.struct(*columns)).alias("parts"))


#: Slots of the document filter below: at most so many numbers are broadcast, whatever the corpus.
SLOTS = 1 << 20


def with_texts(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents (doc_id, crc, text as bytes) that have parts, with these; matched on doc_id and checksum.

    Texts are shuffled for documents only whose slot (a hash of id and checksum) is taken by one with parts.
    """
    parts = materialize(parts, "parts")
    slot = lambda: F.pmod(F.xxhash64("doc_id", "crc"), F.lit(SLOTS)).alias("slot")
    taken = F.broadcast(parts.select(slot()).distinct())
    d = docs.select("doc_id", utf8("text").alias("text")).withColumn("crc", F.crc32("text")).withColumn("slot", slot())
    d, p = d.join(taken, "slot", "left_semi").alias("d"), parts.alias("p")
    return d.join(p, F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.crc") == F.col("p.crc"))).select("d.doc_id", "d.crc", "d.text", "p.parts")


TEXT_KEY = ["hash", "crc", "bytes"]


def collapse(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each different text once (doc_id, text), under its least doc_id; of these, all that have copies; rows with copies.

    The last are (doc_id, crc, bytes, least); the least document's own rows are among them. Copies stay out of the
    search for spans, where a large group of them would make rows for each span of each copy. Texts are shuffled, combined
    first, only where their slot is taken by a text with copies.
    """
    slot = F.pmod(F.xxhash64(*TEXT_KEY), F.lit(SLOTS)).alias("slot")
    text = utf8("text")
    d = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"), F.crc32(text).alias("crc"), F.octet_length(text).alias("bytes"))
    keys = materialize(d.select("doc_id", *TEXT_KEY), "text_keys")
    groups = keys.groupBy(*TEXT_KEY).agg(F.count(F.lit(1)).alias("text_rows"), F.min("doc_id").alias("least")).filter("text_rows > 1")
    groups = materialize(groups, "copied")
    taken = F.broadcast(groups.select(slot).distinct())
    d = d.withColumn("slot", slot)
    many = d.join(taken, "slot", "left_semi").groupBy(*TEXT_KEY).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    many = materialize(many.select("doc_id", "crc", "text"), "copied_texts")
    each = d.join(taken, "slot", "left_anti").select("doc_id", "text").unionByName(many.select("doc_id", "text"))
    return each, many, keys.join(groups, TEXT_KEY).select("doc_id", "crc", "bytes", "least")


def settle(found: DataFrame, changed: DataFrame) -> DataFrame:
    """All documents of ``found`` (doc_id, crc, ..), each with its row of ``changed``, if any, as a struct ``x``."""
    c = changed.dropDuplicates(["doc_id", "crc"]).select(F.struct("*").alias("x")).alias("c")
    f = found.alias("f")
    return f.join(c, F.col("f.doc_id").eqNullSafe(F.col("c.x.doc_id")) & (F.col("f.crc") == F.col("c.x.crc")), "left")


def open_spans(docs: DataFrame, kinds: DataFrame, unit: str, n: int) -> DataFrame:
    """Kinds of span whose anchor has several, with their units: (anchor, span, copies, kinds, doc_id, crc, first, count, data).

    ``data`` has the bytes of a span, or the 8-byte hashes of its words.
    """

    def run(batch: pa.RecordBatch) -> list:
        rows = []
        for doc, crc, text, parts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data, width = (units_of(text, "word").tobytes(), 8) if unit == "word" else (text, 1)
            rows += [
                (p["anchor"], p["span"], p["copies"], p["kinds"], doc, crc, p["first"], p["count"], data[width * p["first"] : width * (p["first"] + p["count"] + n - 1)])
                for p in parts
            ]
        types = [pa.int64()] * 4 + [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]

    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    texts = with_texts(docs, by_document(kinds.join(several, "anchor"), "anchor", "span", "copies", "kinds", "first", "count"))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"anchor bigint, span bigint, copies bigint, kinds bigint, doc_id {key}, crc bigint, first int, count int, data binary"
    return materialize(map_batches(texts, run, schema), "open_spans")


def rolling_of(data: bytes, unit: str) -> RollingHash:
    return RollingHash(np.frombuffer(data, np.uint64) if unit == "word" else units_of(data, "byte"))


def halve(live: DataFrame, unit: str, n: int, k: int, size: int) -> DataFrame:
    """Cut the windows of each span, by their distance to the anchor, into blocks of ``size``.

    k1, k2 name the units that all windows of a block have in common: n - size + 1 of them, so names grow as blocks shrink,
    and a block of one window is named by all its units. ``off`` is the anchor's place in the span (-1: not known yet).
    """
    names = ["anchor", "span", "copies", "doc_id", "crc", "first", "count", "data", "off", "begin"]

    def run(batch: pa.RecordBatch) -> list:
        anchors, counts, datas, offs, starts = (batch.column(names.index(c)).to_pylist() for c in ("anchor", "count", "data", "off", "begin"))
        rows, at, begins, k1, k2 = [], [], [], [], []
        for i, (anchor, count, data, off, begin) in enumerate(zip(anchors, counts, datas, offs, starts, strict=True)):
            rolling = rolling_of(data, unit)
            if off < 0:
                off = int(np.argmax(rolling.every(k) == np.uint64(anchor & 0xFFFFFFFFFFFFFFFF)))
            for b in (begin, begin + size):
                if off - count + 1 < b + size and b <= off:
                    # a window at distance d begins d units before the anchor
                    lo, length = off - b, n - size + 1
                    half = length // 2
                    rows.append(i)
                    at.append(off)
                    begins.append(b)
                    k1.append(rolling.of(np.array([lo]), half)[0])
                    k2.append(rolling.of(np.array([lo + half]), length - half)[0])
        take = pa.array(rows, pa.int64())
        longs = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (k1, k2)]
        return [*(batch.column(c).take(take) for c in range(8)), pa.array(at, pa.int32()), pa.array(begins, pa.int32()), *longs]

    key = live.schema["doc_id"].dataType.simpleString()
    return map_batches(
        live.select(*names), run,
        f"anchor bigint, span bigint, copies bigint, doc_id {key}, crc bigint, first int, count int, data binary, off int, begin int, k1 bigint, k2 bigint",
    )


def settle_large(spans: DataFrame, unit: str, n: int, k: int, across: bool) -> DataFrame:
    """Windows (anchor, span, doc_id, crc, first, at) of open spans that are repeated, for anchors with any number of kinds.

    Rounds of names that grow; after each, blocks whose name is unique (``across``: to one doc_id) are dropped. ``at`` is the
    window's place in its span. With ``across``, windows of the least document aren't returned.
    """
    size = 1
    while size < n - k + 1:
        size *= 2
    live = spans.withColumn("off", F.lit(-1)).withColumn("begin", F.lit(0))
    name = ["begin", "k1", "k2"]
    while size > 1:
        size //= 2
        cut = materialize(halve(live, unit, n, k, size), "blocks")
        if across:
            common = cut.groupBy(*name).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
        else:
            common = cut.groupBy(*name).agg(F.sum("copies").alias("n")).filter("n > 1")
        live = cut.join(materialize(common, "common"), name)
    if across:
        live = live.filter("doc_id > least")
    return live.select("anchor", "span", "doc_id", "crc", "first", (F.col("off") - F.col("begin")).alias("at"))


def shards(spans: DataFrame, f, columns: list[str], schema: str, types: list[pa.DataType]) -> DataFrame:
    """``f`` over the spans of one anchor at a time, which come sorted by doc_id; its rows make the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        out: list[tuple] = []

        def pack() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(types), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if shard and shard[0][0] != row[0]:
                    out += f(shard)
                    shard = []
                shard.append(row)
            if len(out) > 50_000:
                yield pack()
        if shard:
            out += f(shard)
        yield pack()

    return spans.select(*columns).repartition(F.col("anchor")).sortWithinPartitions("anchor", "doc_id", "span").mapInArrow(run, schema)
