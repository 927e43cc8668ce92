"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents are sets of word shingles (``SHINGLE`` words; a shorter text is one shingle). Documents of equal sets are one node.
MinHash bands make buckets of nodes; of a candidate pair the MinHash values are compared a few at a time, and the pair is
dropped as soon as the posterior probability that its similarity reaches the threshold falls below ``TOLERANCE``; what is left
is verified exactly on the texts. MinHash values are kept as one byte each, so agreement has a chance part of 1/256, which the
posterior takes into account.

No bucket or group is expanded into pairs of rows:

1. a node is compared with the first nodes of the buckets it shares most; verified links make first classes;
2. buckets that still hold several classes are cut into chunks, and pairs of chunks are compared in blocks, across classes
   only; a block verifies what passes and returns the links that join classes;
3. within a class, blocks of texts are compared exactly with each other to count each node's links.

A link is lost only if its nodes share none of the ``BANDS`` buckets (chance under 1e-7 at similarity 0.8) or by the tolerance.

Defined results: null, empty and blank texts have no shingles, no links and are classes of their own, as are rows without
doc_id (class null); repeated rows are copies of each other; ties take the least doc_id; extra columns are ignored by ``join``
and kept by ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import RollingHash, attach, map_batches, materialize, mix64, restored, utf8, word_hashes
from millrace.llm.graph import components
from millrace.llm.spans import with_texts

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, STEP = 32, 4, 16
CHUNK, BLOCK = 512, 256
#: Leads that a node is compared with first (of at most ``BANDS``).
LEADS = 3


@lru_cache(1)
def multipliers() -> np.ndarray:
    return mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = word_hashes(text.split())
    if not len(words):
        return words
    return np.unique(RollingHash(words).every(min(size, len(words))) ^ np.uint64(min(size, len(words))))


def signature(x: np.ndarray) -> np.ndarray:
    """MinHash values (64 bits each) of a shingle set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), 1024):
        np.minimum(least, (x[i : i + 1024, None] * multipliers()).min(axis=0), out=least)
    return least


@lru_cache(8)
def least_agreements(threshold: float, tolerance: float) -> np.ndarray:
    """For 0, 1, .. compared values: the least number of agreements with which a pair stays.

    Uniform prior over the similarity s; a value agrees with probability s + (1 - s) / 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = np.zeros(BANDS * ROWS + 1, int)
    for n in range(1, BANDS * ROWS + 1):
        for m in range(n + 1):
            weight = np.exp(m * np.log(p) + (n - m) * np.log1p(-p) - (m * np.log((m + 1e-9) / n) + (n - m) * np.log((n - m + 1e-9) / n) if 0 < m < n else 0))
            if weight[s >= threshold].sum() >= tolerance * weight.sum():
                break
        out[n] = m
    return out


def surviving(a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which rows of two matrices of MinHash bytes may still reach the threshold, compared ``STEP`` values at a time."""
    alive, agree = np.arange(len(a)), np.zeros(len(a), int)
    for n in range(0, a.shape[1], STEP):
        agree = agree + (a[alive, n : n + STEP] == b[alive, n : n + STEP]).sum(axis=1)
        keep = agree >= least_agreements(threshold, tolerance)[n + STEP]
        alive, agree = alive[keep], agree[keep]
    return alive


def sketch(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, crc, s1, s2, n, bytes, keys): identity of the shingle set, its size, MinHash bytes and band keys."""

    def run(batch: pa.RecordBatch) -> list:
        data = batch.column(1).to_pylist()
        s1, s2, n, packed, keys = [], [], [], [], []
        for text in data:
            x = shingles(text, size)
            n.append(len(x))
            s1.append(int(x.sum(dtype=np.uint64)) if len(x) else 0)
            s2.append(int(mix64(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) if len(x) else 0)
            if len(x):
                least = signature(x)
                packed.append((least >> np.uint64(32)).astype(np.uint8).tobytes())
                grouped = mix64(least).reshape(BANDS, ROWS)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix64(key * np.uint64(31) + grouped[:, r])
                keys.append(key.view(np.int64))
            else:
                packed.append(b"")
                keys.append(np.zeros(0, np.int64))
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        longs = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
        return [
            batch.column(0), pa.array([zlib.crc32(t) for t in data], pa.int64()), longs(s1), longs(s2), pa.array(n, pa.int32()), pa.array(packed, pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys))),
        ]

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", utf8("text").alias("text")), run, f"doc_id {key}, crc bigint, s1 bigint, s2 bigint, n int, bytes binary, keys array<bigint>")


def prune(pairs: DataFrame, nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Pairs (a, b) that the Bayesian comparison of their MinHash bytes leaves."""
    x, y = nodes.select(F.col("node").alias("a"), F.col("bytes").alias("x")), nodes.select(F.col("node").alias("b"), F.col("bytes").alias("y"))

    def run(batch: pa.RecordBatch) -> list:
        matrix = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        keep = pa.array(surviving(matrix(2), matrix(3), threshold, tolerance))
        return [batch.column(0).take(keep), batch.column(1).take(keep)]

    return map_batches(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y"), run, "a bigint, b bigint")


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def verify(pairs: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """Pairs (a, b) whose exact Jaccard similarity reaches the threshold. Pairs of one a are dealt to as many tasks as needed."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(64)))
    second = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    first = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, x = None, None
        for batch in batches:
            out = []
            for node, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text")), strict=True):
                y = shingles(text, size)
                if b is None:
                    a, x = node, y
                else:
                    both = shared(x, y)
                    if both >= threshold * (len(x) + len(y) - both):
                        out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), ()))], names=["a", "b"])

    order = second.unionByName(first).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return order.mapInArrow(run, "a bigint, b bigint")


def across_classes(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float, tolerance: float, size: int) -> DataFrame:
    """Links (a, b) between nodes of different classes that share a bucket: pruned by MinHash bytes, verified in the block.

    Of the links of a block only those are returned that join classes which the block's links before them don't join.
    """
    placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key", "n")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    rows = placed.join(mixed, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    # a chunk meets every chunk once: it is row side of the blocks from its number on and column side of those before
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    rows = rows.select("key", "node", "label", "chunk", other.alias("other")).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "label", "chunk"
    )
    rows = rows.join(nodes.select("node", "bytes"), "node").join(texts, "node")

    def compare(block: list[tuple]) -> list[tuple[int, int]]:
        i, j = block[0][1], block[0][2]
        left = [r for r in block if r[6] == i]
        right = left if i == j else [r for r in block if r[6] == j]
        if not left or not right:
            return []
        matrix = lambda rows: np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        x, y = matrix(left), matrix(right)
        classes, order = np.array([r[4] for r in right]), np.arange(len(right))
        pairs = []
        for k, r in enumerate(left):
            others = np.flatnonzero((classes != r[4]) & (order > (k if i == j else -1)))
            if len(others):
                pairs.append((k, others[surviving(np.broadcast_to(x[k], (len(others), x.shape[1])), y[others], threshold, tolerance)]))
        pairs = [(k, alive) for k, alive in pairs if len(alive)]
        if not pairs:
            return []
        ks, vs = [k for k, _ in pairs], np.unique(np.concatenate([alive for _, alive in pairs]))
        one, two = [shingles(left[k][7], size) for k in ks], [shingles(right[v][7], size) for v in vs.tolist()]
        both = intersections(one, two)
        a, b = np.array([len(s) for s in one]), np.array([len(s) for s in two])
        linked = both >= threshold * (a[:, None] + b[None, :] - both)
        top: dict[int, int] = {}

        def find(label: int) -> int:
            while top.get(label, label) != label:
                label = top[label]
            return label

        out = []
        for p, (k, alive) in enumerate(pairs):
            for v in alive[linked[p, np.searchsorted(vs, alive)]].tolist():
                m, n = find(left[k][4]), find(right[v][4])
                if m != n:
                    top[max(m, n)] = min(m, n)
                    out.append((left[k][3], right[v][3]))
        return out

    order = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return by_block(order, compare, ["key", "i", "j", "node", "label", "bytes", "chunk", "text"], "a bigint, b bigint").distinct()


def by_block(rows: DataFrame, f, columns: list[str], schema: str) -> DataFrame:
    """``f`` over each run of rows that agree in the first three columns; rows come sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        out: list[tuple[int, int]] = []

        def pack() -> pa.RecordBatch:
            arrays = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), ()))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[p.split()[0] for p in schema.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if block and block[0][:3] != row[:3]:
                    out += f(block)
                    block = []
                block.append(row)
            if len(out) > 50_000:
                yield pack()
        if block:
            out += f(block)
        yield pack()

    return rows.select(*columns).mapInArrow(run, schema)


def count_links(labels: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """Rows (node, links): exact similarities within each class, in blocks of ``BLOCK`` nodes."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = labels.join(sizes, "label").withColumn("chunk", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.select("label", "node", "chunk", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "label", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "chunk"
    )

    def count(block: list[tuple]) -> list[tuple[int, int]]:
        i, j = block[0][1], block[0][2]
        sets = [shingles(r[5], size) for r in block]
        left = [k for k, r in enumerate(block) if r[4] == i]
        right = left if i == j else [k for k, r in enumerate(block) if r[4] == j]
        if not left or not right:
            return []
        both = intersections([sets[k] for k in left], [sets[k] for k in right])
        a, b = (np.array([len(sets[k]) for k in side]) for side in (left, right))
        linked = both >= threshold * (a[:, None] + b[None, :] - both)
        if i == j:
            np.fill_diagonal(linked, False)
            return [(block[k][3], int(v)) for k, v in zip(left, linked.sum(axis=1), strict=True)]
        return [(block[k][3], int(v)) for k, v in (*zip(left, linked.sum(axis=1), strict=True), *zip(right, linked.sum(axis=0), strict=True))]

    order = rows.join(texts, "node").repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    return by_block(order, count, ["label", "i", "j", "node", "chunk", "text"], "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``: products of 0/1 matrices, some columns at a time."""
    x, y = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(x, y)
    ra, rb = np.repeat(np.arange(len(a)), [len(s) for s in a]), np.repeat(np.arange(len(b)), [len(s) for s in b])
    out = np.zeros((len(a), len(b)))
    for i in range(0, len(common), width):
        part = common[i : i + width]
        sides = []
        for values, owner, count in ((x, ra, len(a)), (y, rb, len(b))):
            at = np.searchsorted(part, values)
            hit = part[np.minimum(at, len(part) - 1)] == values
            m = np.zeros((count, len(part)), np.float32)
            m[owner[hit], at[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, tolerance: float = TOLERANCE, links: bool = True) -> DataFrame:
    """Rows (doc_id, crc, class_id, n_links, n_copies, stays), one for each document.

    class_id: least doc_id of the class; n_links: other shingle sets at the threshold or above; n_copies: rows of equal set.
    """
    sketched = materialize(sketch(docs, size), "sketch")
    full = sketched.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = full.groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "crc")).alias("r"), F.count(F.lit(1)).alias("n_copies"), F.first("bytes").alias("bytes"), F.first("keys").alias("keys")
    )
    nodes = materialize(nodes.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "r.doc_id", "r.crc", "n_copies", "bytes", "keys"), "nodes")
    rows = nodes.select(F.explode("keys").alias("key"), "node")
    shared_keys = rows.groupBy("key").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = materialize(rows.join(shared_keys, "key").select("key", "node", "lead"), "buckets")
    near = buckets.select("node").distinct()
    wanted = near.join(nodes, "node").select("node", "doc_id", "crc")
    texts = materialize(node_texts(docs, wanted), "texts")
    # the few leads that a node shares most buckets with come first; whatever they leave open is compared below
    leads = buckets.filter("node <> lead").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("n"))
    leads = leads.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", (-F.col("lead")).alias("l"))), asc=False), 1, LEADS).alias("x"))
    star = prune(leads.select("node", F.explode("x").alias("x")).select((-F.col("x.l")).alias("a"), F.col("node").alias("b")), nodes, threshold, tolerance)
    linked = materialize(verify(materialize(star, "star"), texts, threshold, size), "links")
    labels = components(linked)
    extra = materialize(across_classes(buckets, labels, nodes, texts, threshold, tolerance, size), "across")
    if extra.limit(1).count():
        labels = components(linked.unionByName(extra))
    labels = materialize(labels, "classes")
    top = F.min(F.struct("doc_id", "crc")).alias("top")
    least = labels.join(nodes.select("node", "doc_id", "crc"), "node").groupBy("label").agg(top)
    named = labels.join(least, "label").select("node", "top")
    if links:
        named = named.join(count_links(labels, texts, threshold, size), "node", "left")
    else:
        named = named.withColumn("links", F.lit(None).cast("long"))
    known = nodes.join(named, "node", "left").select(
        "s1", "s2", F.coalesce("top", F.struct("doc_id", "crc")).alias("top"), F.coalesce("links", F.lit(0)).alias("n_links"), "n_copies"
    )
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("s1"))
    joined = sketched.select("doc_id", "crc", own.alias("s1"), "s2").join(known, ["s1", "s2"], "left")
    return joined.select(
        "doc_id", "crc", F.coalesce("top.doc_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        (F.col("top").isNull() | ((F.col("doc_id") == F.col("top.doc_id")) & (F.col("crc") == F.col("top.crc")))).alias("stays"),
    )


def node_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (node, text as bytes) of the wanted nodes."""
    parts = wanted.groupBy("doc_id", "crc").agg(F.collect_list("node").alias("parts"))
    found = with_texts(docs, parts).select(F.explode("parts").alias("node"), "text")
    return found.groupBy("node").agg(F.first("text").alias("text"))  # repeated rows have the same text


def join(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), F.col("n_copies").cast("long").alias("n_copies"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """One document of each class stays (that of the least doc_id), with its columns; rows without doc_id stay."""
    found = classes(docs, threshold, size, links=False).filter("stays AND doc_id IS NOT NULL")
    stay = materialize(found.groupBy("doc_id", "crc").agg(F.count(F.lit(1)).alias("rows")), "staying")
    kept = attach(docs, stay, "inner")
    columns = restored(docs.columns)
    once = kept.filter("x.rows = 1").select(*columns)
    # repeated rows are copies as well; blank texts aren't
    again, blank = kept.filter("x.rows > 1"), ~F.coalesce("d.text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    first = again.filter(~blank).groupBy(F.col("d.doc_id").alias("id"), F.col("d.text").alias("text")).agg(F.first("d").alias("d"))
    return once.unionByName(first.select(*columns)).unionByName(again.filter(blank).select(*columns)).unionByName(docs.filter("doc_id IS NULL"))


def brute_force(texts: dict[int, str | None], threshold: float = THRESHOLD, size: int = SHINGLE) -> dict[int, tuple[int, int, int]]:
    """For tests: all pairs of sets; doc_id -> (class_id, n_links, n_copies)."""
    words = {k: (v or "").encode().split() for k, v in texts.items()}
    sets = {k: frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset() for k, w in words.items()}
    parent = {k: k for k in sets}

    def top(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    linked: dict[int, set] = {k: set() for k in sets}
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y):
                linked[a].add(y)
                linked[b].add(x)
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {k: (top(k), len(linked[k] - {sets[k]}), sum(s == sets[k] for s in sets.values()) if sets[k] else 1) for k in keys}
