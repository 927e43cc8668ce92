"""Sequence packing as a cutting-stock problem solved by column generation.

Documents become token ids (plus a closing id 0), cut into pieces of at most ``LENGTH``. Over the histogram of piece sizes
(lengths in steps of ``STEP``, so at most ``LENGTH / STEP`` rows at any corpus size) a linear program chooses how often to use
each filling pattern; a knapsack dynamic program over the duals prices new patterns. Rounded-down pattern counts and a
best-fit of the few pieces left over make a plan, and pieces, ranked within their size by Spark, take the plan's places.

Defined results: a null or empty text has the closing id alone; repeated rows are packed each; an empty table gives an empty
result; extra columns are ignored; ties of rank are broken by document, start and checksum.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import bpe
from millrace.llm.common import map_batches, materialize

LENGTH = 1024
#: Lengths are rounded up to a multiple of this for the linear program: fewer rows, at most so many ids of padding a piece.
STEP = 8
#: Relative gap to the bound of the linear program at which column generation stops, and the most rounds it takes.
GAP, ROUNDS = 0.002, 3000


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): whole pieces of ``length`` ids and the rest of each document."""
    path = path or bpe.default_path()

    def run(batch: pa.RecordBatch) -> list:
        encoder, rows = bpe.encoder(path), []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = (encoder.encode(text) if text else b"") + b"\0\0\0\0"
            n = len(ids) // 4
            rows += [(doc, s, min(length, n - s), zlib.crc32(ids[4 * s : 4 * (s + length)]), n) for s in range(0, n, length)]
        kinds = [batch.schema.field(0).type] + [pa.int64()] * 4
        return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def price(duals: np.ndarray, sizes: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """The filling of least reduced cost: an unbounded knapsack by total length."""
    value, last = np.full(length + 1, -np.inf), np.full(length + 1, -1)
    value[0] = 0
    for total in range(int(sizes[0]), length + 1):
        k = int(np.searchsorted(sizes, total, "right"))
        options = value[total - sizes[:k]] + duals[:k]
        best = int(np.argmax(options))
        value[total], last[total] = options[best], best
    total = int(np.argmax(value))
    out = np.zeros(len(sizes))
    least = 1.0 - float(value[total])
    while total > 0:
        out[last[total]] += 1
        total -= int(sizes[last[total]])
    return least, out


def column_generation(histogram: dict[int, int], length: int = LENGTH, gap: float = GAP, rounds: int = ROUNDS) -> list[tuple[dict[int, int], float]]:
    """(pattern, times) of the linear program: revised simplex over patterns that ``price`` proposes."""
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[int(s)] for s in sizes], float)
    m = len(sizes)
    counts = np.maximum(1, length // sizes)
    basis, inverse = np.diag(counts).astype(float), np.diag(1.0 / counts)
    costs = np.ones(m)
    amounts = demand / counts
    for _ in range(rounds):
        duals = costs @ inverse
        least, pattern = price(duals, sizes, length)
        objective = float(costs @ amounts)
        # Farley's bound: the optimum is at least objective / (1 - least)
        if least > -1e-9 or objective - objective / (1 - least) <= gap * objective:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-10, amounts / np.where(step > 1e-10, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        amount = ratio[out]
        amounts = np.maximum(amounts - amount * step, 0)
        amounts[out] = amount
        basis[:, out] = pattern
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
    return [({int(sizes[i]): int(basis[i, p]) for i in np.flatnonzero(basis[:, p])}, float(amounts[p])) for p in range(m) if amounts[p] > 0]


def plan(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """(pattern, whole times) that serve every piece exactly once."""
    left = dict(histogram)
    out = []
    if left.get(length):
        out.append(({length: 1}, left.pop(length)))
    if left:
        for pattern, amount in sorted(column_generation(left, length), key=lambda x: -x[1]):
            times = min([int(amount + 1e-6), *(left[s] // n for s, n in pattern.items())])
            if times > 0:
                out.append((pattern, times))
                for s, n in pattern.items():
                    left[s] -= n * times
    # what rounding down left over: largest piece first, then the largest that still fits
    rest = sorted(s for s, n in left.items() if n)
    while rest:
        room, pattern = length, {}
        while rest and (k := bisect_right(rest, room)):
            s = rest[k - 1]
            n = min(left[s], room // s)
            pattern[s] = n
            left[s] -= n
            room -= n * s
            if not left[s]:
                rest.pop(k - 1)
            elif room >= s:
                insort(rest, s)
        out.append((pattern, 1))
    return out


def places(planned: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end rank, pieces of it a sequence, first sequence): where the ranked pieces of a size go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in planned:
        for size, n in pattern.items():
            lo = used.get(size, 0)
            rows.append((size, lo, lo + n * times, n, sequence))
            used[size] = lo + n * times
        sequence += times
    return rows


def size_of(step: int) -> "F.Column":
    """A piece's length in steps, rounded up."""
    return F.ceil(F.col("length") / F.lit(step)).cast("int")


def assign(cut: DataFrame, planned: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Give the pieces (with their ``size``) a sequence and an offset. Ranks within a size come from buckets and running counts."""
    spark = cut.sparkSession
    total = sum(n * times for pattern, times in planned for n in pattern.values())
    buckets = max(1, total // 2000)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = (
        cut.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select("size", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("at", F.row_number().over(order) - 1).join(before, ["size", "bucket"]).withColumn("rank", F.col("before") + F.col("at"))
    # at most one row for each pattern and size of a plan over LENGTH / STEP sizes: bounded whatever the corpus
    table = spark.createDataFrame(places(planned), "size int, lo bigint, hi bigint, n bigint, first bigint")
    p, r = F.broadcast(table).alias("p"), ranked.alias("r")
    at = F.floor((F.col("r.rank") - F.col("p.lo")) / F.col("p.n"))
    placed = r.join(p, (F.col("r.size") == F.col("p.size")) & (F.col("r.rank") >= F.col("p.lo")) & (F.col("r.rank") < F.col("p.hi"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("p.first") + at).cast("long").alias("sequence_id"), "rank"
    )
    # a sequence holds at most LENGTH pieces
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("rank")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every id of every document in one place."""
    cut = materialize(pieces(docs, path, length).withColumn("size", size_of(step)), "pieces")
    histogram = {int(r["size"]): int(r["n"]) for r in cut.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    return assign(cut, plan(histogram, length // step))
