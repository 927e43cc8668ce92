"""Helpers shared by the training-data operators: shared-folder tables, word hashing, interval maths."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multipliers of the 64-bit mixers and of the rolling hash.
MIX_A, MIX_B, ROLL = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


#: Rows that a Python worker turns into objects at a time.
SLICE = 1000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is empty (unit tests on one machine) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        import tempfile

        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str) -> "F.Column":
    """A text column as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def attach(docs: DataFrame, rows: DataFrame, how: str = "left") -> DataFrame:
    """Documents as a struct ``d`` with the matching row of ``rows`` (doc_id, crc of the text, ..) as a struct ``x``.

    Structs keep any column names of the two apart.
    """
    d, x = docs.select(F.struct("*").alias("d")), rows.select(F.struct("*").alias("x"))
    return d.join(x, F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.crc32(utf8("d.text")) == F.col("x.crc")), how)


def restored(columns: list[str], text: "F.Column | None" = None) -> list:
    """The columns of documents out of the struct ``d``, with ``text`` in place of the text."""
    return [text.alias(c) if c == "text" and text is not None else F.col(f"d.`{c}`").alias(c) for c in columns]


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], list], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to a list of columns (arrays in schema order)."""
    names = [part.split()[0] for part in split_schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in f(batch)], names=names)

    return df.mapInArrow(run, schema)


def split_schema(schema: str) -> list[str]:
    """Fields of a DDL schema, minding commas inside angle brackets."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """word -> 64-bit hash, kept per Python worker; emptied when full, so its memory is bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _hashes.of(words)


def powers(n: int) -> np.ndarray:
    """ROLL**0 .. ROLL**(n-1) modulo 2**64."""
    out = np.full(n, ROLL, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class RollingHash:
    """Hashes of any substring of a sequence of 64-bit units in constant time.

    ``of(i, n)`` depends on the units i..i+n-1 only. Unit values are mixed first, so short alphabets are fine.
    """

    _pow = powers(1 << 12)
    _inv = None

    def __init__(self, units: np.ndarray):
        n = len(units)
        if len(RollingHash._pow) < n + 1:
            RollingHash._pow = powers(2 * n + 2)
            RollingHash._inv = None
        if RollingHash._inv is None:
            base = np.full(len(RollingHash._pow), pow(ROLL, -1, 1 << 64), np.uint64)
            base[0] = 1
            RollingHash._inv = np.multiply.accumulate(base)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * RollingHash._pow[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * RollingHash._inv[start])

    def every(self, length: int) -> np.ndarray:
        """Hash of the substring of this length at each start."""
        m = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:m]) * RollingHash._inv[:m]) if m > 0 else np.zeros(0, np.uint64)


def window_minima(values: np.ndarray, width: int, block: int = 1 << 23) -> np.ndarray:
    """Position of the leftmost least value (by its upper 40 bits) in each window of ``width`` values."""
    m = len(values) - width + 1
    out = np.empty(max(m, 0), np.int64)
    for b in range(0, m, block):
        count = min(block, m - b)
        part = values[b : b + count + width - 1]
        least = (part & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:count], least[width - span : width - span + count])
        out[b : b + count] = b + (least[:count] & np.uint64(0xFFFFFF)).astype(np.int64)
    return out


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal disjoint runs."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((first[1:], [True]))
    return s[first], e[last]
