"""Language-model scores: causal self-attention over subword ids, trained in numpy, beside a unigram base.

A text is its words (lower-cased A-Z, between ASCII blanks) and one end. Words are spelled in the first ``VOCABULARY`` subword
ids of a public vocabulary. The ids fall into ``GROUPS`` by which ids they meet within words (a spectral grouping), a word into
the group that its ids vote for. Two attention models share one class:

* words: a place sees the words before it in its window, each as the sum of the vectors of all its ids, and predicts the class
  of the next token: the most frequent words and the end are classes of their own, other words belong to their group's
  class of listed or of rare words. Within a class, listed words have their training frequency;
* spelling of rare and unknown words: a place sees the group and the ids of the word so far, and predicts the class of the next
  id or the word's end; within a class an id has its smoothed frequency after the id before it.

    p(rare word | class) = (its count - 0.75, or 0 if unknown, + 0.75 * d * spelling) / n

where n counts the rare words of the group and d the different ones.

Windows overlap by ``context`` places; the causal mask lets a place see what is before it, and each token is scored once, in
the window where it has most context. So p adds up to at most 1 over all tokens.

Training takes every training text once, in ``ROUNDS`` rounds that each text's checksum assigns: tasks add up gradients over
their texts at the same parameters, Spark sums them and the driver makes one step. Partitions don't change the model (but for
the order of float sums). Rare words train the spelling the same way. Sums and parameters are of fixed size; word counts meet
the texts in a join, only the ``TOP`` most frequent words are broadcast.

Defined results: a null or empty text is the end alone; repeated rows are scored each (and counted each, if trained on);
without training texts all counts are 0 and the model keeps its start; a null doc_id is trained on; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import ctypes
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import bpe
from millrace.llm.common import materialize, utf8

VOCABULARY = 1024
GROUPS, OWN = 8, 15
K = OWN + 2 * GROUPS + 1  # classes of words: own ones, listed and rare ones of each group, the end
LISTED, RARE, END = OWN, OWN + GROUPS, K - 1
LEVELS = 4
STOP = GROUPS * LEVELS  # classes of ids: group and level of frequency, and the end of a word
WIDTH = GROUPS
TOP, TOP_BYTES, LEAST = 200_000, 64, 3  # listed words: how many, how long, how often seen
DISCOUNT = 0.75
ROUNDS, SPELLING_ROUNDS = 12, 12
RATE = 0.15
MOST = 60.0  # bound of scores and logits before the exponential
SLOTS = 16
#: Blanks beside the ASCII ones that part words, and very long runs.
ODD_BLANKS = re.compile(r"[^\S ]|\S{100000}")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().split()


def frugal(run: Callable) -> Callable:
    """``run`` for tasks of many small objects: what they freed goes back to the system, else a reused worker keeps it through the next stages."""

    def frugally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return frugally


def count_words(docs: DataFrame, flush: int = 300_000) -> DataFrame:
    """Rows (word, c) over the texts; tasks add up first, some hundred thousand words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def pack() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                for data in batch.column(0).slice(i, 500).to_pylist():
                    counts.update(words_of(data))
                    if len(counts) >= flush:
                        yield pack()
        yield pack()

    return docs.select(utf8("text").alias("text")).mapInArrow(frugal(run), "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@lru_cache(2)
def beginners(path: str) -> np.ndarray:
    """Which ids start with a space: within words there is none, so they begin words."""
    fast = bpe.encoder(path, VOCABULARY).fast
    return np.array([fast.decode_single_token_bytes(i)[:1] == b" " for i in range(VOCABULARY)])


def spell(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all words in one array, and where each word begins in it (and the last one ends)."""
    encode = bpe.encoder(path, VOCABULARY).fast.encode_ordinary
    text = b"".join(b" " + w for w in words).decode("utf-8", "replace")
    if not ODD_BLANKS.search(text):  # then words don't touch each other's pre-tokens
        ids = np.array(encode(text), np.int64)
        starts = np.flatnonzero(beginners(path)[ids]) if len(ids) else ids
        if len(starts) == len(words):
            return ids, np.append(starts, len(ids))
    each = [encode(" " + w.decode("utf-8", "replace")) for w in words]
    starts = np.concatenate(([0], np.cumsum([len(i) for i in each]))).astype(np.int64)
    return np.array([x for i in each for x in i], np.int64), starts


VECTOR = "slot int, at binary, v binary"


def vector(slot: int, values: np.ndarray) -> pa.RecordBatch:
    """A vector of float64 as its non-zero places."""
    at = np.flatnonzero(values)
    arrays = [pa.array([slot], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([values[at].tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["slot", "at", "v"])


def gather(vectors: DataFrame, size: int) -> dict[int, np.ndarray]:
    """Sums of the vectors of each slot; tasks add, the driver gets one vector of fixed size a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, at, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(slot, np.zeros(size))[np.frombuffer(at, np.int32)] += np.frombuffer(v, np.float64)
        for slot, values in sums.items():
            yield vector(slot, values)

    out: dict[int, np.ndarray] = {}
    rows = vectors.repartition(SLOTS, "slot").mapInArrow(run, VECTOR).toArrow()
    for slot, at, v in sorted(zip(*(c.to_pylist() for c in rows.columns), strict=True)):
        out.setdefault(slot, np.zeros(size))[np.frombuffer(at, np.int32)] += np.frombuffer(v, np.float64)
    return out


SIDE = VOCABULARY + 1


def count_ids(counts: DataFrame, path: str) -> np.ndarray:
    """Matrix [before, id] of ids within words; a word counts by the number of binary digits of its count.

    Row VOCABULARY is a word's begin, column VOCABULARY its end.
    """
    rows_a_slot = -(-SIDE // SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rows_a_slot * SLOTS * SIDE)
        for batch in batches:
            for i in range(0, batch.num_rows, 10_000):
                words, c = (x.slice(i, 10_000) for x in batch.columns)
                ids, starts = spell(words.to_pylist(), path)
                weight = 1 + np.floor(np.log2(c.to_numpy()))
                before = np.concatenate(([VOCABULARY], ids))[: len(ids)].copy()
                before[starts[:-1]] = VOCABULARY
                np.add.at(total, before * SIDE + ids, np.repeat(weight, np.diff(starts)))
                np.add.at(total, ids[starts[1:] - 1] * SIDE + VOCABULARY, weight)
        for slot, block in enumerate(total.reshape(SLOTS, -1)):
            if block.any():
                yield vector(slot, block)

    found = gather(counts.select("word", "c").mapInArrow(run, VECTOR), rows_a_slot * SIDE)
    empty = np.zeros(rows_a_slot * SIDE)
    return np.concatenate([found.get(s, empty) for s in range(SLOTS)]).reshape(-1, SIDE)[:SIDE]


def affinities(matrix: np.ndarray) -> np.ndarray:
    """Closeness [id, group] of each id to each group: spectral coordinates of positive mutual information, then spherical means."""
    met = matrix[:VOCABULARY, :VOCABULARY] + matrix[:VOCABULARY, :VOCABULARY].T
    seen = met.sum(axis=1)
    near = np.maximum(np.log((met + 0.1) * (met.sum() + 1) / np.outer(seen + 200, seen + 200)), 0)
    basis = np.random.default_rng(0).normal(size=(VOCABULARY, GROUPS + 4))
    for _ in range(30):
        basis = np.linalg.qr(near @ basis)[0]
    values, turn = np.linalg.eigh(basis.T @ near @ basis)
    at = (basis @ turn)[:, -GROUPS:] * np.sqrt(np.abs(values[-GROUPS:]))
    at /= np.linalg.norm(at, axis=1, keepdims=True) + 1e-9
    weight = np.log1p(seen)
    centres = at[[int(np.argmax(seen))]]
    while len(centres) < GROUPS:  # the next one is far from those there are
        centres = np.concatenate((centres, at[[int(np.argmax((1 - (at @ centres.T).max(axis=1)) * weight))]]))
    for _ in range(30):
        mine = np.argmax(at @ centres.T, axis=1)
        for g in range(GROUPS):
            middle = (at * weight[:, None])[mine == g].sum(axis=0)
            if np.linalg.norm(middle) > 0:
                centres[g] = middle / np.linalg.norm(middle)
    return (at @ centres.T).astype(np.float32)


def id_classes(matrix: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Class of each id: its group, and there its quarter by frequency."""
    often, group = matrix[:, :VOCABULARY].sum(axis=0), np.argmax(near, axis=1)
    out = np.zeros(VOCABULARY, np.int64)
    for g in range(GROUPS):
        mine = np.flatnonzero(group == g)
        order = mine[np.argsort(-often[mine], kind="stable")]
        share = (np.cumsum(often[order]) - often[order]) / max(often[order].sum(), 1)
        out[order] = g * LEVELS + np.minimum((share * LEVELS).astype(np.int64), LEVELS - 1)
    return out


def id_table(matrix: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """log10 p(id | its class, id before), smoothed towards p(id | its class)."""
    inner = matrix[:, :VOCABULARY]
    member = np.eye(STOP)[class_of]
    often = inner.sum(axis=0) + 0.5
    general = often / (often @ member)[class_of]
    return np.log10((inner + 4 * general) / ((inner @ member)[:, class_of] + 4)).astype(np.float32)


def windows(sizes: np.ndarray, window: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences of these lengths laid end to end: places [windows, window], which are real, which are scored here."""
    step = window - context
    count = np.maximum(1, -(-(sizes - window) // step) + 1)
    owner = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.cumsum(sizes) - sizes
    inner = nth[:, None] * step + np.arange(window)
    real = inner < sizes[owner][:, None]
    scored = real & ((np.arange(window) >= context) | (nth == 0)[:, None])
    return begin[owner][:, None] + np.minimum(inner, sizes[owner][:, None] - 1), real, scored


@dataclass
class Form:
    """What a model reads and says: inputs are sums of id vectors (ids laid end to end, starts), each of a class."""

    ids: np.ndarray
    starts: np.ndarray
    class_of: np.ndarray  # of each input, for the logits after it
    vectors: int
    classes: int
    window: int
    context: int

    def shapes(self) -> dict[str, tuple[int, ...]]:
        square = (WIDTH, WIDTH)
        return {
            "e": (self.vectors, WIDTH), "q": square, "k": square, "v": square, "far": (self.window,), "o": (WIDTH, self.classes),
            "last": (int(self.class_of.max()) + 1, self.classes), "bias": (self.classes,),
        }

    def start(self, prior: np.ndarray) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(11)
        p = {k: np.zeros(s) for k, s in self.shapes().items()}
        p |= {"q": rng.normal(0, 0.3, (WIDTH, WIDTH)), "k": rng.normal(0, 0.3, (WIDTH, WIDTH)), "v": np.eye(WIDTH), "bias": np.log(prior / prior.sum())}
        return p

    def flat(self, p: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([p[k].ravel() for k in self.shapes()])

    def parts(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        shapes = self.shapes()
        ends = np.cumsum([int(np.prod(s)) for s in shapes.values()])
        return {k: part.reshape(s) for (k, s), part in zip(shapes.items(), np.split(flat, ends[:-1]), strict=True)}


class Attention:
    """One causal self-attention layer with relative place biases; logits also see the class of what came last."""

    BLOCK = 16_384

    def __init__(self, form: Form, p: dict[str, np.ndarray], kind: type = np.float32):
        self.form, self.p = form, {k: v.astype(kind) for k, v in p.items()}
        n = form.window
        self.mask = np.tril(np.ones((n, n))).astype(kind)
        self.away = np.maximum(np.arange(n)[:, None] - np.arange(n), 0)
        self.root = kind(np.sqrt(WIDTH))
        # input, query, key and value of each input side by side, filled in blocks: it is the largest thing a task holds
        self.table = np.empty((len(form.starts) - 1, 4 * WIDTH), kind)
        for i in range(0, len(self.table), self.BLOCK):
            at = form.starts[i : i + self.BLOCK + 1]
            rows = np.add.reduceat(self.p["e"][form.ids[at[0] : at[-1]]], at[:-1] - at[0], axis=0)
            self.table[i : i + self.BLOCK] = np.concatenate((rows, rows @ self.p["q"] / self.root, rows @ self.p["k"], rows @ self.p["v"]), axis=1)
        self.after = self.p["last"] + self.p["bias"]
        self.ones = np.ones((max(n, form.classes), 1), kind)
        self.far = self.p["far"][self.away]

    def look(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Inputs, queries, keys, values, attention weights and attended values at the places of each window."""
        t = self.table[x]
        e, q, k, v = (t[..., i * WIDTH : (i + 1) * WIDTH] for i in range(4))
        a = q @ k.transpose(0, 2, 1)
        a += self.far
        np.clip(a, -MOST, MOST, out=a)  # so that no row of weights vanishes
        np.exp(a, out=a)
        a *= self.mask
        a /= a @ self.ones[: a.shape[2]]
        return e, q, k, v, a, a @ v

    def logits(self, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        z = h.reshape(-1, WIDTH) @ self.p["o"]
        z += self.after[last]
        return np.clip(z, -MOST, MOST, out=z)

    def log_p(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of the classes y [windows, window] after the inputs x."""
        z = self.logits(self.look(x)[-1], self.form.class_of[x.ravel()])
        picked = z[np.arange(len(z)), y.ravel()]
        np.exp(z, out=z)
        return (picked - np.log((z @ self.ones[: z.shape[1]])[:, 0])).reshape(x.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the summed loss over real places; ``rows`` are those of the input at each place."""
        p, form = self.p, self.form
        e, q, k, v, a, h = self.look(x)
        last = form.class_of[x.ravel()]
        z = self.logits(h, last)
        np.exp(z, out=z)
        z *= real.reshape(-1, 1) / (z @ self.ones[: z.shape[1]])
        z[np.arange(len(z)), y.ravel()] -= real.ravel()
        g = {"o": h.reshape(-1, WIDTH).T @ z, "bias": z.sum(axis=0)}
        if len(p["last"]) <= 64:
            hot = np.zeros((len(z), len(p["last"])), z.dtype)
            hot[np.arange(len(z)), last] = 1
            g["last"] = hot.T @ z
        else:
            g["last"] = by_row(last, z, len(p["last"]))
        dh = (z @ p["o"].T).reshape(h.shape)
        ds = dh @ v.transpose(0, 2, 1)
        ds -= ((dh * h) @ self.ones[:WIDTH])
        ds *= a
        g["far"] = np.bincount(self.away.ravel(), ds.sum(axis=0).ravel(), form.window)
        dq, dk, dv = ds @ k / self.root, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh
        dq, dk, dv, e = (t.reshape(-1, WIDTH) for t in (dq, dk, dv, e))
        g |= {"q": e.T @ dq, "k": e.T @ dk, "v": e.T @ dv, "rows": dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T}
        return g


def by_row(x: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each key below n."""
    return np.stack([np.bincount(x, rows[:, j], n) for j in range(rows.shape[1])], 1)


class Gradient:
    """Sums over sequences, some thousand windows at a time."""

    BLOCK = 256

    def __init__(self, model: Attention):
        self.model, form = model, model.form
        self.sums = {k: np.zeros(s) for k, s in form.shapes().items() if k != "e"}
        self.rows = np.zeros((len(form.starts) - 1, WIDTH))
        self.n = 0

    def add(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> None:
        form = self.model.form
        at, real, _ = windows(sizes, form.window, 0)
        self.n += int(sizes.sum())
        inputs, rows = x[at], np.empty((*at.shape, WIDTH), self.model.table.dtype)
        for i in range(0, len(at), self.BLOCK):
            part = slice(i, i + self.BLOCK)
            g = self.model.gradients(inputs[part], y[at[part]], real[part])
            rows[part] = g.pop("rows").reshape(rows[part].shape)
            for k, v in g.items():
                self.sums[k] += v
        for j in range(WIDTH):  # a column at a time, also below: the rows are as many as the inputs
            self.rows[:, j] += np.bincount(inputs.ravel(), rows[..., j].ravel(), len(self.rows))

    def flat(self) -> np.ndarray:
        form = self.model.form
        sizes = np.diff(form.starts)
        e = np.stack([np.bincount(form.ids, np.repeat(self.rows[:, j], sizes), form.vectors) for j in range(WIDTH)], 1)
        return form.flat(self.sums | {"e": e})


def train(rows: DataFrame, form: Form, p: dict[str, np.ndarray], rounds: int, sequences: Callable, at_once: int, extra: int = 0) -> tuple[dict, np.ndarray]:
    """Parameters after one step a round, and the sum of the extra numbers over all rows.

    ``rows`` have a column ``turn``, the round of each; ``sequences`` makes (inputs, classes, sizes, extra numbers) of
    a batch of ``at_once`` rows.
    """
    spark = rows.sparkSession
    flat, tail = form.flat(p), np.zeros(extra)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    size = len(flat) + 1 + extra
    shared = spark.sparkContext.broadcast(form)
    # a round reads one part in ``rounds``; its tasks are as much larger
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() // rounds))
    for number in range(rounds):
        now = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            form, gradient, more = shared.value, None, np.zeros(extra)
            for batch in batches:
                for i in range(0, batch.num_rows, at_once):
                    gradient = gradient or Gradient(Attention(form, form.parts(now.value)))
                    x, y, sizes, numbers = sequences(batch.slice(i, at_once))
                    gradient.add(x, y, sizes)
                    more += numbers
            if gradient:
                yield vector(TaskContext.get().partitionId() % SLOTS, np.concatenate((gradient.flat(), [gradient.n], more)))

        total = sum(gather(rows.filter(F.col("turn") == number).coalesce(tasks).mapInArrow(run, VECTOR), size).values(), np.zeros(size))
        now.destroy()
        n, tail = total[len(flat)], tail + total[len(flat) + 1 :]
        if n:
            g = total[: len(flat)] / n
            m += 0.2 * (g - m)
            v += 0.1 * (g * g - v)
            at = number + 1
            flat = flat - RATE * (1 - number / (2 * rounds)) * (m / (1 - 0.8**at)) / (np.sqrt(v / (1 - 0.9**at)) + 1e-6)
    shared.destroy()
    return form.parts(flat), tail


def turn(column: Column, rounds: int) -> Column:
    return F.coalesce(F.pmod(F.floor(F.crc32(column) / 7), F.lit(rounds)), F.lit(0)).cast("int")


@dataclass
class Spelling:
    """Groups and spelling of any word."""

    path: str
    near: np.ndarray
    class_of: np.ndarray
    table: np.ndarray
    p: dict[str, np.ndarray]

    @classmethod
    def of(cls, matrix: np.ndarray, path: str) -> Spelling:
        near = affinities(matrix)
        class_of = id_classes(matrix, near)
        self = cls(path, near, class_of, id_table(matrix, class_of), {})
        prior = np.append(np.bincount(class_of, matrix[:, :VOCABULARY].sum(axis=0), STOP), matrix[:, VOCABULARY].sum()) + 1.0
        self.p = self.form().start(prior)
        self.p["e"][:VOCABULARY] = near - near.mean(axis=1, keepdims=True)
        self.p["e"][VOCABULARY:] = np.eye(GROUPS) - 1 / GROUPS
        self.p["o"][np.arange(STOP) // LEVELS, np.arange(STOP)] = 0.15
        # the start is the chain of id pairs: what a class has more after an id than anywhere
        pairs = np.concatenate((matrix[:, :VOCABULARY] @ np.eye(STOP)[class_of], matrix[:, VOCABULARY:]), axis=1)
        share = prior / prior.sum()
        after = np.log((pairs + 5 * share) / (pairs.sum(axis=1, keepdims=True) + 5) / share)
        self.p["last"] = after[np.minimum(np.arange(VOCABULARY + GROUPS), VOCABULARY)]
        return self

    def form(self) -> Form:
        n = VOCABULARY + GROUPS  # ids, and a begin for each group
        return Form(np.arange(n), np.arange(n + 1), np.arange(n), n, STOP + 1, 8, 3)

    def groups(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.argmax(np.add.reduceat(self.near[ids], starts[:-1], axis=0), axis=1) if len(starts) > 1 else np.zeros(0, np.int64)

    def sequences(self, ids: np.ndarray, starts: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.diff(starts)
        place = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
        x, y = np.empty(len(ids) + len(sizes), np.int64), np.full(len(ids) + len(sizes), STOP)
        x[place + 1], y[place] = ids, self.class_of[ids]
        x[starts[:-1] + np.arange(len(sizes))] = VOCABULARY + groups
        return x, y, sizes + 1

    def scores(self, ids: np.ndarray, starts: np.ndarray, groups: np.ndarray, model: Attention) -> np.ndarray:
        """log10 p(spelling | group) of each word."""
        x, y, sizes = self.sequences(ids, starts, groups)
        if not len(x):
            return np.zeros(0)
        out = token_logs(model, x, y, sizes)
        before = np.concatenate(([VOCABULARY], ids))[: len(ids)].copy()
        before[starts[:-1]] = VOCABULARY
        out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] += self.table[before, ids]
        return np.add.reduceat(out, np.cumsum(sizes) - sizes)


def token_logs(model: Attention, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 p(class) of each token, each from one window."""
    out, form = np.zeros(len(x)), model.form
    at, _, scored = windows(sizes, form.window, form.context)
    for i in range(0, len(at), 512):
        a, mine = at[i : i + 512], scored[i : i + 512]
        out[a[mine]] = model.log_p(x[a], y[a])[mine]
    return out / np.log(10)


def train_spelling(rare: DataFrame, spelling: Spelling) -> tuple[dict, np.ndarray, np.ndarray]:
    """Parameters, and the count and number of different rare words of each group."""

    def sequences(batch: pa.RecordBatch):
        ids, starts = spell(batch.column(0).to_pylist(), spelling.path)
        groups = spelling.groups(ids, starts)
        numbers = np.concatenate((np.bincount(groups, batch.column(1).to_numpy(), GROUPS), np.bincount(groups, None, GROUPS)))
        return *spelling.sequences(ids, starts, groups), numbers

    rows = rare.select("word", "c", turn(F.col("word"), SPELLING_ROUNDS).alias("turn"))
    p, sums = train(rows, spelling.form(), spelling.p, SPELLING_ROUNDS, sequences, 10_000, 2 * GROUPS)
    return p, sums[:GROUPS], sums[GROUPS:]


@dataclass
class Lexicon:
    """Listed words and what stays the same for all texts. A token's code: its place in the list, then L + group, then L + GROUPS."""

    spelling: Spelling
    counts: np.ndarray  # of listed words
    ids: np.ndarray
    starts: np.ndarray
    class_of: np.ndarray  # of each code; the begin is class K
    inside: np.ndarray  # log10 p(listed word | class)
    rare_n: np.ndarray
    rare_d: np.ndarray
    texts: int
    n: int
    v: int

    @classmethod
    def of(cls, words: list[bytes], counts: np.ndarray, spelling: Spelling, rare_n: np.ndarray, rare_d: np.ndarray, texts: int, n: int, v: int) -> Lexicon:
        ids, starts = spell(words, spelling.path)
        groups = spelling.groups(ids, starts)
        listed = np.where(np.arange(len(words)) < OWN, np.arange(len(words)), LISTED + groups)
        inside = np.log10(counts / np.bincount(listed, counts, K)[listed]) if len(words) else np.zeros(0)
        class_of = np.concatenate((listed, RARE + np.arange(GROUPS), [K])).astype(np.int64)
        return cls(spelling, counts, ids, starts, class_of, inside, np.maximum(rare_n, 1), np.maximum(rare_d, 1), texts, n, v)

    def form(self) -> Form:
        more = VOCABULARY + np.arange(GROUPS + 1)
        starts = np.concatenate((self.starts, self.starts[-1] + 1 + np.arange(GROUPS + 1)))
        return Form(np.concatenate((self.ids, more)), starts, self.class_of, VOCABULARY + GROUPS + 1, K, 16, 4)

    def start(self) -> dict[str, np.ndarray]:
        prior = np.bincount(self.class_of[: len(self.counts)], self.counts, K) + 1.0
        prior[RARE:END] += self.rare_n
        prior[END] += self.texts
        p = self.form().start(prior)
        near = self.spelling.near
        p["e"][:VOCABULARY] = near - near.mean(axis=1, keepdims=True)
        p["e"][VOCABULARY:-1] = 2 * np.eye(GROUPS) - 2 / GROUPS
        for kind in (LISTED, RARE):
            p["o"][np.arange(GROUPS), kind + np.arange(GROUPS)] = 1
        own = min(OWN, len(self.counts))
        if own:
            p["o"][:, :own] = 0.5 * np.add.reduceat(p["e"][self.ids], self.starts[:-1], axis=0)[:own].T
        return p


def sequences_of(codes: np.ndarray, sizes: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, classes and lengths of texts with ``sizes`` words each, laid end to end."""
    begin = len(class_of) - 1
    x, y = np.full(len(codes) + len(sizes), begin), np.full(len(codes) + len(sizes), END)
    place = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)
    x[place + 1], y[place] = codes, class_of[codes]
    x[np.cumsum(sizes + 1) - sizes - 1] = begin
    return x, y, sizes + 1


def codes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.int32).astype(np.int64), np.array([len(d) // 4 for d in data], np.int64)


@dataclass
class Model:
    lexicon: Lexicon
    words: list[bytes]
    counts: DataFrame  # of all training words
    p: dict[str, np.ndarray] | None = None


def make_lexicon(known: DataFrame, path: str | None = None) -> Model:
    """Counts of all training words, groups, the list and the trained spelling."""
    path = path or bpe.default_path()
    counts = materialize(count_words(known), "word_counts")
    texts = known.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # words seen once or twice stay off the list: they stand for the words yet to come
    top = counts.filter((F.octet_length("word") <= TOP_BYTES) & (F.col("c") >= LEAST)).orderBy(F.desc("c"), "word").limit(TOP).toArrow()
    words, c = top["word"].to_pylist(), top["c"].to_numpy().astype(float)
    rare = F.octet_length("word") > TOP_BYTES
    rare |= ((F.col("c") < int(c[-1])) | ((F.col("c") == int(c[-1])) & (F.col("word") > F.lit(bytearray(words[-1]))))) if words else F.lit(True)
    spelling = Spelling.of(count_ids(counts, path), path)
    spelling.p, rare_n, rare_d = train_spelling(counts.filter(rare), spelling)
    lexicon = Lexicon.of(words, c, spelling, rare_n, rare_d, texts, int(total["n"]) + texts, int(total["v"]) + (texts > 0))
    return Model(lexicon, words, counts)


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """Texts as token codes, with the base score and what doesn't depend on context; rare words are kept to meet their counts."""
    context = docs.sparkSession.sparkContext
    shared, listed = context.broadcast(model.lexicon), context.broadcast(model.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        spelling, index = lexicon.spelling, {w: i for i, w in enumerate(listed.value)}
        net = Attention(spelling.form(), spelling.p)
        total, rare = np.log10(lexicon.n + lexicon.v + 1), len(index)
        base_of, known = np.append(np.log10(lexicon.counts + 1), 0), np.append(np.ones(rare, np.int64), 0)
        inside_of, get = np.append(lexicon.inside, 0), index.get
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = [words_of(t) for t in part.column(3).to_pylist()]
                sizes = np.array([len(t) for t in texts])
                words = [w for t in texts for w in t]
                codes = np.fromiter((get(w, rare) for w in words), np.int64, len(words))
                base, inside, c = base_of[codes] - total, inside_of[codes], known[codes]
                at = np.flatnonzero(codes == rare)
                new: dict[bytes, int] = {}
                which = np.array([new.setdefault(words[j], len(new)) for j in at.tolist()], np.int64)
                ids, starts = spell(list(new), spelling.path)
                groups = spelling.groups(ids, starts)
                spelled = spelling.scores(ids, starts, groups, net) + np.log10(DISCOUNT * lexicon.rare_d)[groups]
                codes[at] += groups[which]
                inside[at] = (spelled - np.log10(lexicon.rare_n)[groups])[which]
                # each rare word of a text once, with its number
                pairs, n = np.unique(np.repeat(np.arange(len(texts)), sizes)[at] * max(1, len(new)) + which, return_counts=True)
                owner, word = np.divmod(pairs, max(1, len(new)))
                found = pa.StructArray.from_arrays([pa.array(list(new), pa.binary()).take(pa.array(word)), pa.array(n, pa.int64()), pa.array(spelled[word])], ["word", "n", "spelled"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), found)
                ends = np.cumsum(sizes)
                per = lambda v: np.diff(np.concatenate(([0], np.cumsum(v)))[np.concatenate(([0], ends))])
                end = np.log10(lexicon.texts + 1) - total
                data = codes.astype(np.int32)
                columns = [
                    pa.array(sizes + 1, pa.int64()), pa.array(per(c) + (lexicon.texts > 0), pa.int64()), pa.array(per(base) + end), pa.array(per(inside)),
                    pa.array([data[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)], pa.binary()),
                    lists,
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names=[*part.schema.names[:3], "n_tokens", "n_known", "base_score", "inside", "codes", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, turn int, n_tokens bigint, n_known bigint, base_score double, inside double, codes binary, rare array<struct<word:binary,n:bigint,spelled:double>>"
    key = turn(F.col("doc_id").cast("string").cast("binary"), ROUNDS).alias("turn")
    coded = docs.select("doc_id", held_out().alias("held_out"), key, utf8("text").alias("text")).mapInArrow(frugal(run), schema)
    return materialize(coded.withColumn("row", F.monotonically_increasing_id()), "coded")


def train_words(coded: DataFrame, model: Model) -> Model:
    """The model with attention trained on all rows of ``coded``."""
    shared = coded.sparkSession.sparkContext.broadcast(model.lexicon.class_of)

    def sequences(batch: pa.RecordBatch):
        return *sequences_of(*codes_of(batch.column(0)), shared.value), 0

    p, _ = train(coded.select("codes", "turn"), model.lexicon.form(), model.lexicon.start(), ROUNDS, sequences, 500)
    return replace(model, p=p)


def score_coded(coded: DataFrame, model: Model) -> DataFrame:
    lexicon = model.lexicon
    shared = coded.sparkSession.sparkContext.broadcast((lexicon.form(), model.p))
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, p = shared.value
        net = Attention(form, p)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                x, y, sizes = sequences_of(*codes_of(part.column("codes")), form.class_of)
                logs = np.add.reduceat(token_logs(net, x, y, sizes), np.cumsum(sizes) - sizes) + part.column("inside").to_numpy()
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(logs)], names=[*kept, "score"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    scored = coded.select(*kept, "inside", "codes").mapInArrow(run, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    # rare words get their counts here
    rest = coded.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    seen = F.col("n") * (F.log10(F.col("c") - DISCOUNT + F.pow(F.lit(10.0), "spelled")) - F.col("spelled"))
    found = rest.join(model.counts, "word").groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("add"), F.sum(seen).alias("gain"))
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(lexicon.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("add", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )


def fit(docs: DataFrame, path: str | None = None) -> Model:
    """A model of all training texts among ``docs``."""
    known = docs.filter(~held_out())
    model = make_lexicon(known, path)
    return train_words(encode(known, model), model)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of any texts."""
    return score_coded(encode(docs, model), model)


def score_corpus(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``score`` of all texts by the model of the training ones; texts are encoded once."""
    model = make_lexicon(docs.filter(~held_out()), path)
    coded = encode(docs, model)
    return score_coded(coded, train_words(coded.filter(~F.col("held_out")), model))
