"""Chunks, postings, ranked text search, vector neighbours and name search."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K1, B = 1.2, 0.75
TERM = r"[a-z\x{E0}-\x{FF}]{2,}"


def fold_pack(sizes: list[int], limit: int) -> list[int]:
    """Greedy packing in order: the group of each piece; a piece over the limit is a group of its own."""
    out, group, used = [], -1, 0
    for n in sizes:
        if group < 0 or used + n > limit:
            group, used = group + 1, 0
        out.append(group)
        used += n
    return out


def packed(sizes: Column, limit: int) -> Column:
    """The part of each piece of a row, packed in order: a small helper over arrays of sizes."""

    @F.pandas_udf("array<int>")
    def groups(column: pd.Series) -> pd.Series:
        return column.map(lambda x: fold_pack([int(n) for n in x], limit))

    return groups(sizes)


def in_parts(pieces: Column, groups: Column, between: str) -> Column:
    """The texts of the parts: the pieces of each group, joined."""
    last = F.coalesce(F.array_max(groups), F.lit(-1))
    every = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(every, lambda g: F.array_join(F.filter(pieces, lambda p, i: F.get(groups, i) == g), between))


def chunk_paragraphs(docs: DataFrame, limit: int = 1800) -> DataFrame:
    """Rows (id, chunk, text): paragraphs (lines with text) packed greedily up to ``limit`` characters, none split; null has none."""
    pieces = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda p: p.rlike(r"[^\s]"))
    cut = docs.select("id", pieces.alias("p")).withColumn("g", packed(F.transform("p", lambda p: F.length(p) + 1), limit))
    return cut.select("id", F.posexplode(in_parts(F.col("p"), F.col("g"), "\n")).alias("chunk", "text")).withColumn("chunk", F.col("chunk").cast("long"))


def heading_path(lines: DataFrame, level: Column) -> DataFrame:
    """Current title of each level for each line (page, line, text); a title closes the levels below it."""
    w = Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("level", level)
    for k in (1, 2, 3):
        at = F.last(F.when(F.col("level") == k, F.struct("line", "text")), ignorenulls=True).over(w)
        rows = rows.withColumn(f"t{k}", at)
    keep2 = F.col("t2")["line"] > F.coalesce(F.col("t1")["line"], F.lit(-1))
    keep3 = (F.col("t3")["line"] > F.coalesce(F.col("t1")["line"], F.lit(-1))) & (F.col("t3")["line"] > F.coalesce(F.when(keep2, F.col("t2")["line"]), F.lit(-1)))
    path = F.concat_ws(" > ", F.col("t1")["text"], F.when(keep2, F.col("t2")["text"]), F.when(keep3, F.col("t3")["text"]))
    return rows.select("page", "line", path.alias("path"))


def terms(column: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(TERM), F.lit(0))


def top_n(scored: DataFrame, top: int, buckets: int = 32, ties: str = "first") -> DataFrame:
    """Best ``top`` per query: within buckets first, so a query with many hits is ranked by many tasks; ties go to the first (or last) id."""
    order = (F.desc("score"), F.asc("id") if ties == "first" else F.desc("id"))
    salted = scored.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "_b").orderBy(*order))).filter(F.col("rank") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= top).drop("_b")


MAX_QUERIES = 20_000  # about, of one pass


def neighbours(vectors: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Rows (query, rank, id, score): nearest vectors by cosine; queries go in passes over all rows, so the driver has one block of them."""
    n = queries.count()
    if n <= MAX_QUERIES:
        return _pass(vectors, queries, top)
    blocks = -(-2 * n // MAX_QUERIES)
    dealt = queries.withColumn("_b", F.pmod(F.xxhash64("query"), F.lit(blocks))).checkpoint()
    done = [_pass(vectors, dealt.filter(F.col("_b") == b).drop("_b"), top).checkpoint() for b in range(blocks)]
    return reduce(DataFrame.unionByName, done)


def _pass(vectors: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """One block of queries against all rows; each batch keeps its best, Spark ranks the rest."""
    asked = queries.toPandas()
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    q, names = unit(np.stack(asked["vector"]).astype(float)) if len(asked) else np.zeros((0, 1)), asked["query"].to_numpy()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame) or not len(q):
                continue
            ids = frame["id"].to_numpy()
            for i in range(0, len(q), 256):
                near = np.round(q[i : i + 256] @ unit(np.stack(frame["vector"]).astype(float)).T, 6)
                for name, row in zip(names[i : i + 256], near, strict=True):
                    best = np.lexsort((ids, -row))[:top]
                    yield pd.DataFrame({"query": name, "id": ids[best], "score": row[best]})

    return top_n(vectors.select("id", "vector").mapInPandas(run, "query bigint, id bigint, score double"), top)


def embed(docs: DataFrame, embedder, width: int) -> DataFrame:
    """Vectors of texts by an injected function from a list of texts to a matrix."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            m = np.asarray(embedder(frame["text"].fillna("").tolist()), float).reshape(len(frame), width)
            yield pd.DataFrame({"id": frame["id"], "vector": list(m)})

    return docs.select("id", "text").mapInPandas(run, "id bigint, vector array<double>")


def hashing_embedder(texts: list[str], width: int = 16) -> np.ndarray:
    """A deterministic stand-in: counts of words (between blanks) by the first hexadecimal digit of the word's MD5."""
    from hashlib import md5

    out, place = np.zeros((len(texts), width)), {}
    for i, text in enumerate(texts):
        for w, n in Counter(text.split(" ")).items():
            if w:
                if w not in place:  # words of a batch come again and again
                    place[w] = int(md5(w.encode()).hexdigest()[0], 16) % width
                out[i, place[w]] += n
    return out


IDENTIFIER = r"@?[A-Za-z_][A-Za-z0-9_]*"
MANY = 8


def exact_lookup(queries: DataFrame, classes: DataFrame, members: DataFrame, chain: DataFrame) -> DataFrame:
    """Rows (query, rank, id) of the fragments that a query (query, text) names.

    ``classes`` (class, id), ``members`` (member, class, id) are fragments, ``chain`` (child, ancestor) the closure with each class
    itself. ``Class.member`` gives the member of the class or an ancestor of least id, then the class. Else each word may be a
    class (exact case in a sentence, any case alone) or, if it has an underscore or stands alone, a member: with classes in the
    query one of theirs or their ancestors', of least id; without, the first ``MANY`` by id. Members rank before classes, words
    in their order; a fragment comes once. Of several fragments of a class the exact case and then the least id counts.
    """
    q = queries.select("query", F.trim("text").alias("text")).withColumn("dotted", F.regexp_extract("text", rf"^({IDENTIFIER})\.([A-Za-z_][A-Za-z0-9_]*)(\(\))?\z", 1) != "")
    pair = lambda g: F.regexp_extract("text", rf"^({IDENTIFIER})\.([A-Za-z_][A-Za-z0-9_]*)(\(\))?\z", g)
    words = F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))
    w = q.filter("NOT dotted").select("query", F.size(words).alias("n"), F.posexplode(words).alias("pos", "word"))
    dotted = q.filter("dotted").select("query", pair(1).alias("class"), pair(2).alias("member"))
    one = classes.groupBy("class").agg(F.min("id").alias("id"))
    keyed = one.select(F.lower("class").alias("low"), F.col("class").alias("found"), F.col("id").alias("class_id"))

    def of_class(rows: DataFrame, name: str, keys: list[str], exact: Column) -> DataFrame:
        hit = rows.join(keyed, F.lower(name) == F.col("low")).groupBy(*keys).agg(F.min(F.struct((F.col("found") != F.col(name)).alias("other"), "class_id", "found")).alias("x"))
        return hit.filter(~F.col("x.other") | exact).select(*keys, F.col("x.found").alias("found"), F.col("x.class_id").alias("id"))

    word_class = of_class(w, "word", ["query", "pos", "word", "n"], F.col("n") == 1)
    dot_class = of_class(dotted, "class", ["query", "member"], F.lit(True))
    above = chain.select(F.col("child").alias("found"), F.col("ancestor").alias("class"))
    inherited = lambda rows, keys: rows.join(above, "found").join(members.select("member", "class", "id"), ["member", "class"]).groupBy(*keys).agg(F.min("id").alias("id"))
    dot_member = inherited(dot_class.drop("id"), ["query"]).withColumn("pos", F.lit(0))
    other = w.join(word_class.select("query", "pos"), ["query", "pos"], "left_anti").filter("n = 1 OR instr(word, '_') > 0").select("query", "pos", F.col("word").alias("member"))
    with_class = other.join(word_class.select("query", "found").distinct(), "query")
    near = inherited(with_class, ["query", "pos"])
    # the first of each name are found once, before any query asks for them
    first = top_n(members.select(F.col("member").alias("query"), "id", F.lit(0).alias("score")), MANY).select(F.col("query").alias("member"), "id")
    free = other.join(word_class.select("query").distinct(), "query", "left_anti").join(first, "member").select("query", "pos", "id")
    columns = lambda df, kind: df.select("query", F.lit(kind).alias("kind"), F.col("pos").cast("int").alias("pos"), "id")
    found = columns(dot_member, 0).unionByName(columns(near, 0)).unionByName(columns(free, 0)).unionByName(columns(word_class, 1)).unionByName(columns(dot_class.withColumn("pos", F.lit(0)), 1))
    once = found.groupBy("query", "id").agg(F.min(F.struct("kind", "pos")).alias("x"))
    return once.select("query", F.row_number().over(Window.partitionBy("query").orderBy("x", "id")).alias("rank"), "id")


def staged(stages: list[tuple[str, DataFrame, Column | None]], n: int) -> DataFrame:
    """Rows (query, place, id, found_by): results (query, rank, id) stage by stage until a query has n, none twice.

    A stage takes at most its own number of places (a column over ``placed``, the places taken before; None: all that is left).
    """
    done = None
    for k, (name, rows, most) in enumerate(stages):
        new = rows.select("query", "id", "rank")
        taken = new.select("query", F.lit(0).alias("placed")).distinct()
        if done is not None:
            new = new.join(done.select("query", "id"), ["query", "id"], "left_anti")
            taken = taken.select("query").join(done.groupBy("query").agg(F.count(F.lit(1)).alias("placed")), "query", "left").select("query", F.coalesce("placed", F.lit(0)).alias("placed"))
        room = F.lit(n) - F.col("placed")
        ranked = new.join(taken, "query").withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy("rank", "id")))
        ranked = ranked.filter(F.col("_r") <= (room if most is None else F.least(room, most)))
        part = ranked.select("query", "id", F.lit(k).alias("stage"), "_r", F.lit(name).alias("found_by"))
        done = (part if done is None else done.unionByName(part)).checkpoint()
    return done.select("query", F.row_number().over(Window.partitionBy("query").orderBy("stage", "_r")).alias("place"), "id", "found_by")
