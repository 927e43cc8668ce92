"""A written text index: kept fragments, excluded ones, postings by bucket of the term, and a meta row; searched by BM25.

An index is a folder of versions. A version is written whole and then named in the table ``versions``, so readers see complete
versions only, and a job that dies leaves nothing that is read. Postings lie in folders by a hash of the term: a search for some
terms reads their buckets only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.corpus import SENT, protected_hits
from millrace.operators.retrieval import B, K1, terms, top_n

#: Weight of a title's terms; a fixed value.
TITLE = 8
BUCKETS = 32
#: Terms of a query, rarest first, that a fragment must have before it meets the others.
RAREST = 3


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if name != "postings":
            return self.spark.read.parquet(path)
        key = self.table("fragments").schema["id"].dataType.simpleString()
        return self.spark.read.schema(f"term string, id {key}, example boolean, size int, in_title bigint, in_body bigint, bucket int").parquet(path)


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def postings(fragments: DataFrame) -> DataFrame:
    """Rows (term, id, example, in_title, in_body, size): counts of a term in title and body, and the terms of both."""
    texts = fragments.select("id", "example", "title", "text").repartition("id")  # so texts are shuffled and not their terms
    t = texts.select("id", "example", terms("title").alias("t"), terms("text").alias("b")).withColumn("size", F.size("t") + F.size("b"))
    each = F.explode(F.concat(F.transform("t", lambda x: F.struct(x.alias("term"), F.lit(1).alias("title"))), F.transform("b", lambda x: F.struct(x.alias("term"), F.lit(0).alias("title")))))
    rows = t.select("id", "example", "size", each.alias("x")).select("id", "example", "size", "x.term", "x.title")
    return rows.groupBy("term", "id", "example", "size").agg(F.sum("title").alias("in_title"), F.sum(1 - F.col("title")).alias("in_body"))


def build_index(fragments: DataFrame, protected: DataFrame, root: str) -> Index:
    """Write a new version of the index of fragments (id, title, text, example) below ``root``.

    Fragments that repeat a protected text (item, position, side, text) are left out and listed in ``excluded`` with the item.
    The meta row counts fragments, excluded ones, terms and postings, has the mean size and a hash of the protected texts.
    """
    spark, folder = fragments.sparkSession, f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    index = Index(spark, folder)
    rows = fragments.select("id", "title", "text", "example")
    protected_hits(rows.select("id", "text"), protected).write.parquet(f"{folder}/excluded")
    rows.join(index.table("excluded").select("id"), "id", "left_anti").write.parquet(f"{folder}/fragments")
    found = postings(index.table("fragments")).withColumn("bucket", bucket(F.col("term")))
    found.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).write.partitionBy("bucket").parquet(f"{folder}/postings")
    counted = index.table("postings").groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("in_title") + F.col("in_body")).alias("cf"))
    counted.write.parquet(f"{folder}/terms")
    whole = index.table("fragments").agg(F.count(F.lit(1)).alias("fragments")).join(index.table("excluded").agg(F.count(F.lit(1)).alias("excluded")))
    whole = whole.join(index.table("terms").agg(F.count(F.lit(1)).alias("terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("postings"), F.sum("cf").alias("total"))).join(protected_state(protected))
    whole.withColumn("mean", F.coalesce(F.col("total") / F.greatest("fragments", F.lit(1)), F.lit(0.0))).drop("total").write.parquet(f"{folder}/meta")
    spark.range(1).select(F.lit(folder).alias("folder"), F.current_timestamp().alias("at")).write.mode("append").parquet(f"{root.rstrip('/')}/versions")
    return index


def protected_state(protected: DataFrame) -> DataFrame:
    """One row that changes with the set of protected texts: an order-free sum over their hashes, and how many there are."""
    hashed = F.conv(F.substring(F.sha2(F.concat_ws("|", "item", "side", F.coalesce("text", F.lit(""))).cast("binary"), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return protected.agg(F.count(F.lit(1)).alias("protected"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("protected_hash"))


def open_index(spark: SparkSession, root: str) -> Index:
    """The version that was completed last."""
    last = spark.read.parquet(f"{root.rstrip('/')}/versions").orderBy(F.desc("at")).first()
    return Index(spark, last["folder"])


def is_current(index: Index, protected: DataFrame) -> DataFrame:
    """One row (current): whether the protected texts are still those that the index was built without."""
    return index.table("meta").select("protected_hash").join(protected_state(protected).select(F.col("protected_hash").alias("now"))).select((F.col("protected_hash") == F.col("now")).alias("current"))


def bm25(index: Index, queries: DataFrame, top: int, every: bool = False, example: bool | None = None) -> DataFrame:
    """Rows (query, rank, id, score) of queries (query, text): fragments with all the query's terms first, then those with any.

    BM25 over title and body, a title's terms counting ``TITLE`` times; ties by id. ``every``: only fragments with all terms;
    ``example``: only examples or only others. Repeated terms of a query count once; a query without terms has no rows.

    Queries of equal terms are searched once. With ``every`` only fragments that have the ``RAREST`` terms of a query meet its other
    terms. Without, postings of asked terms go to the task of their fragment and meet the queries there, so what is shuffled
    grows with the postings and not with the queries that ask for them.
    """
    spread = queries.select("query", F.array_sort(F.array_distinct(terms("text"))).alias("terms")).filter(F.size("terms") > 0)
    sets = spread.groupBy("terms").agg(F.min("query").alias("set")).checkpoint()
    meta = index.table("meta").first()
    idf = F.log(1 + (meta["fragments"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = sets.select("set", F.size("terms").alias("wanted"), F.explode("terms").alias("term")).withColumn("bucket", bucket(F.col("term")))
    weighted = asked.join(index.table("terms").select("bucket", "term", "df"), ["bucket", "term"]).select("set", "wanted", "bucket", "term", "df", idf.alias("idf")).checkpoint()
    used = index.table("postings")
    if example is not None:
        used = used.filter(F.col("example") == example)
    tf = F.col("in_title") * TITLE + F.col("in_body")
    part = F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("size") / float(meta["mean"] or 1.0)))
    if every:
        by = Window.partitionBy("set")
        whole = weighted.withColumn("known", F.count(F.lit(1)).over(by)).filter("known = wanted").withColumn("nth", F.row_number().over(by.orderBy("df", "term")))
        rare = whole.filter(F.col("nth") <= RAREST).join(used.select("bucket", "term", "id"), ["bucket", "term"]).groupBy("set", "id").agg(F.count(F.lit(1)).alias("n"), F.first("wanted").alias("wanted"))
        near = rare.filter(F.col("n") == F.least("wanted", F.lit(RAREST))).select("set", "id").checkpoint()
        parts = near.join(whole, "set").join(used, ["bucket", "term", "id"]).select("set", "wanted", "id", part.alias("part"))
    else:
        small = weighted.limit(SENT + 1).count() <= SENT
        sent = F.broadcast if small else lambda rows: rows
        each = used.join(sent(weighted.select("bucket", "term", "idf").distinct()), ["bucket", "term"]).select("id", "bucket", "term", part.alias("part"))
        each = each.repartition("id") if small else each
        parts = each.join(sent(weighted.select("bucket", "term", "set", "wanted")), ["bucket", "term"]).select("set", "wanted", "id", "part")
    scored = parts.groupBy("set", "id", "wanted").agg(F.round(F.sum("part"), 6).alias("bm25"), F.count(F.lit(1)).alias("hits"))
    scored = scored.withColumn("score", F.struct((F.col("hits") == F.col("wanted")).alias("whole"), "bm25"))
    if every:
        scored = scored.filter("score.whole")
    best = top_n(scored.select(F.col("set").alias("query"), "id", "score"), top).withColumnRenamed("query", "set")
    return spread.join(sets, "terms").select("query", "set").join(best, "set").select("query", "rank", "id", F.col("score.bm25").alias("score"))
