"""Benchmark decontamination with DataFrame functions only.

Test texts become windows of ``SIZE`` consecutive words (a shorter text is one window). Documents are scanned for windows in
one pass: hashes of a window's first words are looked up in a hash set that travels with the query, the few places that pass
are written down with their words, and an equi-join with the windows themselves decides. Hit words can then be cut out, or
their documents dropped.

The hash set is broadcast only while the tests have at most ``MAX_HEADS`` different window heads; beyond, places are written
down for every window and the join (by shuffle) does all the work, with equal results.

Defined results: null or empty texts (of either table) have no words; repeated rows are judged each; ties don't matter; without
tests or documents nothing is hit; extra columns are ignored by ``report`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import attach, materialize, restored, utf8

SIZE = 10
HEAD = 4
MAX_HEADS = 200_000
#: What separates words: ASCII but digits and letters.
SEPARATORS = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
UPPER = "".join(chr(c) for c in range(65, 91))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(column: str) -> Column:
    """Lower-cased (A-Z) words of a text column; none for null."""
    flat = F.translate(F.coalesce(F.col(column).cast("string"), F.lit("")), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS))
    return F.array_remove(F.split(flat, " "), "")


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (item, n, gram): each window of each test text, n words joined by spaces."""
    b = benchmark.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w")).filter("item IS NOT NULL AND size(w) > 0")
    n = F.least(F.lit(size), F.size("w"))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))
    return b.select("item", n.alias("n"), F.explode(F.array_distinct(grams)).alias("gram"))


def places_of(n: int, wanted: list[int] | None) -> Column:
    """Places of a document whose head hash is wanted (any, if None) and at which n words fit, with those words."""
    passed = F.transform(f"h{min(n, HEAD)}", lambda h, i: F.when((F.lit(True) if wanted is None else h.isin(wanted)) & (i + n <= F.size("w")), i + 1))
    return F.transform(F.array_compact(passed), lambda p: F.struct(p.alias("pos"), F.lit(n).alias("n"), F.array_join(F.slice("w", p, n), " ").alias("gram")))


def head_of_gram(n: int, head: int) -> Column:
    w, out = F.split("gram", " "), None
    for k in range(min(n, head)):
        x = F.xxhash64(w[k])
        out = x if out is None else F.xxhash64(out, x)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, max_heads: int = MAX_HEADS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (row, doc_id, n_words, places array<struct<pos,n>>, items array<string>): 1-based word places of windows that occur.

    ``extra``: further columns of the documents to carry along.

    ``row`` tells repeated doc_ids apart; it is fixed by writing the scan down.
    """
    grams = materialize(windows(benchmark, size), "windows")
    lengths = sorted(r["n"] for r in grams.select("n").distinct().collect())
    sets = {n: grams.filter(F.col("n") == n).select(head_of_gram(n, HEAD).alias("h")).distinct() for n in lengths}
    small = grams.select("n", "gram").limit(max_heads + 1).count() <= max_heads
    found = {n: [r["h"] for r in s.collect()] for n, s in sets.items()} if small else {n: None for n in lengths}
    base = docs.select("doc_id", *extra, words("text").alias("w")).withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    deepest = min(HEAD, max(lengths, default=0))
    for k in range(2, deepest + 1):
        base = base.withColumn(f"h{k}", F.zip_with(f"h{k - 1}", F.slice("h1", k, F.greatest(F.size("h1"), F.lit(1))), lambda a, b: F.xxhash64(a, b)))
    places = [places_of(n, found[n]) for n in lengths]
    place = F.concat(*places) if places else F.lit(None).cast("array<struct<pos:int,n:int,gram:string>>")
    scanned = materialize(base.select(F.monotonically_increasing_id().alias("row"), "doc_id", *extra, F.size("w").alias("n_words"), place.alias("place")), "scanned")
    items = grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
    hit = scanned.select("row", F.explode("place").alias("p")).select("row", "p.pos", "p.n", "p.gram").join(items, "gram")
    per_row = hit.groupBy("row").agg(
        F.collect_list(F.struct("pos", "n")).alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    return scanned.select("row", "doc_id", *extra, "n_words").join(per_row, "row", "left")


def covered_words(places: str = "places") -> Column:
    """Distinct 1-based places of the hit words."""
    spread = F.flatten(F.transform(places, lambda h: F.sequence(h["pos"], h["pos"] + h["n"] - 1)))
    return F.coalesce(F.array_distinct(spread), F.array().cast("array<int>"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    none = F.array().cast("array<string>")
    return hits(docs, benchmark, size).withColumn("n_hit", F.size(covered_words()).cast("long")).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, share: float = 1.0, size: int = SIZE) -> DataFrame:
    """Documents without the hit words; those with more than ``share`` of their words hit go as a whole.

    A hit word goes with the separators before it. Documents without hits, null texts and all other columns stay as they are;
    ``share`` 0 drops every document with a hit. Rows of one doc_id are told apart by the checksum of their text.
    """
    named = docs.select("doc_id", "text", F.crc32(utf8("text")).alias("crc"))
    found = hits(named, benchmark, size, extra=("crc",)).filter("places IS NOT NULL").select("doc_id", "crc", "n_words", covered_words().alias("cut"))
    joined = attach(docs, found.dropDuplicates(["doc_id", "crc"]))
    joined = joined.filter((F.size("x.cut") <= share * F.col("x.n_words")) | F.col("x.cut").isNull())
    separator, word = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = F.regexp_extract_all("d.text", F.lit(separator + word), F.lit(0))
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("x.cut", i + 1)), "")
    tail = F.regexp_extract("d.text", separator + r"\z", 0)
    return joined.select(*restored(docs.columns, F.when(F.col("x.cut").isNotNull(), F.concat(kept, tail)).otherwise(F.col("d.text"))))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS gram FROM b WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram FROM d, ns WHERE len(w) >= n),
h AS (SELECT dg.doc_id, dg.pos, dg.n, bg.item_id FROM dg JOIN bg ON dg.gram = bg.gram AND dg.n = bg.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""
