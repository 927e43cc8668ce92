"""Spelling variants: words that differ by one inserted, deleted or replaced character, and the frequent form of each.

Candidates come from PartEnum signatures. A word is a binary vector over (letter, occurrence); one edit changes at most two of its
dimensions: one letter goes, one comes. Letters are partitioned into groups of about equal use; leaving out each pair of groups
leaves one enumeration that the edit doesn't touch, so two near words agree in it. As an edit elsewhere doesn't change the order
of the letters that stay, the signature holds them in order and is much more selective than their multiset, without losing a pair:

* words of equal length (a replacement: both letters lie in the groups left out): letters left out are masked in place;
* lengths that differ by one (one letter, one group): letters of the group are taken out of both words; the longer word is looked
  up under the shorter one's length.

Signatures meet in equi-joins, whose skewed keys Spark can split, and every candidate is verified by its edit distance. Nothing is
capped. A word has at most a few hundred near words per character, so groups of verified pairs are bounded.

Defined results: null texts have no words; null doc_ids are the empty text in the hash that thins a word; ties between forms go to
the smallest word in code-point order; repeated documents count again; without words there are no rows; extra columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize
from millrace.llm.sqltext import crc32

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
THIN = 31
#: Groups of letters for replacements, of which two are left out, and for insertions, of which one is.
REPLACED_GROUPS, INSERTED_GROUPS = 5, 4
UPPER = "".join(chr(c) for c in range(65, 91))
#: A run of letters; shorter ones than the least length can't become words.
RUN = "[A-Za-zÀ-ÿ]{%d,}"
#: Stands for a letter left out; not a letter of a run.
MASK = "*"


def runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Rows (word) of every occurrence: lower-cased A-Z, one character taken out where the hash of the place says so."""
    found = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN % least), F.lit(0)))
    low = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found.alias("run"))
    low = low.select("id", F.translate("run", UPPER, UPPER.lower()).alias("run")).select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    thin = F.expr(f"CASE WHEN h % {THIN} = 0 THEN concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2)) ELSE run END")
    return low.select(thin.alias("word")).filter(F.length("word") >= least)


def words(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """Rows (word, n) of the words that occur often enough."""
    return runs(docs, least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def letter_groups(vocabulary: DataFrame, groups: int) -> list[str]:
    """The letters of all words (at most 90 can occur) in groups of about equal use, as texts."""
    rows = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).filter("letter <> ''").groupBy("letter").count().collect()
    out, load = [""] * groups, [0] * groups
    for row in sorted(rows, key=lambda r: (-r["count"], r["letter"])):
        k = min(range(groups), key=lambda g: (load[g], g))
        out[k] += row["letter"]
        load[k] += row["count"]
    return out


def signature(j: int, column: Column) -> Column:
    return F.xxhash64(F.lit(j), column)


def replaced_signatures(groups: list[str]) -> Column:
    """One for each pair of groups left out; none where the word has no letter in them, as then none can be replaced there."""
    out = []
    for j, left_out in enumerate(combinations(groups, 2)):
        letters = "".join(left_out)
        masked = F.translate("word", letters, MASK * len(letters)) if letters else F.col("word")
        out.append(F.when(masked != F.col("word"), signature(j, masked)))
    return F.array_compact(F.array(*out))


def inserted_signatures(groups: list[str], length: Column) -> Column:
    """One for each group left out, with the shorter word's length."""
    return F.array(*(F.xxhash64(F.lit(j), length, F.translate("word", letters, "") if letters else F.col("word")) for j, letters in enumerate(groups)))


def near_pairs(vocabulary: DataFrame, replaced: int = REPLACED_GROUPS, inserted: int = INSERTED_GROUPS) -> DataFrame:
    """Rows (word, n, near, near_n), both directions, some more than once, of (word, n) with different words."""
    sides = lambda signatures, side: vocabulary.select(F.explode(signatures).alias("sig"), F.col("word").alias(f"{side}"), F.col("n").alias(f"n_{side}"))
    near = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    same = replaced_signatures(letter_groups(vocabulary, replaced))
    swaps = sides(same, "a").join(sides(same, "b"), "sig").filter((F.col("a") < F.col("b")) & (F.length("a") == F.length("b")) & near)
    groups = letter_groups(vocabulary, inserted)
    short, long = inserted_signatures(groups, F.length("word")), inserted_signatures(groups, F.length("word") - 1)
    inserts = sides(short, "a").join(sides(long, "b"), "sig").filter((F.length("a") + 1 == F.length("b")) & near)
    found = swaps.unionByName(inserts)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    return found.select(both.alias("x")).select("x.*")


def forms(vocabulary: DataFrame, ratio: int = RATIO, **groups: int) -> DataFrame:
    """Rows (word, n_near, form, form_n) of words with a near word: the most frequent one, if ``ratio`` times as frequent."""
    once = near_pairs(vocabulary, **groups).repartition("word").dropDuplicates(["word", "near"])
    best = once.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("x"))
    joined = best.join(vocabulary, "word").withColumn("high", -F.col("x.m") >= ratio * F.col("n"))
    return joined.select("word", "n", "n_near", F.when(F.col("high"), F.col("x.near")).alias("form"), F.when(F.col("high"), -F.col("x.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) of (word, form): forms followed to the last.

    A form is ``ratio`` times as frequent as its word, so there are no circles, and each round doubles the steps taken.
    """
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = now.select(F.col("word").alias("step"), F.col("root").alias("next"))
        new = materialize(now.join(far, F.col("root") == F.col("step"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if not new.filter("moved").limit(1).count():
            return now


def variants(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = RATIO, **groups: int) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of every word."""
    vocabulary = materialize(words(docs, least, count), "words")
    found = materialize(forms(vocabulary, ratio, **groups), "forms")
    last = roots(found.filter("form IS NOT NULL"))
    out = vocabulary.join(found.drop("n"), "word", "left").join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


SQL = rf"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{UPPER.lower()}') AS run FROM documents),
h AS (SELECT run, {crc32("id || ':' || run")} AS h FROM r WHERE length(run) >= {LEAST_LENGTH}),
o AS (SELECT CASE WHEN h % {THIN} = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, count(*)::BIGINT AS n FROM o WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING count(*) >= {LEAST_COUNT}),
e AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM v),
d AS (SELECT word, n, pos, left(word, pos - 1) || substring(word, pos + 1) AS rest FROM e),
p AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT DISTINCT d.word, d.n, v.word, v.n FROM d JOIN v ON d.rest = v.word UNION SELECT DISTINCT v.word, v.n, d.word, d.n FROM d JOIN v ON d.rest = v.word),
b AS (SELECT word, n, count(*)::BIGINT AS n_near, min((-near_n, encode(near))) AS x FROM p GROUP BY word, n),
f AS (SELECT word, n_near, CASE WHEN -x[1] >= {RATIO} * n THEN decode(x[2]) END AS form, CASE WHEN -x[1] >= {RATIO} * n THEN -x[1] END AS form_n FROM b),
c AS (SELECT word, form AS root, 1 AS step FROM f WHERE form IS NOT NULL UNION ALL SELECT c.word, f.form, step + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
l AS (SELECT word, arg_max(root, step) AS root FROM c GROUP BY word)
SELECT v.word, f.form, coalesce(l.root, v.word) AS root, v.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM v LEFT JOIN f USING (word) LEFT JOIN l USING (word)
"""
