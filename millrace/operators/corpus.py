"""Texts as token shingles: fingerprints, exact and near duplicates, protected texts, frozen samples, overlays of file sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE = 6
#: Words (accented letters too), numbers, single other signs; blanks are named one by one as engines differ on them.
BLANKS = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
TOKEN = rf"[a-z\x{{E0}}-\x{{FF}}_][a-z\x{{E0}}-\x{{FF}}0-9_]*|[0-9]+(?:\.[0-9]+)?|[^{BLANKS}a-z\x{{E0}}-\x{{FF}}0-9_]"


def tokens(column: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(TOKEN), F.lit(0))


def bound(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def shingles(column: str, k: int = SHINGLE) -> Column:
    """Distinct shingles of k tokens as 16 hex digits; a shorter text is one shingle, a text without tokens has none."""

    def every(t: Column) -> Column:
        n = F.when(F.size(t) == 0, 0).otherwise(F.greatest(F.size(t) - k + 1, F.lit(1)))
        starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.substring(F.sha2(F.array_join(F.slice(t, i, k), " ").cast("binary"), 256), 1, 16)))

    return bound(tokens(column), every)


def shingle_rows(rows: DataFrame, key: list[str], column: str = "text", k: int = SHINGLE) -> DataFrame:
    """Rows (key, size, shingle)."""
    return rows.select(*key, shingles(column, k).alias("_s")).select(*key, F.size("_s").alias("size"), F.explode("_s").alias("shingle"))


def fingerprint(column: str) -> Column:
    return F.sha2(F.coalesce(F.col(column), F.lit("")).cast("binary"), 256)


def first_hash_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Every row with the key of the first row of equal text; an aggregation and a join, so a hot text is no hot window."""
    hashed = rows.withColumn("hash", fingerprint("text"))
    first = hashed.groupBy("hash").agg(F.min(F.struct(*order, key)).alias("x")).select("hash", F.col(f"x.{key}").alias("kept"))
    return hashed.join(first, "hash").withColumn("accepted", F.col(key) == F.col("kept"))


def pair_hashes(column: str) -> Column:
    """Hashes of a token and the next one, for each token but the last; a single token is a pair without a second."""
    return bound(tokens(column), lambda t: F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - 2, F.lit(0))), lambda i: F.xxhash64(F.get(t, i), F.get(t, i + 1))))


def shingle_hashes(column: str, k: int = SHINGLE, pairs: list[int] | None = None) -> Column:
    """Distinct shingles of k tokens as 64-bit hashes: what joins on shingles compare. ``pairs``: only those that begin with one of these."""

    def every(t: Column) -> Column:
        n = F.when(F.size(t) == 0, 0).otherwise(F.greatest(F.size(t) - k + 1, F.lit(1)))
        starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        if pairs is not None:
            starts = F.filter(starts, lambda i: F.xxhash64(F.get(t, i - 1), F.get(t, i)).isin(pairs))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(t, i, k), " "))))

    return bound(tokens(column), every)


def hashed_rows(rows: DataFrame, key: list[str], column: str = "text", k: int = SHINGLE) -> DataFrame:
    """Rows (key, size, shingle) with 64-bit shingles."""
    return rows.select(*key, shingle_hashes(column, k).alias("_s")).select(*key, F.size("_s").alias("size"), F.explode("_s").alias("shingle"))


def near_index(candidates: DataFrame, frozen: DataFrame, threshold: float = 0.8) -> DataFrame:
    """For candidates (id, grp, text): the frozen row (id, grp, text, position) that each doubles, and why.

    Equal text first (last position wins), else the lowest position of equal group and Jaccard >= threshold.

    A join with prefixes: shingles are ordered by how many frozen rows of the group have them, rarest first. Sets of n that reach
    the threshold share one of their first n - ceil(threshold n) + 1, so only these are joined, and common shingles stay out.
    Shingles that no frozen row has come first in that order and meet nothing; a candidate with less than its share of known
    ones goes at once. Frozen rows of one group and one set of shingles stand for the one of lowest position. What survives
    sizes and prefixes is counted exactly.
    """
    c, f = candidates.withColumn("hash", fingerprint("text")), frozen.withColumn("hash", fingerprint("text"))
    same = c.join(f.groupBy("hash").agg(F.max(F.struct("position", F.col("id").alias("match"))).alias("x")), "hash").select("id", F.col("x.match").alias("match"), F.lit("same_hash").alias("reason"))
    sets = f.select("grp", "position", F.col("id").alias("match"), F.sort_array(shingle_hashes("text")).alias("s")).filter("size(s) > 0")
    sets = sets.groupBy("grp", F.xxhash64("s").alias("set")).agg(F.min(F.struct("position", "match", "s")).alias("x")).select("grp", "set", F.size("x.s").alias("m"), "x.position", "x.match", "x.s").checkpoint()
    known = sets.select("grp", F.explode("s").alias("shingle")).groupBy("grp", "shingle").agg(F.count(F.lit(1)).alias("df"))
    least = lambda n: F.ceil(n * threshold - 1e-9)
    rarest = lambda n: F.col(n) - least(F.col(n)) + 1

    of_frozen = sets.select("grp", "set", "m", F.explode("s").alias("shingle")).join(known, ["grp", "shingle"]).groupBy("grp", "set", "m").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("o"))
    heads = of_frozen.select("grp", "set", "m", F.explode(F.slice("o", F.lit(1), rarest("m").cast("int"))).alias("x")).select("grp", "set", "m", "x.shingle")

    left = c.join(same.select("id"), "id", "left_anti")
    met = hashed_rows(left, ["id", "grp"]).withColumnRenamed("size", "n").join(known, ["grp", "shingle"]).groupBy("id", "grp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("o"))
    met = met.filter(F.size("o") >= least(F.col("n"))).checkpoint()
    first = rarest("n") - (F.col("n") - F.size("o"))
    tops = met.filter(first > 0).select("id", "grp", "n", F.explode(F.slice("o", F.lit(1), first.cast("int"))).alias("x")).select("id", "grp", "n", "x.shingle")
    close = (F.col("n") >= threshold * F.col("m")) & (F.col("m") >= threshold * F.col("n"))
    pairs = tops.join(heads, ["grp", "shingle"]).filter(close).select("id", "grp", "set").distinct()

    both = pairs.join(met.select("id", "grp", "n", F.transform("o", lambda x: x["shingle"]).alias("a")), ["id", "grp"]).join(sets, ["grp", "set"])
    shared = F.size(F.array_intersect("a", "s"))
    near = both.filter(shared >= threshold * (F.col("n") + F.col("m") - shared)).groupBy("id").agg(F.min(F.struct("position", "match")).alias("x"))
    return same.unionByName(near.select("id", F.col("x.match").alias("match"), F.lit("shingles").alias("reason")))


#: Shingles of protected texts up to which their table is sent to all tasks (16 bytes each and their text's key).
SENT = 200_000


def protected_hits(documents: DataFrame, protected: DataFrame, share: float = 0.6, least: int = 4) -> DataFrame:
    """Documents (id, text) that hold at least ``share`` of the shingles of a protected text (item, position, side, text).

    Returns (id, item): the protected item of lowest position. Only shingles that protected texts have are counted; while those are
    at most ``SENT`` they meet the shingles of documents where these are made, and only those that begin with a pair of tokens of a
    protected text are made; else all meet in a join by shingle, with equal results.
    """
    p = hashed_rows(protected, ["item", "position", "side"]).filter(F.col("size") >= least).checkpoint()
    of_documents = shingle_hashes("text")
    if p.limit(SENT + 1).count() <= SENT:
        p = F.broadcast(p)
        pairs = [r["pair"] for r in protected.select(F.explode(pair_hashes("text")).alias("pair")).distinct().limit(SENT + 1).collect()]
        of_documents = shingle_hashes("text", pairs=pairs if len(pairs) <= SENT else None)
    hit = documents.select("id", F.explode(of_documents).alias("shingle")).join(p, "shingle").groupBy("id", "item", "position", "side", "size").agg(F.count(F.lit(1)).alias("n"))
    return hit.filter(F.col("n") >= share * F.col("size")).groupBy("id").agg(F.min(F.struct("position", "item")).alias("x")).select("id", "x.item")


def exclude(rows: DataFrame, frozen: DataFrame) -> DataFrame:
    """Rows whose id or hash is frozen go: two anti joins instead of one join on either."""
    return rows.join(frozen.select("id").distinct(), "id", "left_anti").join(frozen.select("hash").distinct(), "hash", "left_anti")


def draw_order(seed: str, *columns: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), *(F.col(c).cast("string") for c in columns)).cast("binary"), 256)


def freeze_sample(tasks: DataFrame, seed: str, target: int, share: float, already: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """Per skill a reproducible draw of min(target, floor(share * (available + already))) - already tasks.

    Draws go by hash order, ranked within buckets of a skill first, so no skill is one task.
    """
    old = already.select("skill", "id") if already is not None else tasks.select("skill", "id").limit(0)
    free = tasks.select("skill", "id").join(old.select("id"), "id", "left_anti").withColumn("draw", draw_order(seed, "skill", "id"))
    counted = free.groupBy("skill").agg(F.count(F.lit(1)).alias("available")).join(old.groupBy("skill").agg(F.count(F.lit(1)).alias("old")), "skill", "left")
    room = F.least(F.lit(target), F.floor(share * (F.col("available") + F.coalesce("old", F.lit(0))))) - F.coalesce("old", F.lit(0))
    salted = free.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    near = salted.withColumn("_r", F.row_number().over(Window.partitionBy("skill", "_b").orderBy("draw"))).filter(F.col("_r") <= target)
    ranked = near.withColumn("_r", F.row_number().over(Window.partitionBy("skill").orderBy("draw")))
    return ranked.join(counted.select("skill", room.alias("room")), "skill").filter(F.col("_r") <= F.col("room")).select("skill", "id", "draw")


def freeze_manifest(tasks: DataFrame, seed: str, target: int, share: float, manifest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest, summary): a new manifest, or the given one completed; nothing that it has is ever removed."""
    kept = manifest.select("skill", "id") if manifest is not None else tasks.select("skill", "id").limit(0)
    full = kept.unionByName(freeze_sample(tasks, seed, target, share, kept).select("skill", "id"))
    available = tasks.groupBy("skill").agg(F.count(F.lit(1)).alias("available"))
    summary = available.join(full.groupBy("skill").agg(F.count(F.lit(1)).alias("frozen")), "skill", "left")
    return full, summary.select("skill", "available", F.coalesce("frozen", F.lit(0)).alias("frozen"), (F.coalesce("frozen", F.lit(0)) >= target).alias("complete"))


def tree_fingerprint(files: DataFrame, key: str) -> DataFrame:
    """SHA-256 of a file set: each file is hashed where it lies, only (path, hash) travel, in path order."""
    pairs = files.select(key, F.struct("path", fingerprint("text").alias("sha")).alias("x"))
    listed = pairs.groupBy(key).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return listed.select(key, F.sha2(F.concat_ws("\n", F.transform("xs", lambda x: F.concat_ws(" ", x["path"], x["sha"]))).cast("binary"), 256).alias("fingerprint"), F.size("xs").alias("files"))


#: A task's folders in order, fields of its document that change without it, steps of a judge in order, where its
#: tests lie, what a run leaves behind.
TASK_FOLDERS, VOLATILE = ("depart", "reference", "tests_caches"), ("empreinte", "gelee")
JUDGE_STEPS, JUDGE_TESTS = ("import", "check_script", "load_scene", "run_tests"), "tests_juge"
CACHES, RUN_LOGS = r"(^|/)(\.godot|reports|__pycache__|\.import|\.usine_rapports)(/|\z)|\.uid\z", ("journal.txt", "journal_tests.json")


def canonical_json(column: str, without: tuple[str, ...] = ()) -> Column:
    """A JSON object with its names in order, ", " and ": " between parts and no top-level fields of ``without``; null for anything else."""
    parsed = F.expr(f"try_cast(try_parse_json(`{column}`) AS map<string,variant>)")
    compact = F.to_json(F.map_filter(parsed, lambda k, v: ~k.isin(*without)) if without else parsed)
    return F.regexp_replace(compact, r'((?:"(?:[^"\\]|\\.)*+"|[^":,]++)*+[:,])', "$1 ")


def task_fingerprint(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """Rows (task, files, fingerprint) of tasks (task, document as JSON) and their files (task, folder, path, text).

    SHA-256 of the document without its volatile fields, then of each file's path and own SHA-256, folder by folder, paths by their
    parts. Files in other folders or in caches don't count; null texts are empty; a document that isn't an object has no fingerprint.
    """
    rank = F.array_position(F.array(*map(F.lit, TASK_FOLDERS)), F.col("folder"))
    counted = files.filter((rank > 0) & ~F.col("path").rlike(r"(^|/)\.godot(/|\z)"))
    line = F.concat(F.lit("\n"), "folder", F.lit("/"), "path", F.lit("\n"), fingerprint("text"))
    listed = counted.groupBy("task").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), F.split("path", "/").alias("at"), line.alias("line")))).alias("xs"))
    joined = tasks.select("task", canonical_json("document", VOLATILE).alias("head")).join(listed, "task", "left")
    body = F.array_join(F.transform(F.coalesce("xs", F.array().cast(listed.schema["xs"].dataType)), lambda x: x["line"]), "")
    return joined.select("task", F.coalesce(F.size("xs"), F.lit(0)).alias("files"), F.sha2(F.concat("head", body).cast("binary"), 256).alias("fingerprint"))


def quoted(text: Column) -> Column:
    """A JSON string in ASCII: other characters as \\uXXXX, those beyond 16 bits as two; null stays null."""
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    code = lambda n: F.format_string("\\u%04x", n)

    def sign(c: Column) -> Column:
        n, out = F.ascii(c), None
        for k, v in short.items():
            out = F.when(c == k, v) if out is None else out.when(c == k, v)
        two = F.concat(code(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), code(F.lit(0xDC00) + (n - 0x10000).bitwiseAND(F.lit(1023))))
        return out.when((n < 32) | ((n > 126) & (n < 0x10000)), code(n)).when(n >= 0x10000, two).otherwise(c)

    plain = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(r'\A[ !#-\[\]-~]*\z'), plain).otherwise(F.concat(F.lit('"'), F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), sign), ""), F.lit('"')))


def verdict_key(runs: DataFrame, layers: DataFrame, versions: dict[str, str]) -> DataFrame:
    """Rows (run, key): what a verdict of a run (run, steps, filter, repetition) depends on, hashed.

    ``layers`` has (run, layer, path, text): the last layer of a path counts, layer null being the judge's tests, which lie in their own folder.
    Caches don't count, nor logs of a run at the top; unknown steps go, the others take their order. ``versions``: further names and values.
    """
    tests = F.col("layer").isNull()
    clean = layers.filter(~F.col("path").rlike(CACHES) & (tests | ~F.col("path").isin(*RUN_LOGS)))
    placed = clean.select("run", F.when(tests, F.concat(F.lit(f"{JUDGE_TESTS}/"), "path")).otherwise(F.col("path")).alias("path"), F.when(tests, F.lit(2**31 - 1)).otherwise(F.col("layer")).alias("layer"), fingerprint("text").alias("sha"))
    last = placed.groupBy("run", "path").agg(F.max_by("sha", F.struct("layer", "sha")).alias("sha"))
    pairs = F.sort_array(F.collect_list(F.struct("path", F.concat(quoted(F.col("path")), F.lit(': "'), "sha", F.lit('"')).alias("line"))))
    listed = last.groupBy("run").agg(F.array_join(F.transform(pairs, lambda x: x["line"]), ", ").alias("files"))
    steps = F.array_join(F.filter(F.array(*(F.lit(f'"{x}"') for x in JUDGE_STEPS)), lambda x: F.array_contains("steps", F.translate(x, '"', ""))), ", ")
    parts = {
        "etapes": F.concat(F.lit("["), F.coalesce(steps, F.lit("")), F.lit("]")), "fichiers": F.concat(F.lit("{"), F.coalesce("files", F.lit("")), F.lit("}")),
        "filtre": F.coalesce(quoted(F.col("filter")), F.lit("null")), "rep": F.col("repetition").cast("string"), **{k: quoted(F.lit(v)) for k, v in versions.items()},
    }
    text = F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(F.lit(f'"{k}": '), parts[k]) for k in sorted(parts))), F.lit("}"))
    return runs.join(listed, "run", "left").select("run", F.sha2(text.cast("binary"), 256).alias("key"))


def overlay(layers: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Files of the last layer that has them, without those on the removal list."""
    last = layers.groupBy(key, "path").agg(F.max(F.struct("layer", "text")).alias("x")).select(key, "path", "x.layer", "x.text")
    return last.join(removed.select(key, "path"), [key, "path"], "left_anti")


def truncated(column: str, limit: int, mark: str = " […]") -> Column:
    c = F.col(column)
    return F.when(F.length(c) > limit, F.concat(F.rtrim(F.substring(c, 1, limit)), F.lit(mark))).otherwise(c)


def slug(*columns: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.concat_ws(" ", *columns)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def corpus_stats(rows: DataFrame, groups: list[list[str]], measure: str, key: str, limit: int) -> DataFrame:
    """For each grouping: rows, total, mean, least and largest measure, the row that has it, and how many exceed the limit.

    One pass over all groupings: rows are expanded into their group names and combine before the shuffle.
    """
    labels = [F.concat_ws("/", F.lit("+".join(g) or "all"), *(F.col(c).cast("string") for c in g)) for g in groups]
    spread = rows.select(F.explode(F.array(*labels)).alias("grp"), F.col(measure).alias("m"), F.col(key).alias("k"))
    largest = F.max(F.struct(F.col("m"), (-F.col("k")).alias("k")))
    return spread.groupBy("grp").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("m").alias("total"), F.avg("m").alias("mean"), F.min("m").alias("least"), F.max("m").alias("most"),
        (-largest["k"]).alias("largest"), F.sum((F.col("m") > limit).cast("long")).alias("over"),
    )
