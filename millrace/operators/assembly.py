"""Hints for errors, prompt contexts, hunks attached to notes, and mixed faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import vocabulary
from millrace.operators.names import close_names, listed

# How an engine's messages name a member (first group) and its class (second group, or the script's own class).
NAME = r"[A-Za-z_]\w*"
MESSAGES = (
    (rf'Function "({NAME})\(\)" not found in base self', False),
    (rf'(?:Static function|Function) "({NAME})\(\)" not found in base "({NAME})', True),
    (rf'Cannot find (?:member|property) "({NAME})" (?:in|on) base "({NAME})', True),
    (rf"Nonexistent function '({NAME})' in base '({NAME})", True),
    (rf"Invalid (?:access to property or key|set index|assignment of property or key) '({NAME})'.*?(?:base object of type|base) '({NAME})", True),
    (rf'Identifier "({NAME})" not declared in the current scope', False),
)
EXCERPT = 600


def asked_members(errors: DataFrame) -> DataFrame:
    """Errors (verdict, pos, message, own) with the (class, member) that the first fitting message form names; others go.

    ``own`` is the class of the script that failed; null messages and forms without a class are left out.
    """
    found = F.lit(None).cast("struct<class:string,member:string>")
    for pattern, has_class in reversed(MESSAGES):
        part = lambda k, p=pattern: F.regexp_extract("message", p, k)
        found = F.when(F.col("message").rlike(pattern), F.struct((part(2) if has_class else F.col("own")).alias("class"), part(1).alias("member"))).otherwise(found)
    return errors.withColumn("_f", found).select("verdict", "pos", "_f.class", "_f.member").filter("class IS NOT NULL AND member IS NOT NULL")


def explain_errors(errors: DataFrame, parents: DataFrame, members: DataFrame, docs: DataFrame, most: int = 3, ratio: float = 0.6) -> DataFrame:
    """Rows (verdict, place, class, member, kind, origin, near, excerpt): up to ``most`` different members a verdict, in order.

    A member that the class or an ancestor has comes with the nearest class that defines it and the first characters of its text
    in docs (name, text; name is class.member, once each); others with up to three near names of the class. Unknown classes go.
    """
    classes = parents.select(F.col("child").alias("class")).distinct()
    once = asked_members(errors).join(classes, "class", "left_semi").groupBy("verdict", "class", "member").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("verdict").orderBy("pos", "class", "member")
    cards = once.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)
    pairs = cards.select("class", "member").distinct()
    chain = vocabulary.closure_of(parents, pairs.select(F.col("class").alias("child")))
    inherited = vocabulary.nearest(vocabulary.members_of(chain, members)).withColumnRenamed("child", "class")
    known = inherited.join(pairs, ["class", "member"], "left_semi").groupBy("class", "member").agg(F.min(F.struct("kind", "origin")).alias("x")).select("class", "member", "x.kind", "x.origin")
    lost = pairs.join(known, ["class", "member"], "left_anti").withColumnRenamed("member", "name")
    owned = inherited.select("class", F.col("member").alias("name"))
    near = listed(close_names(lost, owned, ratio, within=["class"]), "class", "query").withColumnRenamed("query", "member")
    texts = docs.select(F.col("name").alias("_name"), F.substring("text", 1, EXCERPT).alias("excerpt"))
    full = cards.join(known, ["class", "member"], "left").join(near, ["class", "member"], "left").withColumn("_name", F.concat("origin", F.lit("."), "member"))
    return full.join(texts, "_name", "left").select("verdict", "place", "class", "member", "kind", "origin", "near", "excerpt")


# What a context shows, how it is laid out, and its limits in characters.
CITED = r"res://[A-Za-z0-9_./-]+"
HIDDEN = r"^(addons|\.godot)/|\.(uid|import)$"
SHOWN = r"\.(gd|tscn|tres|json|cfg|godot)$"
LOG = "journal.txt"
LIST_HEAD, CUT_MARK = "Fichiers du projet :\n", "\n[…contexte tronqué]"
FILE_CHARS, CONTEXT_CHARS = 12_000, 40_000


def _block(name: Column, text: Column) -> Column:
    return F.concat(F.lit("=== "), name, F.lit(" ===\n"), text)


def prompt_context(tasks: DataFrame, files: DataFrame, log_skill: str = "D1") -> DataFrame:
    """Rows (id, context) of tasks (id, project, skill, instruction) over files (project, path, text).

    The list of the project's files, its log for ``log_skill``, then the files that instruction and log cite, first cited first,
    scripts with line numbers. A list can't show more than the context's characters, so paths beyond them are dropped before
    they are gathered (each takes seven at least). Null texts are empty; a task without a project has an empty list.
    """
    paths = files.filter(~F.col("path").rlike(HIDDEN)).select("project", "path", F.split("path", "/").alias("at")).distinct()
    shown = CONTEXT_CHARS // 7
    dealt = paths.withColumn("_b", F.pmod(F.xxhash64("path"), F.lit(16)))
    first = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("project", "_b").orderBy("at"))).filter(F.col("_r") <= shown)
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("project").orderBy("at"))).filter(F.col("_r") <= shown)
    listed = first.groupBy("project").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "path"))), lambda x: F.concat(F.lit("res://"), x["path"])), "\n").alias("list"))

    text = F.substring(F.coalesce("text", F.lit("")), 1, FILE_CHARS)
    logs = files.filter(F.col("path") == LOG).select("project", F.lit(log_skill).alias("skill"), text.alias("log"))
    asked = tasks.select("id", "project", "skill", "instruction").join(logs, ["project", "skill"], "left")
    names = F.transform(F.regexp_extract_all(F.concat_ws("\n", "instruction", "log"), F.lit(CITED), F.lit(0)), lambda x: F.regexp_replace(x, r"\.+$", ""))
    cited = asked.select("id", "project", F.posexplode(F.array_distinct(names)).alias("pos", "name")).withColumn("path", F.expr("substring(name, 7)"))
    lines = F.transform(F.split("body", "\n", -1), lambda x, i: F.format_string("%4d| %s", i + 1, x))
    body = F.when(F.col("path").endswith(".gd"), F.array_join(lines, "\n")).otherwise(F.col("body"))
    wanted = cited.filter(F.col("path").rlike(SHOWN)).join(files.select("project", "path", text.alias("body")), ["project", "path"])
    blocks = wanted.select("id", "pos", _block(F.col("name"), body).alias("block")).groupBy("id")
    blocks = blocks.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "block"))), lambda x: x["block"]), "\n\n").alias("blocks"))
    whole = F.concat_ws("\n\n", F.concat(F.lit(LIST_HEAD), F.coalesce("list", F.lit(""))), _block(F.lit(LOG), F.col("log")), "blocks")
    out = asked.join(listed, "project", "left").join(blocks, "id", "left").select("id", whole.alias("context"))
    cut = F.concat(F.substring("context", 1, CONTEXT_CHARS), F.lit(CUT_MARK))
    return out.withColumn("context", F.when(F.length("context") > CONTEXT_CHARS, cut).otherwise(F.col("context")))


FILE_NAME = r"[A-Za-z0-9_-]+\.[a-z]+"


def attach_hunks(points: DataFrame, hunks: DataFrame) -> DataFrame:
    """Rows (note, hunk, point) of hunks (note, hunk, file, at, lines, names) and points (note, point, title, text, lines, names).

    A point scores 10 a line it shares with the hunk, log(1 + points / frequency) a name, 10 if its title names the file (else 2
    if its text does) and 5 if both are about tests. The best above 0.5, the lower point on ties; else the point of the nearest
    attached hunk of the file (the earlier on ties; places in a file differ); else the note's last point. Scores come from joins
    on what is shared, not from pairs of hunks and points. Hunks of notes without points go.
    """
    base = F.element_at(F.split("file", "/"), -1)
    h = hunks.select("note", "hunk", "file", "at", base.alias("base"), "lines", "names")
    sizes = points.groupBy("note").agg(F.count(F.lit(1)).alias("n"), F.max("point").alias("last"))
    each = lambda df, keys, c, name: df.select(*keys, F.explode(F.array_distinct(c)).alias(name))
    hk, pk = ["note", "hunk"], ["note", "point"]

    lines = each(h, hk, "lines", "line").join(each(points, pk, "lines", "line"), ["note", "line"]).select(*hk, "point", F.lit(10.0).alias("s"))
    pn = each(points, pk, "names", "name")
    weight = pn.groupBy("note", "name").agg(F.count(F.lit(1)).alias("f")).join(sizes, "note").select("note", "name", F.log(1 + F.col("n") / F.col("f")).alias("s"))
    names = each(h, hk, "names", "name").join(weight, ["note", "name"]).join(pn, ["note", "name"]).select(*hk, "point", "s")
    found = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(FILE_NAME), F.lit(0))
    told = each(points, pk, found("title"), "base").withColumn("s", F.lit(10.0)).unionByName(each(points, pk, found("text"), "base").withColumn("s", F.lit(2.0)))
    told = told.groupBy("note", "point", "base").agg(F.max("s").alias("s"))
    files = h.select(*hk, "base").join(told, ["note", "base"]).select(*hk, "point", "s")
    scored = lines.unionByName(names).unionByName(files).groupBy(*hk, "point").agg(F.sum("s").alias("s"))

    about = points.filter(F.lower("title").contains("test")).select(*pk, F.lit(5.0).alias("t"))
    tests = h.filter(F.col("base").contains("test")).select(*hk)
    with_tests = scored.join(tests.withColumn("_t", F.lit(True)), hk, "left").join(about, pk, "left")
    scored = with_tests.select(*hk, "point", (F.col("s") + F.when(F.col("_t"), F.coalesce("t", F.lit(0.0))).otherwise(0.0)).alias("s"))
    alone = tests.join(about.groupBy("note").agg(F.min("point").alias("point")), "note").select(*hk, "point", F.lit(5.0).alias("s"))
    scored = scored.unionByName(alone).groupBy(*hk, "point").agg(F.round(F.max("s"), 6).alias("s")).filter("s > 0.5")
    best = scored.groupBy(*hk).agg(F.max(F.struct("s", (-F.col("point")).alias("p"))).alias("x")).select(*hk, (-F.col("x.p")).alias("point"))

    rows = h.select(*hk, "file", "at").join(best, hk, "left").join(sizes, "note")
    w = Window.partitionBy("note", "file").orderBy("at", "hunk")
    placed = F.when(F.col("point").isNotNull(), F.struct("at", "point"))
    before = F.last(placed, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(placed, True).over(w.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("b", before).withColumn("a", after)
    closer = F.when(F.col("a").isNull() | (F.col("at") - F.col("b.at") <= F.col("a.at") - F.col("at")), F.col("b.point")).otherwise(F.col("a.point"))
    return rows.select(*hk, F.coalesce("point", closer, "a.point", "last").alias("point"))


def _pick(sizes: tuple[int, ...], *parts: Column | str) -> Column:
    """One of four sizes, by the first hexadecimal digit of a hash."""
    digit = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 1)) - 1
    return F.element_at(F.array(*map(F.lit, sizes)), digit % 4 + 1)


def mixed_draw(faults: DataFrame, seed: str, masking: str, script: str = r"\.gd$") -> DataFrame:
    """Rows (group, id) drawn from faults (group, id, file, line, kind): the same for the same seed, whatever the partitions.

    A group's draw: one script with faults on two lines at least, then 2 to 4 of its faults on different lines, kinds in turn,
    one of the ``masking`` kind at most; and 0 to 2 on different lines of one file of another type. Groups without such a
    script have none. One fault a line is taken first, by hash, so a kind that only shares lines with others may miss its turn.
    """
    mark = lambda *c: F.md5(F.concat_ws("|", F.lit(seed), *c))
    f = faults.select("group", "id", "file", "line", "kind", F.col("file").rlike(script).alias("_s"))
    able = f.groupBy("group", "file", "_s").agg(F.countDistinct("line").alias("lines")).filter("NOT _s OR lines >= 2")
    chosen = able.groupBy("group").agg(F.min(F.when(F.col("_s"), F.struct(mark("group", "file"), "file")))["file"].alias("_script"), F.min(F.when(~F.col("_s"), F.struct(mark("group", "file"), "file")))["file"].alias("_other"))
    mine = f.join(chosen.filter("_script IS NOT NULL"), "group").filter("file = _script OR file = _other")
    one = mine.groupBy("group", "file", "line", "_s").agg(F.min(F.struct(mark("group", "file", "line", "id").alias("h"), "id", "kind")).alias("x")).select("group", "file", "_s", "x.*")
    kind = mark("group", "kind")
    turns = one.withColumn("_k", kind).withColumn("_turn", F.when(F.col("_s"), F.row_number().over(Window.partitionBy("group", "_s", "kind").orderBy("h", "id"))).otherwise(1))
    kept = turns.filter((~F.col("_s")) | (F.col("kind") != masking) | (F.col("_turn") == 1))
    order = F.when(F.col("_s"), F.col("_k")).otherwise(F.col("h"))
    placed = kept.withColumn("_place", F.row_number().over(Window.partitionBy("group", "_s").orderBy("_turn", order, "h", "id")))
    size = F.when(F.col("_s"), _pick((2, 3, 3, 4), F.lit(seed), F.lit("script"), "group")).otherwise(_pick((0, 1, 1, 2), F.lit(seed), F.lit("other"), "group"))
    return placed.filter(F.col("_place") <= size).select("group", "id")
