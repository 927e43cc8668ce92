"""First gates of candidates: task format, free-form proposals, unknown type names, parameter draws, balanced additions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.names import close_names, listed

#: Extensions that a proposal may write, steps that its judge may name.
EXTENSIONS = ("gd", "tscn", "tres", "json", "txt", "cfg", "md")
STEPS = ("import", "check_script", "load_scene", "run_tests")


def blank(column: str) -> Column:
    return F.coalesce(F.trim(column), F.lit("")) == ""


def task_format_check(tasks: DataFrame, files: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Rows (id, reason): the first reason to refuse a task, null for none.

    ``tasks`` (id, hash, and the required fields); ``files`` (id, path, hash). A task's hash is the SHA-256 of its files'
    lines "path hash", in path order. Null and blank fields are missing; a task without files has the hash of no lines.
    """
    hidden = F.col("path").rlike(r"^tests_caches/test_[^/]*\.gd$")
    lines = F.sort_array(F.collect_list(F.struct("path", F.concat_ws(" ", "path", "hash").alias("line"))))
    found = files.groupBy("id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("lines"), F.count_if(hidden).alias("tests"))
    lacking = F.array_join(F.array_compact(F.array(*(F.when(blank(c), F.lit(c)) for c in required))), ",")
    actual = F.sha2(F.coalesce("lines", F.lit("")).cast("binary"), 256)
    reason = (
        F.when(lacking != "", F.concat(F.lit("missing: "), lacking))
        .when(F.coalesce(F.col("hash"), F.lit("")) != actual, "wrong hash")
        .when(F.coalesce("tests", F.lit(0)) == 0, "no hidden test")
    )
    return tasks.join(found, "id", "left").select("id", reason.alias("reason"))


def safe_path(path: Column) -> Column:
    """A relative path without "..", backslash or drive, with a known extension; null isn't safe."""
    ok = (path != "") & ~path.contains("\\") & ~path.contains(":") & ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|\z)")
    return F.coalesce(ok & path.rlike(rf"[^/]\.({'|'.join(EXTENSIONS)})\z"), F.lit(False))


def occurrences(text: Column, part: Column) -> Column:
    """How often a part stands in a text, without overlaps; an empty or null part never does."""
    n = (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)
    return F.when(F.coalesce(F.length(part), F.lit(0)) == 0, 0).otherwise(F.coalesce(n, F.lit(0))).cast("int")


def proposal_validation(proposals: DataFrame, skills: DataFrame, version: str, shortest: int = 20) -> DataFrame:
    """Rows (id, errors): every error of a proposal, in a fixed order; an empty array for none.

    Proposals have (id, format, skill, instruction, path, base_text, before, answer, test_path, test_text, steps); null fields
    count as absent, null ``steps`` as all of them. ``skills`` (skill) is the list of known ones; it is joined, not collected.
    """
    known = skills.select("skill", F.lit(True).alias("known")).distinct()
    n = occurrences(F.col("base_text"), F.col("before"))
    test = F.element_at(F.split("test_path", "/"), -1)
    checks = (
        (~F.col("format").eqNullSafe(F.lit(version)), F.lit("format")),
        (F.col("known").isNull(), F.lit("skill")),
        (F.length(F.trim(F.coalesce("instruction", F.lit("")))) < shortest, F.lit("instruction")),
        (~safe_path(F.col("path")), F.lit("path")),
        (n != 1, F.concat(F.lit("before found "), n.cast("string"), F.lit(" times"))),
        (F.coalesce("answer", F.lit("")) == "", F.lit("answer")),
        (~F.coalesce(safe_path(F.col("test_path")) & test.rlike(r"^test_.*\.gd\z"), F.lit(False)), F.lit("test name")),
        (~F.coalesce(F.col("test_text").contains("extends GdUnitTestSuite"), F.lit(False)), F.lit("test class")),
        (F.coalesce(F.split("path", "/")[0] == "tests_juge", F.lit(False)), F.lit("reserved folder")),
        (F.size(F.array_except(F.coalesce("steps", F.array().cast("array<string>")), F.array(*map(F.lit, STEPS)))) > 0, F.lit("steps")),
    )
    errors = F.array_compact(F.array(*(F.when(bad, text) for bad, text in checks)))
    return proposals.join(known, "skill", "left").select("id", errors.alias("errors"))


def start_files(files: DataFrame, replacements: DataFrame, removals: DataFrame, additions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The files (id, path, text) from which proposals start, and the errors (id, part, k, error) of their changes.

    Replacements (id, k, path, before, after) are made in order of k, each in the file that those before it left, if ``before`` stands
    there exactly once; then removals (id, k, path) of files that are there, then additions (id, path, text; the last text of a path
    in order). A change that can't be made is an error and leaves the file. Null ids have no files.
    """
    step = F.struct("k", "before", "after")
    asked = replacements.groupBy("id", "path").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    both = files.select("id", "path", F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("there")).join(asked, ["id", "path"], "full")

    def make(state: Column, x: Column) -> Column:
        n = occurrences(state["text"], x["before"])
        lacking = state["text"].isNull() | (F.coalesce(x["before"], F.lit("")) == "") | x["after"].isNull()
        error = F.when(lacking, "unknown file or no text").when(n != 1, F.concat(F.lit("before found "), n.cast("string"), F.lit(" times")))
        text = F.when(error.isNull(), F.replace(state["text"], x["before"], x["after"])).otherwise(state["text"])
        errors = F.when(error.isNull(), state["errors"]).otherwise(F.array_append(state["errors"], F.struct(x["k"].cast("long").alias("k"), error.alias("error"))))
        return F.struct(text.alias("text"), errors.alias("errors"))

    start = F.struct(F.col("text").alias("text"), F.array().cast("array<struct<k:bigint,error:string>>").alias("errors"))
    done = both.withColumn("x", F.aggregate(F.coalesce("steps", F.array().cast(asked.schema["steps"].dataType)), start, make))
    changed = done.filter("there").select("id", "path", F.col("x.text").alias("text"))
    wrong = done.select("id", F.lit("replacement").alias("part"), F.explode("x.errors").alias("e")).select("id", "part", "e.k", "e.error")
    gone = removals.select("id", "path", F.col("k").cast("long").alias("k"), F.row_number().over(Window.partitionBy("id", "path").orderBy("k")).alias("_r"))
    lost = gone.join(files.select("id", "path", F.lit(True).alias("there")).distinct(), ["id", "path"], "left").filter("there IS NULL OR _r > 1")
    new = additions.groupBy("id", "path").agg(F.max("text").alias("text"))
    kept = changed.join(gone.select("id", "path"), ["id", "path"], "left_anti").join(new.select("id", "path"), ["id", "path"], "left_anti")
    return kept.unionByName(new), wrong.unionByName(lost.select("id", F.lit("removal").alias("part"), "k", F.lit("not there").alias("error")))


def unknown_types(scripts: DataFrame, known: DataFrame, pattern: str, local: str) -> DataFrame:
    """Rows (id, line, name): the first line of each type name of a script (id, text) that neither ``known`` (name) nor the script declares.

    Only names with a capital first letter are types. Null texts have none.
    """
    lines = scripts.select("id", F.posexplode(F.split("text", "\n")).alias("n", "text"))
    names = lambda p: F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(1)))
    used = lines.select("id", (F.col("n") + 1).alias("line"), names(pattern).alias("name")).filter(F.col("name").rlike("^[A-Z]"))
    first = used.groupBy("id", "name").agg(F.min("line").alias("line"))
    declared = scripts.select("id", names(local).alias("name")).distinct()
    return first.join(known.select("name").distinct(), "name", "left_anti").join(declared, ["id", "name"], "left_anti").select("id", "line", "name")


def with_near_types(unknown: DataFrame, known: DataFrame, ratio: float = 0.7) -> DataFrame:
    """Unknown type names (id, line, name) with ``near``: up to three known names (name) each, nearest first; null if there are none.

    Each different name is compared once, however many scripts use it.
    """
    close = listed(close_names(unknown.select("name"), known.select("name"), ratio), "query").withColumnRenamed("query", "name")
    return unknown.join(close, "name", "left").select(*unknown.columns, "near")


def parameter_grid_draw(keys: DataFrame, grid: dict[str, tuple[float, float, float, int]]) -> DataFrame:
    """The first row (key) of each different point of a grid {name: (low, high, step, digits)}, the point drawn by the key's hash."""
    out = keys.select("key")
    for name, (low, high, step, digits) in grid.items():
        places = round((high - low) / step) + 1
        at = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(name), "key").cast("binary"), 256), 1, 8), 16, 10).cast("long") % places
        out = out.withColumn(name, F.round(F.lit(low) + F.lit(step) * at, digits))
    return out.groupBy(*grid).agg(F.min("key").alias("key")).select("key", *grid)


def changed_draws(draws: DataFrame, start: DataFrame, effects: list[str]) -> DataFrame:
    """Draws (key, effects) whose effects differ from the start's and from those of every earlier key."""
    first = draws.groupBy(*effects).agg(F.min("key").alias("key"))
    same = first[effects[0]].eqNullSafe(start[effects[0]])
    for e in effects[1:]:
        same = same & first[e].eqNullSafe(start[e])
    return first.join(start, same, "left_anti").select("key", *effects)


#: Expected size of an example while fewer than two are in; a fixed value.
FIRST_MEAN = 1500


def balanced_until_budget(examples: DataFrame, targets: DataFrame, most: int = 90, first_mean: float = FIRST_MEAN) -> DataFrame:
    """Rows (grp, id, total): examples (grp, place, id, size) of a group in seeded order until the target is about reached.

    The first is always taken; another one while the sum so far and half the mean size are below the target. The mean is that of
    the examples taken but the first, and ``first_mean`` before there are any. At the first that isn't taken the group ends.

    ``place`` (what an example changes) is used once, by the first in order; ``targets`` (grp, target). Groups without a
    target get none. The order is by the hash of the id, so a run can be repeated; ``most`` is the feature's own limit.
    """
    seeded = examples.withColumn("order", F.sha2(F.col("id").cast("string").cast("binary"), 256))
    once = seeded.groupBy("grp", "place").agg(F.min(F.struct("order", "id", "size")).alias("x")).select("grp", "x.*")
    # the first ``most`` of a group lie among the first ``most`` of each of its parts
    part = once.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    near = part.withColumn("n", F.row_number().over(Window.partitionBy("grp", "part").orderBy("order"))).filter(F.col("n") <= most)
    w = Window.partitionBy("grp").orderBy("order")
    placed = near.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("total", F.sum("size").over(up)).withColumn("first", F.first("size").over(up)).join(targets, "grp")
    before = F.col("total") - F.col("size")
    mean = F.when(F.col("n") > 2, (before - F.col("first")) / (F.col("n") - 2)).otherwise(F.lit(float(first_mean)))
    goes_on = (F.col("n") == 1) | (before + mean / 2 < F.col("target"))
    return summed.withColumn("taken", F.min(goes_on.cast("int")).over(up)).filter("taken = 1").select("grp", "id", "total")


def benchmark_score(reports: DataFrame) -> DataFrame:
    """Rows (report, k, n): successes and attempts of a report (report, text) of JSON; its totals where it lists no tasks.

    Skipped tasks aren't attempts; ``tasks`` comes before ``results``. Unreadable text gives null counts.
    """
    task = "array<struct<success:boolean,skipped:boolean>>"
    d = F.from_json("text", f"tasks {task}, results {task}, success bigint, tasks_attempted bigint")
    listed = F.when(F.size(d["tasks"]) > 0, d["tasks"]).when(F.size(d["results"]) > 0, d["results"])
    tried = F.filter(listed, lambda t: ~F.coalesce(t["skipped"], F.lit(False)))
    k = F.size(F.filter(tried, lambda t: F.coalesce(t["success"], F.lit(False)))).cast("long")
    return reports.select("report", F.when(listed.isNotNull(), k).otherwise(d["success"]).alias("k"), F.when(listed.isNotNull(), F.size(tried).cast("long")).otherwise(d["tasks_attempted"]).alias("n"))
