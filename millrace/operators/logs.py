"""Logs as lines (log, line, text): noise, error blocks, categories, places, segments, repeats. Windows are per log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

#: Ordered rules of error categories (first match wins) and known noise; fixed values.
CATEGORIES = (
    ("null_instance", r"null instance|on a null value|base object of type 'nil'|in base 'nil'|previously freed"),
    ("invalid_node_path", r"node not found|invalid node path|get_node: .*not found"),
    ("signal_missing", r"nonexistent signal|signal '[^']*' (does not|doesn't) exist|no signal named"),
    ("missing_resource", r"file not found|non-existent resource|failed loading resource|cannot open file|resource file not found|no loader found"),
    ("parse_error", r"parse error|compile error|failed to compile|compilation failed"),
    ("type_error", r"invalid type|invalid assignment|trying to assign value of type|invalid operands|cannot convert|invalid argument|invalid cast|cannot be assigned|invalid call\. nonexistent function|nonexistent function|expected .* but got|invalid access to property"),
)
NOISE = r"remote port number must be between|remote debugger: unable to connect|\b(leaked|in use|exist) at exit\b"
EXIT_SUMMARY = r"\b(leaked|in use|exist) at exit\b"
COLOURS = r"\x1B\[[0-9;?]*[A-Za-z]"
START = r"^\s*(USER )?(SCRIPT ERROR|ERROR): (.*)$"
PLACE = r"\(?(res://[^\s:()]+):([0-9]+)\)?"
INLINE = r"^(res://[^\s:]+):([0-9]+) - (.*)$"
VENDORED = "res://addons/"


def by_line() -> WindowSpec:
    return Window.partitionBy("log").orderBy("line")


def category(column: str) -> Column:
    out = None
    for name, pattern in CATEGORIES:
        test = F.lower(F.col(column)).rlike(pattern)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("autre")


def without_noise(lines: DataFrame) -> DataFrame:
    """Colour codes out; noise lines out; an ``at:`` line that follows an exit summary out."""
    plain = lines.withColumn("text", F.regexp_replace("text", COLOURS, ""))
    after = F.coalesce(F.lower(F.lag("text").over(by_line())).rlike(EXIT_SUMMARY), F.lit(False)) & F.ltrim("text").startswith("at:")
    return plain.withColumn("_after", after).filter(~F.col("_after") & ~F.lower("text").rlike(NOISE)).drop("_after")


def blocks(lines: DataFrame) -> DataFrame:
    """Rows (log, block, line, message, body): a start line and the indented lines that follow it without a break."""
    starts = lines.withColumn("start", F.col("text").rlike(START)).withColumn("indented", F.col("text").rlike(r"^[ \t]"))
    numbered = starts.withColumn("block", F.sum(F.col("start").cast("long")).over(by_line())).filter("block > 0")
    in_block = Window.partitionBy("log", "block").orderBy("line")
    kept = numbered.withColumn("breaks", F.sum((~F.col("start") & ~F.col("indented")).cast("long")).over(in_block)).filter("breaks = 0")
    body = F.sort_array(F.collect_list(F.when(~F.col("start"), F.struct("line", "text"))))
    out = kept.groupBy("log", "block").agg(F.min("line").alias("line"), F.min(F.when(F.col("start"), F.col("text"))).alias("head"), body.alias("b"))
    return out.select("log", "block", "line", F.trim(F.regexp_extract("head", START, 3)).alias("message"), F.transform("b", lambda x: x["text"]).alias("body"))


def located(found: DataFrame) -> DataFrame:
    """file and number of each block: from the message itself, else the first own place of the body, else the first at all."""
    places = F.flatten(F.transform("body", lambda t: F.regexp_extract_all(t, F.lit(PLACE), F.lit(0))))
    found = found.withColumn("_p", F.transform(places, lambda p: F.regexp_replace(p, r"[()]", "")))
    own = F.filter("_p", lambda p: ~p.startswith(VENDORED))
    first = F.coalesce(F.get(own, F.lit(0)), F.get("_p", F.lit(0)))
    inline = F.col("message").rlike(INLINE)
    place = F.when(inline, F.concat_ws(":", F.regexp_extract("message", INLINE, 1), F.regexp_extract("message", INLINE, 2))).otherwise(first)
    out = found.withColumn("_place", place).withColumn("message", F.when(inline, F.regexp_extract("message", INLINE, 3)).otherwise(F.col("message")))
    file, number = F.regexp_extract("_place", r"^(.*):([0-9]+)$", 1), F.regexp_extract("_place", r"^(.*):([0-9]+)$", 2)
    return out.withColumn("file", F.when(F.col("_place").isNotNull(), file)).withColumn("number", F.when(F.col("_place").isNotNull(), number.cast("int"))).drop("_p", "_place")


def errors(lines: DataFrame) -> DataFrame:
    found = located(blocks(lines).filter(~F.lower("message").rlike(NOISE)))
    return found.select("log", "line", "message", "file", "number", category("message").alias("category"))


def distinct_errors(found: DataFrame) -> DataFrame:
    """One row per (log, file, number, category, message): the first line."""
    return found.groupBy("log", "file", "number", "category", "message").agg(F.min("line").alias("line"))


def compact(lines: DataFrame, keep: int = 2) -> DataFrame:
    """Blocks keyed by their first two lines: rows of the first ``keep`` of each key, and per log how many were dropped."""
    numbered = lines.withColumn("block", F.sum(F.col("text").rlike("^(SCRIPT ERROR|ERROR|WARNING|ok)").cast("long")).over(by_line()))
    inside = Window.partitionBy("log", "block").orderBy("line")
    heads = numbered.withColumn("i", F.row_number().over(inside)).filter("i <= 2").groupBy("log", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("key")
    )
    ranked = heads.withColumn("nth", F.row_number().over(Window.partitionBy("log", "key").orderBy("block")))
    return numbered.join(ranked, ["log", "block"]).select("log", "block", "line", "text", (F.col("nth") <= keep).alias("kept"))


def segments(lines: DataFrame, marker: str) -> DataFrame:
    """Each line with the marker line opened last before or at it; null before the first."""
    return lines.withColumn("segment", F.last(F.when(F.col("text").rlike(marker), F.col("line")), ignorenulls=True).over(by_line()))


def carried(lines: DataFrame) -> DataFrame:
    """(log, file, number, message): each ``at:`` line takes the error seen last, and each message serves once."""
    start = F.col("text").rlike(START)
    state = lines.withColumn("opened", F.last(F.when(start, F.col("line")), ignorenulls=True).over(by_line()))
    state = state.withColumn("message", F.last(F.when(start, F.trim(F.regexp_extract("text", START, 3))), ignorenulls=True).over(by_line()))
    at = state.filter(~start & F.ltrim("text").startswith("at:") & F.col("text").rlike(PLACE) & F.col("opened").isNotNull())
    first = at.groupBy("log", "opened").agg(F.min(F.struct("line", "message", "text")).alias("x")).select("log", "x.*")
    named = first.select("log", "line", "message", F.regexp_extract("text", PLACE, 1).alias("file"), F.regexp_extract("text", PLACE, 2).cast("int").alias("number"))
    return named.groupBy("log", "file", "number").agg(F.min_by("message", "line").alias("message"))


def junit_tally(cases: DataFrame) -> DataFrame:
    """Cases (report, name, outcome) to total, passed, skipped and the sorted failed names."""
    failed = F.when(F.col("outcome").isin("failure", "error"), F.col("name"))
    out = cases.groupBy("report").agg(F.count(F.lit(1)).alias("total"), F.sum((F.col("outcome") == "skipped").cast("long")).alias("skipped"), F.sort_array(F.collect_set(failed)).alias("f"))
    return out.select("report", "total", (F.col("total") - F.size("f") - F.col("skipped")).alias("passed"), "skipped", F.array_join("f", ",").alias("failed"))
