"""Conversations: cleaning, identity, export formats and health checks of sessions.

Messages have (session, pos, role, content); calls of the assistant (session, pos, tool, path, body) sit on its messages.
All checks of a session share one partitioning by session.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

ROLES = ("system", "user", "assistant", "tool")
PLANS = ("ORGANISATION.md", "plan.md")
#: Tools by what they do, top folders of the plan, files allowed at the root; fixed values.
READS, WRITES, CAPTURES = ("read_file", "read", "view"), ("write_file", "write", "edit"), ("capture_frames", "capture_ecran")
FOLDERS = ("0_autoload", "1_core", "2_sequence", "3_entities", "4_ui", "5_data", "6_assets", "7_tests")
ROOT_FILES = ("project.godot", "ORGANISATION.md", "plan.md", "icon.svg", "README.md", "AGENTS.md", "opencode.json", "default_bus_layout.tres", "export_presets.cfg")


def by_pos() -> WindowSpec:
    return Window.partitionBy("session").orderBy("pos")


def before() -> WindowSpec:
    return by_pos().rowsBetween(Window.unboundedPreceding, -1)


def normalized(messages: DataFrame) -> DataFrame:
    """Known fields only; role and content are always there."""
    return messages.select("session", "pos", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("content", F.lit("")).alias("content"))


def key(*columns: str) -> Column:
    """Identity of a message: hash of its fields, each led by its length, so no two field lists run together."""
    part = lambda c: F.concat(F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))).cast("string"), F.lit(":"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.sha2(F.concat(*(part(c) for c in columns)).cast("binary"), 256)


def cleaned(messages: DataFrame) -> DataFrame:
    """Known roles; nothing after the session's last assistant message."""
    known = messages.filter(F.col("role").isin(*ROLES)).withColumn("content", F.coalesce("content", F.lit("")))
    last = F.max(F.when(F.col("role") == "assistant", F.col("pos"))).over(Window.partitionBy("session"))
    return known.withColumn("_last", last).filter("pos <= _last").drop("_last")


def alternates(messages: DataFrame) -> DataFrame:
    """Whether a session is system, then user and assistant in turn, ending with assistant."""
    placed = messages.withColumn("i", F.row_number().over(by_pos()) - 1)
    fits = F.when(F.col("i") == 0, F.col("role") == "system").when(F.col("i") % 2 == 1, F.col("role") == "user").otherwise(F.col("role") == "assistant")
    return placed.groupBy("session").agg((F.bool_and(fits) & (F.count(F.lit(1)) >= 3) & (F.max_by("role", "pos") == "assistant")).alias("valid"))


def sharegpt_turns(messages: DataFrame) -> DataFrame:
    """Rows (session, turn, from, value): consecutive tool results are one turn, system messages aren't turns."""
    rows = messages.filter("role <> 'system'")
    joins = (F.col("role") == "tool") & (F.lag("role").over(by_pos()) == "tool")
    rows = rows.withColumn("joins", F.coalesce(joins, F.lit(False))).withColumn("turn", F.sum((~F.col("joins")).cast("long")).over(by_pos()) - 1)
    said = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", F.when(F.col("tool").isNotNull(), "function_call").otherwise("gpt")).otherwise("observation")
    rows = rows.withColumn("from", said).withColumn("value", F.when(F.col("from") == "function_call", F.col("tool")).otherwise(F.col("content")))
    parts = F.sort_array(F.collect_list(F.struct("pos", "value")))
    turns = rows.groupBy("session", "turn").agg(F.first("from").alias("from"), parts.alias("parts"))
    return turns.select("session", "turn", "from", F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("value"))


def sharegpt_rendered(messages: DataFrame) -> DataFrame:
    """Rows (session, system, turns, valid, same): conversations whose turns keep the template's own text.

    ``turns`` is an array of (from, value): calls are written in the reply, consecutive tool results are one human turn. System
    messages at the beginning are the system text, a line each. ``valid``: human and gpt take turns and gpt has the last word;
    ``same``: the template writes the same text from the turns as from the messages. System messages further on are turns of
    neither side, so such a session isn't valid.
    """
    talk = F.coalesce(F.max((F.col("role") != "system").cast("int")).over(by_pos().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) == 1
    joins = (F.col("role") == "tool") & (F.lag("role").over(by_pos()) == "tool")
    rows = messages.withColumns({"talk": talk, "joins": F.coalesce(joins, F.lit(False)), "text": reply()})
    rows = rows.withColumn("turn", F.sum((F.col("talk") & ~F.col("joins")).cast("int")).over(by_pos()))
    side = F.when(F.col("role") == "assistant", "gpt").when(F.col("role") == "system", "system").otherwise("human")
    lined = lambda test: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(test, F.struct("pos", "text")))), lambda x: x["text"]), "\n")
    turns = rows.groupBy("session", "turn").agg(F.min_by(side, "pos").alias("from"), lined(F.col("talk")).alias("value"), lined(~F.col("talk")).alias("system"), F.bool_or("talk").alias("talk"))
    whole = turns.groupBy("session").agg(
        F.transform(F.sort_array(F.collect_list(F.when(F.col("talk"), F.struct("turn", "from", "value")))), lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))).alias("turns"),
        F.coalesce(F.max(F.when(~F.col("talk"), F.col("system"))), F.lit("")).alias("system"),
    )
    wanted = lambda i: F.when(i % 2 == 0, "human").otherwise("gpt")
    fits = F.forall(F.transform("turns", lambda t, i: t["from"] == wanted(i)), lambda x: x) & (F.size("turns") > 0) & (F.size("turns") % 2 == 0)
    block = lambda role, text: F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))
    said = F.array_join(F.transform("turns", lambda t: block(F.when(t["from"] == "gpt", "assistant").when(t["from"] == "system", "system").otherwise("user"), t["value"])), "")
    back = F.concat(F.when(F.col("system") != "", block(F.lit("system"), F.col("system"))).otherwise(""), said)
    both = whole.withColumn("valid", fits).withColumn("back", back).join(rendered(messages), "session")
    return both.select("session", "system", "turns", "valid", (F.col("back") == F.col("text")).alias("same"))


def sharegpt_valid(turns: DataFrame) -> DataFrame:
    fits = F.when(F.col("turn") % 2 == 0, F.col("from").isin("human", "observation")).otherwise(F.col("from").isin("gpt", "function_call"))
    return turns.groupBy("session").agg((F.bool_and(fits) & F.max_by("from", "turn").isin("gpt", "function_call")).alias("valid"), F.count(F.lit(1)).alias("turns"))


def reply() -> Column:
    """What the template writes for a message: calls as tags after the text, tool results in theirs."""
    of_tool = F.concat(F.lit("<tool_response>\n"), "content", F.lit("\n</tool_response>"))
    with_call = F.concat("content", F.lit("\n<tool_call>"), "tool", F.lit("</tool_call>"))
    return F.when(F.col("role") == "tool", of_tool).when((F.col("role") == "assistant") & F.col("tool").isNotNull(), with_call).otherwise(F.col("content"))


def rendered(messages: DataFrame) -> DataFrame:
    """One text per session in a chat template: tagged turns, tool results inside user turns, calls as tags."""
    joins = (F.col("role") == "tool") & (F.lag("role").over(by_pos()) == "tool")
    opens = F.when(F.coalesce(joins, F.lit(False)), "").otherwise(F.concat(F.lit("<|im_start|>"), F.when(F.col("role") == "tool", "user").otherwise(F.col("role")), F.lit("\n")))
    ends = F.when((F.col("role") == "tool") & (F.lead("role").over(by_pos()) == "tool"), "\n").otherwise("<|im_end|>\n")
    pieces = messages.select("session", "pos", F.concat(opens, reply(), ends).alias("piece"))
    return pieces.groupBy("session").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("text"))


def served_tools(calls: DataFrame, server: str) -> DataFrame:
    """Rows (session, pos, at, tool): a server's tools in the order in which calls (session, pos, tool, arguments) use them.

    A tool is called by its name behind the server's (``server_tool``) or from code in the arguments (``["server"].tool``, quotes
    escaped or not); the name counts before the arguments. Null names and arguments call nothing.
    """
    pattern = F.lit(re.escape(server) + r"""(?:_|\\?["']\s*\]\s*\.\s*)([A-Za-z_][A-Za-z0-9_]*)""")
    found = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), pattern, F.lit(1))
    return calls.select("session", "pos", F.posexplode(F.concat(found("tool"), found("arguments"))).alias("at", "tool"))


def production(messages: DataFrame) -> DataFrame:
    n = lambda c: F.length(F.coalesce(c, F.lit("")))
    size = n("content") + n("tool") + n("path") + n("body")
    return messages.groupBy("session").agg(F.coalesce(F.sum(F.when(F.col("role") == "assistant", size)), F.lit(0)).cast("long").alias("length"))


def plan_read_first(calls: DataFrame) -> DataFrame:
    """null without a write, else whether a plan file was read before the first one."""
    plan = F.col("tool").isin(*READS) & F.element_at(F.split("path", "/"), -1).isin(*PLANS)
    first = calls.groupBy("session").agg(F.min(F.when(plan, F.col("pos"))).alias("read"), F.min(F.when(F.col("tool").isin(*WRITES), F.col("pos"))).alias("wrote"))
    return first.select("session", F.when(F.col("wrote").isNotNull(), F.coalesce(F.col("read") < F.col("wrote"), F.lit(False))).alias("plan_first"))


def repeated_writes(calls: DataFrame) -> DataFrame:
    """Writes of the same path and content as an earlier one in the session."""
    same = Window.partitionBy("session", "path", "hash").orderBy("pos")
    hashed = calls.filter(F.col("tool").isin(*WRITES)).withColumn("hash", F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256))
    return hashed.withColumn("nth", F.row_number().over(same)).filter("nth > 1").select("session", "pos", "path")


def out_of_plan(calls: DataFrame) -> DataFrame:
    inside = F.split("path", "/")[0].isin(*FOLDERS) & F.col("path").contains("/")
    allowed = ~F.col("path").contains("/") & F.col("path").isin(*ROOT_FILES)
    return calls.filter(F.col("tool").isin(*WRITES)).filter(~(inside | allowed)).select("session", "pos", "path")


def captures_without_comment(messages: DataFrame) -> DataFrame:
    """Captures whose next assistant message says nothing."""
    said = messages.filter("role = 'assistant'").withColumn("next", F.lead(F.coalesce("content", F.lit(""))).over(by_pos()))
    return said.filter(F.col("tool").isin(*CAPTURES) & (F.trim("next") == "")).select("session", "pos")


def unproven_announcements(messages: DataFrame, pattern: str) -> DataFrame:
    """Messages that announce passing tests without a passing run since the last write."""
    state = F.when(F.col("tool").isin(*WRITES), 0).when(F.col("tool") == "run_tests", F.when(F.col("tests_ok"), 1).otherwise(2))
    known = messages.withColumn("state", F.last(state, ignorenulls=True).over(before()))
    return known.filter((F.col("role") == "assistant") & F.lower("content").rlike(pattern) & (F.coalesce("state", F.lit(0)) != 1)).select("session", "pos")


def undeclared_writes(messages: DataFrame) -> DataFrame:
    """Writes outside the files declared so far; none while nothing has been declared."""
    declared = F.collect_set(F.when(F.col("tool") == "prepare_action", F.col("path"))).over(before())
    rows = messages.withColumn("known", declared).filter(F.col("tool").isin(*WRITES) & (F.size("known") > 0))
    fits = F.exists("known", lambda d: (F.col("path") == d) | F.endswith(F.col("path"), F.concat(F.lit("/"), d)))
    return rows.filter(~fits & ~F.element_at(F.split("path", "/"), -1).isin(*PLANS)).select("session", "pos", "path")


def closing_report(messages: DataFrame) -> DataFrame:
    last = messages.filter("role = 'assistant'").groupBy("session").agg(F.max_by(F.coalesce("content", F.lit("")), "pos").alias("content"))
    return last.select("session", (F.col("content").rlike(r"[\w/.-]+\.(gd|tscn|tres)\b") & F.lower("content").rlike(r"\btests?\b")).alias("report"))


def session_health(messages: DataFrame, pattern: str) -> DataFrame:
    """All checks in one row a session; the closing report is counted but doesn't fail the session."""
    calls = messages.filter("tool IS NOT NULL")
    count = lambda df, name: df.groupBy("session").agg(F.count(F.lit(1)).alias(name))
    parts = [
        plan_read_first(calls), count(repeated_writes(calls), "repeated"), count(out_of_plan(calls), "out_of_plan"),
        count(captures_without_comment(messages), "captures"), count(unproven_announcements(messages, pattern), "announced"),
        count(undeclared_writes(messages), "undeclared"), closing_report(messages),
    ]
    out = messages.select("session").distinct()
    for p in parts:
        out = out.join(p, "session", "left")
    numbers = ["repeated", "out_of_plan", "captures", "announced", "undeclared"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in numbers}).withColumn("report", F.coalesce("report", F.lit(False)))
    ok = F.coalesce("plan_first", F.lit(True))
    for c in numbers:
        ok = ok & (F.col(c) == 0)
    return out.withColumn("ok", ok)


def unpaired_calls(calls: DataFrame, returns: DataFrame) -> DataFrame:
    """Calls (session, pos, rank, id) whose return of the same rank after them is missing or has another id."""
    r = returns.select("session", "pos", "rank", F.col("id").alias("got"))
    return calls.join(r, ["session", "pos", "rank"], "left").filter(F.col("got").isNull() | (F.col("got") != F.col("id"))).select("session", "pos", "rank")


def unseen_lines(cited: DataFrame, seen: DataFrame) -> DataFrame:
    """Cited lines (session, pos, line) that no earlier message of the session has."""
    first = seen.groupBy("session", "line").agg(F.min("pos").alias("first"))
    return cited.join(first, ["session", "line"], "left").filter(F.col("first").isNull() | (F.col("first") >= F.col("pos"))).select("session", "pos", "line").distinct()
