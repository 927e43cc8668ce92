"""Code and text edits: line diffs, unique replacements and their replay, masking, single-line faults, token counts.

Pure helpers work on one text or one pair of texts; their DataFrame wrappers run them over Arrow batches.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(df: DataFrame, columns: list[str], f: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """``f`` of the columns of each row gives result rows (key first)."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [r for values in zip(*(frame[c] for c in columns), strict=True) for r in f(*values)]
            yield pd.DataFrame(out, columns=names)

    return df.select(*columns).mapInPandas(run, schema)


def opcodes(before: list[str], after: list[str]) -> list[tuple]:
    return [op for op in difflib.SequenceMatcher(a=before, b=after, autojunk=False).get_opcodes() if op[0] != "equal"]


def changed_lines(before: str, after: str) -> list[int]:
    """Numbers (from 1) of the lines of ``after`` that were added or modified."""
    a, b = before.split("\n"), after.split("\n")
    return [n + 1 for _, _, _, lo, hi in opcodes(a, b) for n in range(lo, hi)]


def patch_size(before: str, after: str) -> int:
    a, b = before.split("\n"), after.split("\n")
    return sum(i2 - i1 + j2 - j1 for _, i1, i2, j1, j2 in opcodes(a, b))


#: Files whose lines count, top folders whose files don't.
LINE_FILES, UNCOUNTED = r"[^/]\.(gd|tscn|tres|godot|json|txt|md|cfg|gdshader)\z", ("addons", "tests_juge")


def project_patch(before: DataFrame, after: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (project, files, lines, rejected) of projects before and after, both (project, path, text).

    ``lines`` are those added or taken away in text files outside addons, hidden tests and caches; a null text is a missing
    file, which has none. ``rejected``: more than ``most``. Equal files aren't compared; where all lines are new or gone they are just counted;
    the rest goes line by line inside tasks.
    """
    counted = lambda df: df.filter(F.col("path").rlike(LINE_FILES) & ~F.split("path", "/")[0].isin(*UNCOUNTED) & ~F.col("path").rlike(r"(^|/)\.godot(/|\z)"))
    sides = [counted(df).groupBy("project", "path").agg(F.max("text").alias(name)) for df, name in ((before, "a"), (after, "b"))]
    pairs = sides[0].join(sides[1], ["project", "path"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))

    @F.pandas_udf("bigint")
    def lines(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([patch_lines(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")

    sized = pairs.withColumn("n", lines(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")))).groupBy("project").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("lines"))
    known = before.select("project").union(after.select("project")).distinct()
    n = F.coalesce("lines", F.lit(0))
    over = F.lit(False) if most is None else n > most
    return known.join(sized, "project", "left").select("project", F.coalesce("files", F.lit(0)).alias("files"), n.alias("lines"), over.alias("rejected"))


def patch_lines(before: str, after: str) -> int:
    """Lines that a patch without context takes away and adds; alignment as in the standard library's diffs."""
    a, b = before.splitlines(), after.splitlines()
    if not set(a) & set(b):
        return len(a) + len(b)
    matcher = difflib.SequenceMatcher(a=a, b=b)
    return sum(i2 - i1 + j2 - j1 for tag, i1, i2, j1, j2 in matcher.get_opcodes() if tag != "equal")


def answer_zones(before: list[str], after: list[str], context: int = 3) -> list[str]:
    """Zones of tokens that ``after`` adds, changes or lost, with context; near ones are one zone."""
    runs: list[list[int]] = []
    for _, _, _, lo, hi in opcodes(before, after):
        lo, hi = max(0, lo - context), min(len(after), hi + context)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return [" ".join(after[lo:hi]) for lo, hi in runs if hi > lo]


def occurrences(text: str, part: str) -> int:
    """How often ``part`` begins in the text, overlaps counted."""
    n, at = 0, text.find(part)
    while at >= 0:
        n, at = n + 1, text.find(part, at + 1)
    return n


def unique_edits(before: str, after: str) -> list[tuple[str, str]] | None:
    """Replacements (old, new) that turn ``before`` into ``after``, each old text unique when it is applied.

    From the end to the start, so places before an edit keep theirs; an edit grows by a line on either side until it is
    unique. None if the texts can't be told apart that way (an empty ``before``).
    """
    a, b = before.splitlines(keepends=True), after.splitlines(keepends=True)
    out, text = [], before
    for _, i1, i2, j1, j2 in reversed(opcodes(a, b)):
        lo, hi = i1, i2
        while True:
            # lines after the edit are already those of ``after``
            head, old, tail = "".join(a[lo:i1]), "".join(a[i1:i2]), "".join(a[i2:hi])
            whole = head + old + tail
            if whole and occurrences(text, whole) == 1:
                out.append((whole, head + "".join(b[j1:j2]) + tail))
                text = text.replace(whole, out[-1][1], 1)
                break
            if lo == 0 and hi == len(a):
                return None
            lo, hi = max(0, lo - 1), min(len(a), hi + 1)
            if hi > i2 and tail_changed(out, a, i2, hi):
                hi = i2 if lo < i1 or i1 == 0 else hi
                if lo == 0 and hi == i2 and occurrences(text, "".join(a[0:i2])) != 1:
                    return [(before, after)] if before else None
    return out if text == after else ([(before, after)] if before else None)


def tail_changed(done: list[tuple[str, str]], a: list[str], lo: int, hi: int) -> bool:
    """Whether lines after an edit have been touched by an edit already made."""
    tail = "".join(a[lo:hi])
    return any(tail in old or old in tail for old, _ in done)


def replay(text: str, edits: list[tuple[str, str]]) -> tuple[str, str | None]:
    """Text after the edits, and the reason of the first that couldn't be applied."""
    for old, new in edits:
        n = occurrences(text, old) if old else 0
        if n != 1:
            return text, f"found {n} times"
        text = text.replace(old, new, 1)
    return text, None


def apply_mutation(text: Column, line: Column, before: Column, after: Column) -> Column:
    """The text with its line replaced (or left out, for null); an error if the line isn't what the fault was made for."""
    lines = F.split(text, "\n")
    changed = F.concat(F.slice(lines, 1, line - 1), F.when(after.isNotNull(), F.array(after)).otherwise(F.array().cast("array<string>")), F.slice(lines, line + 1, F.size(lines)))
    return F.when(lines[line - 1] == before, F.array_join(changed, "\n")).otherwise(F.raise_error(F.lit("the line differs")).cast("string"))


def json_scan(text: str):
    """The JSON value that a text is, or else the first object or array inside it; (value, reason)."""
    import json

    try:
        return json.loads(text), None
    except ValueError:
        decoder = json.JSONDecoder()
        for m in re.finditer(r"[\[{]", text):
            try:
                return decoder.raw_decode(text, m.start())[0], None
            except ValueError:
                continue
    return None, "unreadable"
