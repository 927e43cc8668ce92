"""Class trees, their members, references between files, names and settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def closure(parents: DataFrame) -> DataFrame:
    """Rows (child, ancestor, depth), the class itself at depth 0, from (child, parent).

    Rounds of joins that double the known depth; a cycle stops as its classes are known already.
    """
    known = parents.select("child", F.col("child").alias("ancestor"), F.lit(0).alias("depth"))
    known = known.unionByName(parents.filter("parent IS NOT NULL AND parent <> child").select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")))
    reach = 1
    while True:
        further = known.filter(F.col("depth") == reach).alias("a").join(known.filter("depth > 0").alias("b"), F.col("a.ancestor") == F.col("b.child"))
        grown = known.unionByName(further.select("a.child", "b.ancestor", (F.col("a.depth") + F.col("b.depth")).alias("depth")))
        grown = grown.groupBy("child", "ancestor").agg(F.min("depth").alias("depth")).checkpoint()
        if grown.filter(F.col("depth") > reach).limit(1).count() == 0:
            return grown
        known, reach = grown, reach * 2


def closure_of(parents: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows (child, ancestor, depth) of the asked classes (child) only, each itself at depth 0: one join a step up the tree.

    Classes that ``parents`` doesn't have are left out; a cycle stops as its classes are known already.
    """
    up = parents.filter("parent IS NOT NULL AND parent <> child").select(F.col("child").alias("ancestor"), F.col("parent").alias("next")).distinct()
    newest = starts.select("child").distinct().join(parents.select("child").distinct(), "child", "left_semi").select("child", F.col("child").alias("ancestor"), F.lit(0).alias("depth")).checkpoint()
    known, depth = newest, 0
    while newest.limit(1).count():
        depth += 1
        found = newest.join(up, "ancestor").select("child", F.col("next").alias("ancestor")).distinct()
        newest = found.join(known, ["child", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        known = known.unionByName(newest)
    return known


def members_of(chain: DataFrame, members: DataFrame) -> DataFrame:
    """Members (class, member, kind) with every class that has them, through its ancestors: (child, member, kind, origin, depth)."""
    m = members.select(F.col("class").alias("ancestor"), "member", "kind")
    return chain.join(m, "ancestor").select("child", "member", "kind", F.col("ancestor").alias("origin"), "depth")


def nearest(inherited: DataFrame) -> DataFrame:
    """For (child, member, kind) the nearest class that defines it."""
    return inherited.groupBy("child", "member", "kind").agg(F.min(F.struct("depth", "origin")).alias("x")).select("child", "member", "kind", "x.origin")


def in_descendants(chain: DataFrame, members: DataFrame) -> DataFrame:
    """(class, member) pairs that a class below defines."""
    m = members.select(F.col("class").alias("child"), "member")
    return chain.filter("depth > 0").join(m, "child").select(F.col("ancestor").alias("class"), "member").distinct()


def arity(calls: DataFrame, signatures: DataFrame) -> DataFrame:
    """Calls (call, name, given) outside the signature's (least, most) arguments; most null is unbounded."""
    return calls.join(signatures, "name").filter((F.col("given") < F.col("least")) | (F.col("given") > F.col("most"))).select("call", "name", "given")


def unknown_members(accesses: DataFrame, chain: DataFrame, members: DataFrame, project: DataFrame) -> DataFrame:
    """Accesses (access, class, member) whose member no ancestor, no descendant and no project file has."""
    own = members_of(chain, members).select(F.col("child").alias("class"), "member").distinct()
    left = accesses.join(own, ["class", "member"], "left_anti").join(in_descendants(chain, members), ["class", "member"], "left_anti")
    return left.join(project.select("member").distinct(), "member", "left_anti").select("access", "class", "member")


def links(pages: DataFrame, pattern: str) -> DataFrame:
    """Rows (src, dst) of the references in a text."""
    return pages.select("src", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("dst")).distinct()


def forbidden(edges: DataFrame, allowed: DataFrame) -> DataFrame:
    """Edges between folders that the permission table (from_folder, to_folder) lacks; a folder may always use itself."""
    across = edges.filter("from_folder <> to_folder").dropDuplicates(["src", "dst"])
    return across.join(F.broadcast(allowed), ["from_folder", "to_folder"], "left_anti").select("src", "dst", "from_folder", "to_folder")


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Nodes reached from the starts, with the least number of steps; each round joins only the newest nodes."""
    seen = starts.select("node", F.lit(0).alias("steps")).distinct()
    newest, step = seen, 0
    while True:
        step += 1
        found = newest.join(edges, newest["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti")
        newest = found.select("node", F.lit(step).alias("steps")).checkpoint()
        if not newest.limit(1).count():
            return seen
        seen = seen.unionByName(newest).checkpoint()


def snake(column: Column) -> Column:
    spaced = F.regexp_replace(F.regexp_replace(column, "([a-z0-9])([A-Z])", "$1_$2"), "([A-Z]+)([A-Z][a-z])", "$1_$2")
    return F.lower(F.regexp_replace(spaced, "[^A-Za-z0-9]+", "_"))


def settings_diff(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Key by key comparison of (key.., name, value): changed, added or removed."""
    x, y = a.withColumnRenamed("value", "old"), b.withColumnRenamed("value", "new")
    both = x.withColumn("in_a", F.lit(True)).join(y.withColumn("in_b", F.lit(True)), [*key, "name"], "full")
    change = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.withColumn("change", change).filter("change IS NOT NULL").select(*key, "name", "old", "new", "change")


def merge_ranges(ranges: DataFrame, key: str, margin: int, gap: int, last: Column) -> DataFrame:
    """Ranges (key, lo, hi) widened by a margin, clipped to 1..last and merged when the gap is small."""
    w = Window.partitionBy(key).orderBy("lo", "hi")
    wide = ranges.select(key, F.greatest(F.col("lo") - margin, F.lit(1)).alias("lo"), F.least(F.col("hi") + margin, last).alias("hi"))
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = wide.withColumn("new", (before.isNull() | (F.col("lo") > before + gap)).cast("long")).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(key, "lo", "hi")
