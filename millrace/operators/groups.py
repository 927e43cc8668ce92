"""Pieces that use each other: strong components by joins, and an order in which each group comes after those it uses."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.orders import running


def strong_components(uses: DataFrame) -> DataFrame:
    """Rows (grp, node, component) of every node of the uses (grp, a, b): the greatest name of its strong component.

    Colours are sent forward along edges until the greatest name that reaches a node is known; the nodes that a colour's own node is
    reached from, within the colour, are its component. They leave, and what is left is coloured anew. Each round is a join and
    an aggregation, whose number grows with the length of paths, not with the number of nodes.
    """
    edges = uses.filter("a IS NOT NULL AND b IS NOT NULL").select("grp", "a", "b").distinct().checkpoint()
    nodes = edges.select("grp", F.col("a").alias("node")).union(edges.select("grp", F.col("b").alias("node"))).distinct().checkpoint()
    edges, done = edges.filter("a <> b"), None
    while True:
        # nodes that nothing left uses, or that use nothing left, are alone
        inner = nodes.join(edges.select("grp", F.col("a").alias("node")), ["grp", "node"], "left_semi").join(edges.select("grp", F.col("b").alias("node")), ["grp", "node"], "left_semi").checkpoint()
        alone = nodes.join(inner, ["grp", "node"], "left_anti").select("grp", "node", F.col("node").alias("component"))
        done = (alone if done is None else done.unionByName(alone)).checkpoint()
        fewer = edges.join(inner.withColumnRenamed("node", "a"), ["grp", "a"], "left_semi").join(inner.withColumnRenamed("node", "b"), ["grp", "b"], "left_semi").checkpoint()
        trimmed = inner.count() < nodes.count()
        nodes, edges = inner, fewer
        if not nodes.limit(1).count():
            return done
        if trimmed:
            continue
        colours = nodes.withColumn("colour", F.col("node"))
        while True:
            sent = edges.join(colours.withColumnRenamed("node", "a"), ["grp", "a"]).select("grp", F.col("b").alias("node"), "colour")
            new = colours.unionByName(sent).groupBy("grp", "node").agg(F.max("colour").alias("new"))
            both = new.join(colours, ["grp", "node"]).select("grp", "node", F.col("new").alias("colour"), (F.col("new") != F.col("colour")).alias("moved")).checkpoint()
            colours = both.select("grp", "node", "colour")
            if not both.filter("moved").limit(1).count():
                break
        inside = edges.join(colours.select("grp", F.col("node").alias("a"), F.col("colour").alias("x")), ["grp", "a"]).join(colours.select("grp", F.col("node").alias("b"), "colour"), ["grp", "b"])
        inside = inside.filter("x = colour").select("grp", "a", "b", "colour").checkpoint()
        found = colours.filter("node = colour").checkpoint()
        newest = found
        while True:
            back = inside.join(newest.select("grp", F.col("node").alias("b"), "colour"), ["grp", "b", "colour"]).select("grp", F.col("a").alias("node"), "colour").distinct()
            newest = back.join(found, ["grp", "node"], "left_anti").checkpoint()
            if not newest.limit(1).count():
                break
            found = found.unionByName(newest).checkpoint()
        done = done.unionByName(found.select("grp", "node", F.col("colour").alias("component"))).checkpoint()
        nodes = nodes.join(found, ["grp", "node"], "left_anti").checkpoint()
        edges = edges.join(found.withColumnRenamed("node", "a"), ["grp", "a"], "left_anti").join(found.withColumnRenamed("node", "b"), ["grp", "b"], "left_anti").select("grp", "a", "b").checkpoint()


#: Rows of a group up to which it is put in order inside one task.
SMALL = 500


def in_order(uses: set[tuple[str, str]]) -> list[tuple[int, int, list[str]]]:
    """(place, layer, pieces) of the uses (a, b) of one group: Tarjan's components, which come after those they use."""
    after: dict[str, list[str]] = {}
    for a, b in uses:
        after.setdefault(a, []).append(b)
        after.setdefault(b, [])
    number: dict[str, int] = {}
    low: dict[str, int] = {}
    layer: dict[str, int] = {}
    stack, found = [], []
    for root in after:
        if root in number:
            continue
        number[root] = low[root] = len(number)
        stack.append(root)
        path = [(root, iter(after[root]))]
        while path:
            node, rest = path[-1]
            for other in rest:
                if other not in number:
                    number[other] = low[other] = len(number)
                    stack.append(other)
                    path.append((other, iter(after[other])))
                    break
                if other not in layer:  # still on the stack
                    low[node] = min(low[node], number[other])
            else:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[node])
                if low[node] == number[node]:
                    at = stack.index(node)
                    pieces = sorted(stack[at:])
                    del stack[at:]
                    deep = max((layer[x] + 1 for p in pieces for x in after[p] if x in layer), default=0)
                    layer.update(dict.fromkeys(pieces, deep))
                    found.append((deep, pieces))
    return [(place, deep, pieces) for place, (deep, pieces) in enumerate(sorted(found))]


def small_groups(uses: DataFrame) -> DataFrame:
    """What ``dependency_groups`` says of groups of few rows: rows of a group meet in a task, which holds one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, key, edges, out = None, None, set(), []

        def made() -> pa.RecordBatch:
            grp, place, layer, pieces = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
            return pa.RecordBatch.from_arrays([pa.array(grp, kind), pa.array(place, pa.int64()), pa.array(layer, pa.int32()), pa.array(pieces, pa.list_(pa.string()))], ["grp", "place", "layer", "pieces"])

        for batch in batches:
            kind = batch.schema.field("grp").type
            for g, a, b in zip(*(batch.column(c).to_pylist() for c in ("grp", "a", "b")), strict=True):
                if edges and g != key:
                    out += [(key, *x) for x in in_order(edges)]
                    edges = set()
                key = g
                edges.add((a, b))
            yield made()
            out.clear()
        if edges:
            out += [(key, *x) for x in in_order(edges)]
            yield made()

    kind = uses.schema["grp"].dataType.simpleString()
    return uses.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, f"grp {kind}, place bigint, layer int, pieces array<string>")


def dependency_groups(uses: DataFrame) -> DataFrame:
    """Rows (grp, place, layer, pieces) of uses (grp, a, b), a using b: pieces that must go together, in an order of use.

    A group's layer is one more than the deepest of the groups it uses (0 without any), so each group comes after those it uses;
    within a layer the least name decides. ``pieces`` are a group's names, sorted. Null names are left out.

    Groups of up to ``SMALL`` rows are put in order inside tasks, after one shuffle; larger ones by rounds of joins.
    """
    rows = uses.filter("grp IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL").select("grp", "a", "b")
    large = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SMALL).select("grp").checkpoint()
    if not large.limit(1).count():
        return small_groups(rows)
    return small_groups(rows.join(large, "grp", "left_anti")).unionByName(large_groups(rows.join(large, "grp", "left_semi")))


def large_groups(uses: DataFrame) -> DataFrame:
    """What ``dependency_groups`` says, for groups of any size: each round of joins goes over all of them."""
    parts = strong_components(uses).checkpoint()
    of = lambda name: parts.select("grp", F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    between = uses.select("grp", "a", "b").join(of("a"), ["grp", "a"]).join(of("b"), ["grp", "b"]).filter("ca <> cb").select("grp", "ca", "cb").distinct().checkpoint()
    layers = parts.select("grp", "component").distinct().withColumn("layer", F.lit(0)).checkpoint()
    while True:
        above = between.join(layers.select("grp", F.col("component").alias("cb"), "layer"), ["grp", "cb"]).groupBy("grp", F.col("ca").alias("component")).agg((F.max("layer") + 1).alias("new"))
        both = layers.join(above, ["grp", "component"], "left").select("grp", "component", F.greatest("layer", F.coalesce("new", F.lit(0))).alias("layer"), (F.coalesce("new", F.lit(0)) > F.col("layer")).alias("moved")).checkpoint()
        layers = both.drop("moved")
        if not both.filter("moved").limit(1).count():
            break
    named = parts.groupBy("grp", "component").agg(F.sort_array(F.collect_list("node")).alias("pieces")).join(layers, ["grp", "component"])
    placed = running(named.select("grp", "layer", F.col("pieces")[0].alias("first"), "pieces"), ["grp"], ["layer", "first"])
    return placed.select("grp", (F.col("place") - 1).alias("place"), "layer", "pieces")
