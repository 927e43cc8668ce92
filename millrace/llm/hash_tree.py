"""Sharding by a weighted tree of regions, racks and shards, descended by hash draws of a document's key.

At each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of the key and the child's name, and the least draw wins:
a child wins in proportion to its weight, and its draw depends on nothing but the key, its name and its weight. So if weights
change, rows move only at the nodes on the changed paths: a region of greater weight only takes rows in, within it likewise, and
subtrees without a change keep all rows they held. A grown tree gets its new shard as a region of its own: no weight of the
older nodes changes, and rows move only into the new shard.

A node's weight is the sum of the shards below it. Nothing of the tree but its nodes travels with the plan; the tree is a
setting of the caller, not data.

``slots`` numbers the rows of a shard without a task that holds a shard: rows are sorted by ranges, numbered within a range,
and each range starts where the counts of those before it end. Repeated rows are told apart by a row number, so that many
equal rows spread over ranges too.

Defined results: null texts have size 1 and the checksum of nothing; null keys are drawn as the empty text; rows of one key go to
one shard, repeated or not; slots follow ascending doc_id (nulls first), size, checksum; without rows there are none; extra
columns are ignored by ``assign`` and kept by ``place``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, utf8
from millrace.llm.sqltext import crc32


@dataclass(frozen=True)
class Tree:
    """``leaves``: (region, rack, shard, weight) of each shard; the shard's number is unique in the tree."""

    leaves: tuple[tuple[str, str, int, float], ...]

    def __post_init__(self) -> None:
        shards = [x[2] for x in self.leaves]
        if not shards or len(set(shards)) < len(shards) or any(x[3] < 0 for x in self.leaves) or not any(x[3] > 0 for x in self.leaves):
            raise ValueError("a tree has shards of different numbers, weights of at least 0, and one above 0")

    @classmethod
    def regular(cls, shards: int, racks: int = 2, per_rack: int = 2) -> Tree:
        """Shards 0 .. shards-1 of weight 1, ``per_rack`` in a rack and ``racks`` racks in a region."""
        place = lambda s: (f"r{s // (racks * per_rack)}", f"k{s // per_rack % racks}", s, 1.0)
        return cls(tuple(place(s) for s in range(shards)))

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own."""
        new = max(x[2] for x in self.leaves) + 1
        return Tree((*self.leaves, (f"new{new}", "k0", new, weight)))

    def weighted(self, shard: int, weight: float) -> Tree:
        return Tree(tuple((a, b, c, weight if c == shard else w) for a, b, c, w in self.leaves))

    def children(self) -> list[dict[str, list[tuple[str, float]]]]:
        """For each level: path of a node -> (path of a child, weight); nodes of weight 0 are never drawn and left out."""
        levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
        for region, rack, shard, weight in self.leaves:
            path = ["", f"{region}", f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            for level in range(3):
                below = levels[level].setdefault(path[level], {})
                below[path[level + 1]] = below.get(path[level + 1], 0.0) + weight
        return [{k: [(n, w) for n, w in v.items() if w > 0] for k, v in level.items() if any(v.values())} for level in levels]


def unit(key: Column, name: Column) -> Column:
    """A number between 0 and 1 from a hash of key and name."""
    return (F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def draw(key: Column, children: Column) -> Column:
    """The child (name, weight) of the least draw; equal draws go to the lesser name."""
    drawn = F.transform(children, lambda c: F.struct((-F.log(unit(key, c["name"])) / c["weight"]).alias("draw"), c["name"].alias("name")))
    return F.array_min(drawn)["name"]


def descend(key: Column, tree: Tree) -> Column:
    """The shard of a key (a text column)."""
    node = F.lit("")
    for level in tree.children():
        listed = lambda nodes: F.array(*(F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in nodes))
        below = F.create_map(*(x for k, v in level.items() for x in (F.lit(k), listed(v))))
        node = draw(key, F.element_at(below, node))
    return F.element_at(F.split(node, "/"), -1).cast("int")


def place(rows: DataFrame, tree: Tree, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """``rows`` with the column ``shard``, which replaces one of that name."""
    return rows.withColumn(shard, descend(F.coalesce(F.col(key).cast("string"), F.lit("")), tree))


def slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """``placed`` (with a column shard) with ``slot``: 0, 1, .. within each shard, by ``order``."""
    rows = materialize(placed.withColumn("_row", F.monotonically_increasing_id()), "placed")
    by = ["shard", *order, "_row"]
    ranged = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    parts = ranged.groupBy("shard", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("shard").alias("_shard"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"))
    joined = ranged.join(starts, (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_p")))
    return joined.select(*placed.columns, (F.col("_at") + F.col("_shift")).alias("slot"))


SHARDS = 16


def assign(docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard): each document's shard now and with one more shard."""
    tree = tree or Tree.regular(SHARDS)
    text = docs.select("doc_id", (F.octet_length(utf8("text")) + 1).cast("long").alias("size"), F.crc32(utf8("text")).alias("text_crc32"))
    placed = place(place(text, tree), tree.grown(), shard="grown_shard")
    return slots(placed, ["doc_id", "size", "text_crc32"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _sql() -> str:
    tree = Tree.regular(SHARDS)
    nodes = {(p, n, w) for t in (tree, tree.grown()) for level in t.children() for p, c in level.items() for n, w in c}
    values = ", ".join(f"('{p}', '{n}', {w})" for p, n, w in sorted(nodes))
    step = lambda k, path, keep, only: f"""s{k} AS (SELECT doc_id, {keep} arg_min(name, draw) AS node FROM (SELECT s.*, name,
  -ln((('0x' || substring(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || name), 1, 13))::BIGINT + 0.5) / 4503599627370496) / weight AS draw FROM {path} s JOIN nodes ON parent = {only}) GROUP BY ALL)"""  # noqa: E731
    old = "s.node AND name NOT LIKE 'new%'"
    return f"""WITH nodes(parent, name, weight) AS (VALUES {values}), ids AS (SELECT DISTINCT doc_id, '' AS node FROM documents),
{step("1", "ids", "", old)}, {step("2", "s1", "", "s.node")}, {step("3", "s2", "", "s.node")},
{step("4", "ids", "", "s.node")}, {step("5", "s4", "", "s.node")}, {step("6", "s5", "", "s.node")},
t AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
p AS (SELECT t.*, string_split(s3.node, '/')[3]::INTEGER AS shard, string_split(s6.node, '/')[3]::INTEGER AS grown_shard
  FROM t JOIN s3 ON t.doc_id IS NOT DISTINCT FROM s3.doc_id JOIN s6 ON t.doc_id IS NOT DISTINCT FROM s6.doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM p"""


SQL = _sql()
