"""Work in an order over groups of any size: running sums, packing, quotas. No group is one task's or the driver's."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _same(a: str, b: str, columns: list[str]) -> Column:
    return reduce(lambda x, c: x & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), columns, F.lit(True))


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` with ``place`` (from 1) within each key by ``order``, and the running sums named in ``sums``.

    Rows are sorted by ranges of (keys, order, a row number), so equal rows and large keys spread over ranges; each range adds up
    its own rows, and starts from what the ranges before it hold of the key. Nulls come first, and null keys are a key.
    """
    sums = sums or {}
    by = [*keys, *order, "_row"]
    marked = rows.select("*", F.monotonically_increasing_id().alias("_row"), *(c.alias(f"_s_{k}") for k, c in sums.items())).checkpoint()
    ranged = marked.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).checkpoint()
    own = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    mine = ranged.withColumns({"place": F.row_number().over(own), **{k: F.sum(f"_s_{k}").over(own) for k in sums}})
    parts = ranged.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("place"), *(F.sum(f"_s_{k}").alias(k) for k in sums))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", *keys, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("place", *sums)))
    full = mine.alias("m").join(starts.alias("b"), _same("m", "b", ["_part", *keys]))
    return full.select(*(F.col(f"m.{c}") for c in rows.columns), *((F.coalesce(F.col(f"m.{c}"), F.lit(0)) + F.col(f"b.{c}")).alias(c) for c in ("place", *sums)))


def pack_in_order(rows: DataFrame, key: str, order: list[str], size: str, budget: int, least: int = 0) -> DataFrame:
    """``rows`` with ``pack`` (from 0): packed greedily in order under a budget; a piece over it is a pack of its own.

    A last pack below ``least`` joins the one before (of two packs in a row one piece more is over the budget, so one step is
    enough while ``least`` is at most the budget). Where a pack that starts at a row would end follows from running sums: a merge of
    sums and limits in one order. Which rows do start one is found by following these pointers from the first, doubled each round.
    Null sizes count as 0.
    """
    summed = running(rows.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("long")), [key], order, {"_total": F.col("_size")}).checkpoint()
    ends = summed.select(key, F.col("_total").alias("v"), F.lit(0).alias("kind"), "place")
    limits = summed.select(key, (F.col("_total") - F.col("_size") + budget).alias("v"), F.lit(1).alias("kind"), "place")
    met = running(ends.unionByName(limits).withColumnRenamed("place", "i"), [key], ["v", "kind"], {"below": 1 - F.col("kind")})
    jump = met.filter("kind = 1").select(F.col(key).alias("k"), "i", F.greatest(F.col("below") + 1, F.col("i") + 1).alias("j")).checkpoint()
    nodes = jump.select("k", "i")
    starts = summed.select(F.col(key).alias("k"), F.lit(1).cast("long").alias("i")).distinct()
    while True:
        s, j = starts.alias("s"), jump.alias("j")
        found = s.join(j, F.col("s.k").eqNullSafe(F.col("j.k")) & (F.col("s.i") == F.col("j.i"))).select("s.k", F.col("j.j").alias("i"))
        more = found.join(nodes.alias("x"), found["k"].eqNullSafe(F.col("x.k")) & (found["i"] == F.col("x.i")), "left_semi").checkpoint()
        if not more.limit(1).count():
            break
        starts = starts.unionByName(more).distinct().checkpoint()
        a, b = jump.alias("a"), jump.alias("b")
        jump = a.join(b, F.col("a.k").eqNullSafe(F.col("b.k")) & (F.col("a.j") == F.col("b.i"))).select("a.k", "a.i", "b.j").checkpoint()
    flagged = summed.alias("r").join(starts.withColumn("_starts", F.lit(1)).alias("s"), F.col(f"r.{key}").eqNullSafe(F.col("s.k")) & (F.col("r.place") == F.col("s.i")), "left")
    flagged = flagged.select("r.*", F.coalesce("_starts", F.lit(0)).alias("_starts")).withColumnRenamed("place", "_place")
    packed = running(flagged, [key], ["_place"], {"pack": F.col("_starts")}).withColumn("pack", F.col("pack") - 1)
    if least:
        packed = packed.checkpoint()
        last = packed.groupBy(key, "pack").agg(F.sum("_size").alias("n")).groupBy(key).agg(F.max(F.struct("pack", "n")).alias("x")).filter((F.col("x.n") < least) & (F.col("x.pack") > 0))
        tail = last.select(F.col(key).alias("k"), F.col("x.pack").alias("short"))
        packed = packed.join(tail, F.col(key).eqNullSafe(F.col("k")), "left").withColumn("pack", F.when(F.col("pack") == F.col("short"), F.col("pack") - 1).otherwise(F.col("pack")))
    return packed.select(*rows.columns, "pack")


def proportional_quotas(shares: DataFrame, total: int) -> DataFrame:
    """Rows (grp, key, quota) of (grp, key, share): whole quotas by share that sum to ``total`` in each group.

    Shares are rounded (halves to even). What is missing then goes to the smallest quota, one by one (the lesser key of equal ones):
    the lowest are raised to one level. What is over is taken from the largest (the greater key of equal ones): the highest are
    lowered to one level. Both are closed forms over ranks. Groups without any share have quotas as if each key's share were 0.
    """
    whole = Window.partitionBy("grp")
    q = shares.withColumn("q", F.coalesce(F.bround(total * F.col("share") / F.sum("share").over(whole), 0), F.lit(0)).cast("long"))
    q = q.withColumn("d", F.lit(total) - F.sum("q").over(whole))
    up, down = Window.partitionBy("grp").orderBy("q", "key"), Window.partitionBy("grp").orderBy(F.desc("q"), F.desc("key"))
    for name, w, sign in (("u", up, 1), ("l", down, -1)):
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        # what it takes to bring all rows up to this one to this one's quota, and how many can be brought
        q = q.withColumn(f"{name}_i", F.row_number().over(w)).withColumn(f"{name}_cost", sign * (F.col(f"{name}_i") * F.col("q") - F.sum("q").over(so_far)))
        fits = F.col(f"{name}_cost") <= sign * F.col("d")
        q = q.withColumn(f"{name}_k", F.max(F.when(fits, F.col(f"{name}_i"))).over(whole)).withColumn(f"{name}_fits", F.col(f"{name}_i") <= F.col(f"{name}_k"))
        q = q.withColumn(f"{name}_sum", F.sum(F.when(F.col(f"{name}_fits"), F.col("q"))).over(whole))
        by_key = Window.partitionBy("grp", f"{name}_fits").orderBy("key" if sign > 0 else F.desc("key"))
        q = q.withColumn(f"{name}_r", F.row_number().over(by_key))
        level = (F.col(f"{name}_sum") + F.col("d")) * sign
        # the level that k rows share, and the rest, one each in order of the key
        each, rest = F.floor(level / F.col(f"{name}_k")), F.pmod(level, F.col(f"{name}_k"))
        value = (each + (F.col(f"{name}_r") <= rest).cast("long")) * sign
        q = q.withColumn(f"{name}_q", F.when(F.col(f"{name}_fits"), value).otherwise(F.col("q")))
    return q.select("grp", "key", F.when(F.col("d") > 0, F.col("u_q")).when(F.col("d") < 0, F.col("l_q")).otherwise(F.col("q")).cast("long").alias("quota"))


def extremes(rows: DataFrame, column: str, n: int = 3) -> DataFrame:
    """Rows (value, place): the n lowest, the n highest and the middle element (at count div 2 of the sorted values) of a column."""
    ranked = running(rows.select(F.col(column).alias("value")).filter("value IS NOT NULL"), [], ["value"]).checkpoint()
    count = ranked.count()
    named = F.array_compact(F.array(F.when(F.col("place") <= n, "low"), F.when(F.col("place") > count - n, "high"), F.when(F.col("place") == count // 2 + 1, "middle")))
    return ranked.select("value", F.explode(named).alias("place"))
