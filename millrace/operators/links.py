"""Hierarchies and lineage in rounds that grow with the logarithm of their depth.

``group_status`` doubles ancestor links: round k joins the table of links over
2^k levels with itself, and adds to each group the totals of the groups 2^k
levels below.  A link is left after more than log2(n) rounds only on a cycle.

``lineage`` finds what is near by single steps.  If items further away are left,
chains are contracted first: every item with at most two neighbours learns the
ends of its chain and how far they are, by pointers that jump four times as far
each round; what hangs off goes, what connects becomes one edge of its length,
and this is done again until no chains are left.  Distances are found on the
rest by weighted steps, and given back to the contracted items.  A chain or a
tree takes a number of rounds like the logarithm of its size, however deep;
other graphs as many weighted steps as their contracted part asks for.

Each round is one written table, so plans and lineage stay short.  Links are
joined by key and aggregated partially; no list of neighbours is collected.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import written

#: Single steps of ``lineage`` before chains are contracted.
NEAR_STEPS = 8


def _rounds(n: int) -> int:
    """Doublings after which a path among ``n`` items has ended."""
    return max(n, 1).bit_length() + 1


def group_status(groups: DataFrame, group_id: str, parent_id: str, flows: Sequence[str], most_depth: int | None = None) -> DataFrame:
    """Each group with totals over itself and all groups below it, however deep.

    A cycle is an error, as are groups deeper than ``most_depth`` if that is given.
    A parent that is no group counts as none.
    """
    ids = groups.select(F.col(group_id).alias("u")).distinct()
    links = groups.select(F.col(group_id).alias("u"), F.col(parent_id).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL").distinct()
    links = written(links.join(ids.withColumnRenamed("u", "v"), "v", "left_semi").select("u", "v"), "group-links")
    most = _rounds(ids.count())
    names = [f"f{i}" for i in range(len(flows))]
    totals = groups.groupBy(F.col(group_id).alias("u")).agg(*(F.sum(f).alias(n) for f, n in zip(flows, names)))
    kinds = dict(totals.dtypes)
    far = ids.select("u", F.col("u").alias("v")) if most_depth is not None else None
    for k in itertools.count():
        if far is not None:
            # links over exactly most_depth + 1 levels, by its binary digits
            if (most_depth + 1) >> k & 1:
                far = written(far.join(links.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select("u", F.col("w").alias("v")), "group-depth")
            if (most_depth + 1) >> (k + 1) == 0:
                if not far.isEmpty():
                    raise RuntimeError(f"groups go deeper than {most_depth} levels")
                far = None
        if links.isEmpty():
            break
        if k > most:
            raise ValueError("a group is inside itself")
        below = links.join(totals, "u").select(F.col("v").alias("u"), *names)
        totals = written(totals.unionByName(below).groupBy("u").agg(*(F.sum(n).cast(kinds[n]).alias(n) for n in names)), "group-totals")
        links = written(links.join(links.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select("u", F.col("w").alias("v")), "group-links")
    named = totals.select("u", *(F.col(n).alias(f"total_{f}") for f, n in zip(flows, names)))
    return groups.select(group_id, parent_id).join(named, F.col(group_id) == F.col("u")).drop("u")


def _contracted(edges: DataFrame, fixed: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """((u, v, w): edges between the items that are left; (item, end, d): the ends of contracted items), or None without chains.

    ``edges`` has each edge both ways and once; ``fixed`` (u) are items to stay.
    """
    degrees = edges.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
    marked = degrees.join(fixed.withColumn("stays", F.lit(True)), "u", "left")
    chains = written(marked.filter("n <= 2 AND stays IS NULL").select("u", "n", "a", "b"), "chains")
    if chains.isEmpty():
        return None
    # half-edges (u, v): x is the item behind v, if v lies inside a chain; leaf if the chain ends there
    ahead = chains.select(F.col("u").alias("v"), "n", "a", "b")
    x = F.when(F.col("n") == 2, F.when(F.col("a") == F.col("u"), F.col("b")).otherwise(F.col("a")))
    halves = edges.join(ahead, "v", "left").select("u", "v", F.col("v").alias("end"), x.alias("x"), "w", F.coalesce(F.col("n") == 1, F.lit(False)).alias("leaf"))
    halves = written(halves, "half-edges")

    def jumped(now: DataFrame, by: DataFrame) -> DataFrame:
        on = by.select(F.col("u").alias("end"), F.col("v").alias("x"), F.col("end").alias("e"), F.col("x").alias("y"), F.col("w").alias("d"), F.col("leaf").alias("l"))
        going = now.filter("x IS NOT NULL").join(on, ["end", "x"]).select("u", "v", F.col("e").alias("end"), F.col("y").alias("x"), (F.col("w") + F.col("d")).alias("w"), F.col("l").alias("leaf"))
        return now.filter("x IS NULL").unionByName(going)

    for _ in range(_rounds(chains.count()) // 2 + 1):
        if halves.filter("x IS NOT NULL").isEmpty():
            break
        twice = jumped(halves, halves)
        halves = written(jumped(twice, twice), "half-edges")
    # what still goes on is a ring that nothing fixed touches
    ended = halves.filter("x IS NULL AND NOT leaf")
    inner = chains.select("u")
    ends = written(ended.join(inner, "u", "left_semi").select(F.col("u").alias("item"), "end", F.col("w").alias("d")), "chain-ends")
    rest = ended.join(inner, "u", "left_anti").filter("u <> end").groupBy("u", F.col("end").alias("v")).agg(F.min("w").alias("w"))
    return written(rest, "contracted"), ends


def _distances(edges: DataFrame, fixed: DataFrame) -> DataFrame:
    """(item, d): distances from the items of ``fixed`` (u), which have 0, over weighted edges."""
    contracted = []
    while (found := _contracted(edges, fixed)) is not None:
        edges = found[0]
        contracted.append(found[1])
    front = dist = written(fixed.select(F.col("u").alias("item"), F.lit(0).cast("long").alias("d")), "distances")
    while True:
        step = front.join(edges, F.col("item") == F.col("u")).groupBy("v").agg(F.min(F.col("d") + F.col("w")).alias("nd"))
        front = written(step.join(dist, F.col("v") == F.col("item"), "left").filter("d IS NULL OR nd < d").select(F.col("v").alias("item"), F.col("nd").alias("d")), "distances-front")
        if front.isEmpty():
            break
        dist = written(dist.unionByName(front).groupBy("item").agg(F.min("d").alias("d")), "distances")
    for ends in reversed(contracted):
        inner = ends.join(dist.select(F.col("item").alias("end"), F.col("d").alias("e")), "end").groupBy("item").agg(F.min(F.col("d") + F.col("e")).alias("d"))
        dist = written(dist.unionByName(inner), "distances")
    return dist


def lineage(edges: DataFrame, start: DataFrame, parent: str = "parent", child: str = "child", most_depth: int | None = None) -> DataFrame:
    """(item, depth) of all items reached from ``start`` through parents and children, however far.

    ``depth`` is the least number of steps.  With ``most_depth``, items further
    away are an error.
    """
    both = edges.select(F.col(parent).alias("u"), F.col(child).alias("v")).union(edges.select(F.col(child), F.col(parent))).filter("u <> v").distinct()
    both = written(both, "lineage-edges")
    seen = front = written(start.toDF("item").filter("item IS NOT NULL").distinct().withColumn("depth", F.lit(0)), "lineage")
    before = front
    for depth in range(1, NEAR_STEPS + 1):
        # edges lead both ways, so what a step finds anew is in neither of the two steps before
        step = front.join(both, F.col("item") == F.col("u")).select(F.col("v").alias("item")).distinct()
        step = step.join(before.union(front).select("item"), "item", "left_anti")
        before, front = front, written(step.withColumn("depth", F.lit(depth)), "lineage")
        if front.isEmpty():
            return seen
        if most_depth is not None and depth > most_depth:
            raise RuntimeError(f"items are further away than {most_depth} steps")
        seen = seen.union(front)
    past = seen.filter(F.col("depth") < NEAR_STEPS)
    rest = both
    for end in ("u", "v"):
        rest = rest.join(past.select(F.col("item").alias(end)), end, "left_anti")
    fixed = front.select(F.col("item").alias("u"))
    between = rest.join(fixed, "u", "left_semi").join(fixed.withColumnRenamed("u", "v"), "v", "left_semi")
    rest = written(rest.join(between, ["u", "v"], "left_anti").select("u", "v", F.lit(1).cast("long").alias("w")), "lineage-rest")
    far = _distances(rest, fixed).filter("d > 0").select("item", (F.col("d") + NEAR_STEPS).cast("int").alias("depth"))
    if most_depth is not None and not far.filter(F.col("depth") > most_depth).isEmpty():
        raise RuntimeError(f"items are further away than {most_depth} steps")
    return seen.union(far)
