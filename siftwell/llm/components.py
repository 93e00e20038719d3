"""Connected components of a distributed edge table.

First edges are filtered: dealt evenly, at most ``TASK_EDGES`` to a task, and each task keeps a spanning forest of
its own, as long as that halves them. Edges that fit into one task are solved so. Beyond that, alternating star
contraction (large-star, small-star): each round every node's larger neighbours, then its smaller ones, are linked
to its least neighbour, until only stars remain. That end is tested exactly: no node has two roots and no root has
one. The least neighbour is a partial aggregate, and the edges of the few nodes of the highest degrees get theirs
by broadcast, so a hub is never gathered in a task; no edge reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm.support import drop, settle, small

#: Edges that a task holds at once: two numbers each.
TASK_EDGES = 1_000_000
#: Nodes with more than a HUBS-th of all edge ends, and more than LEAST_HUB, are hubs: fewer than HUBS by counting.
HUBS, LEAST_HUB = 5000, 64


def _to_least(edges: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """(u, v) of each edge's ``v`` and the least neighbour of its ``u``; ``least`` has node, m and degree."""
    hub = F.col("degree") > max(LEAST_HUB, ends // HUBS)
    # the degrees sum up to `ends`, so fewer than HUBS rows are broadcast
    hubs = F.broadcast(least.where(hub).select(F.col("node").alias("hub"), F.col("m").alias("hub_m")))
    told = edges.join(hubs, F.col("u") == F.col("hub"), "left")
    rest = told.where(F.col("hub").isNull()).select("u", "v").join(least.where(~hub), F.col("u") == F.col("node"))
    moved = rest.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(told.where(F.col("hub").isNotNull()).select(F.col("v").alias("u"), F.col("hub_m").alias("v")))


def _least(edges: DataFrame, m) -> DataFrame:
    return edges.groupBy(F.col("u").alias("node")).agg(F.min(m).alias("m"), F.count(F.lit(1)).alias("degree"))


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a leaf to the root of a star."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where(F.col("up") + F.col("down") > 1).where(F.col("up") > 0).limit(1).count() == 0


def _forest(batches):
    """Names of all nodes of a task's edges (u, v), and the least that each reaches by them."""
    u, v = [], []
    for batch in batches:
        u.append(batch.column("u").to_numpy())
        v.append(batch.column("v").to_numpy())
    if not u:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = np.concatenate(u), np.concatenate(v)
    names, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    return names, names[bt.forest(len(names), index[: len(u)], index[len(u) :])]


def _filter(batches):
    names, roots = _forest(batches)
    moved = names != roots
    yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(roots[moved])], ["u", "v"])


def _solve(batches):
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _forest(batches)], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node of the component.

    Self loops and repeated edges count once; edges with a null end are left out; no edges, no rows.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.col("u").alias("a"), F.col("v").alias("b"))
    now = now.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = settle(now.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")))
    before, count = None, now.count()
    while count and (before is None or 2 * count <= before):
        tasks = -(-count // TASK_EDGES)
        if tasks == 1:
            return settle(now.repartition(1).mapInArrow(_solve, "node long, root long"), instead_of=now)
        now = settle(now.repartition(tasks).mapInArrow(_filter, "u long, v long"), instead_of=now)
        before, count = count, now.count()
    ends = 2 * count
    while count and not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = settle(_to_least(both.where(F.col("v") > F.col("u")), _least(both, F.least("u", "v")), ends).distinct())
        down = _least(large, F.col("v"))
        small = _to_least(large, down, ends).unionByName(down.select(F.col("node").alias("u"), F.col("m").alias("v")))
        now = settle(small.where(F.col("u") != F.col("v")).distinct(), instead_of=now)
        drop(large)
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def connected(members: DataFrame, payload: DataFrame, test) -> DataFrame:
    """``components`` of what ``test`` links within groups, without comparing all pairs of a large group.

    ``members`` has grp, rep and w, the part of a task's block that a member fills; ``payload`` has rep and what
    the test reads. ``test`` maps Arrow batches of (grp, crossed, members: rep, part, side, payload) to edges (u, v);
    it compares members of different parts, and where ``crossed`` of different sides only.

    1. Every group is compared within blocks. Groups of one block are done. In larger ones each member stands in a
       block of each of two divisions that have nothing in common, so a crowd of copies holds together at once.
    2. Each part that is connected by now sends one delegate, and delegates are compared in the same way, while that
       halves their number.
    3. What can still be linked are members of different parts. Parts are cut into blocks, small parts share
       blocks, and pairs of blocks meet unless both belong to one part. No link between parts is lost.
    """
    sizes = members.groupBy(F.col("grp").alias("sized")).agg(F.ceil(F.sum("w")).alias("blocks"), F.count(F.lit(1)).alias("n"))
    sizes = settle(sizes.where(F.col("n") > 1).select("sized", "blocks"))
    counted = members.join(sizes, F.col("grp") == F.col("sized"))
    found = components(_meet(_divided(counted, 5), payload, test))
    large = sizes.where(F.col("blocks") > 1).select("sized")
    if large.isEmpty():
        return found
    crowded = settle(members.join(small(large), F.col("grp") == F.col("sized"), "left_semi").select("grp", "rep", "w"))
    before, whole = None, False
    while True:
        parts = crowded.join(found, F.col("rep") == F.col("node"), "left").select("grp", "rep", "w", F.coalesce("root", "rep").alias("part"))
        parts = settle(parts)
        delegates = parts.groupBy("grp", "part").agg(F.min(F.struct("rep", "w")).alias("d")).select("grp", "d.rep", "d.w")
        open_ = delegates.groupBy(F.col("grp").alias("sized")).agg(F.ceil(F.sum("w")).alias("blocks"), F.count(F.lit(1)).alias("parts"))
        open_ = settle(open_.where(F.col("parts") > 1))
        left, widest = open_.agg(F.sum("parts"), F.max("blocks")).first()
        if not left:
            return found
        done = found.where(F.col("node") != F.col("root")).select(F.col("node").alias("u"), F.col("root").alias("v"))
        if whole or before is not None and 2 * left > before:
            return components(done.unionByName(_between_parts(parts, open_, payload, test)))
        before, whole = left, widest == 1
        met = _meet(_divided(delegates.join(open_, F.col("grp") == F.col("sized")), left), payload, test, few=True)
        found = components(done.unionByName(met))


def _divided(rows: DataFrame, seed: int) -> DataFrame:
    """Members (grp, rep, blocks) in their group's one block, or in a block of either division."""
    block = lambda k: F.concat(F.lit(f"{k}:"), F.pmod(F.xxhash64("grp", "rep", F.lit(seed + k)), F.col("blocks")))
    at = F.explode(F.when(F.col("blocks") > 1, F.array(block(0), block(1))).otherwise(F.array(F.lit("0"))))
    return rows.select("grp", "rep", F.col("rep").alias("part"), at.alias("lo"), F.lit(True).alias("side"), F.lit(False).alias("crossed"))


def _meet(placed: DataFrame, payload: DataFrame, test, few: bool = False) -> DataFrame:
    """The edges that ``test`` finds among ``placed``, the members (rep, part, side) of each (grp, lo, hi).

    ``few`` members may go to the payload by broadcast if counting proves that they are.
    """
    told = payload.withColumnRenamed("rep", "told")
    if few:
        placed = small(settle(placed))
    columns = [c for c in payload.columns if c != "rep"]
    if "hi" not in placed.columns:
        placed = placed.withColumn("hi", F.col("lo"))
    full = placed.join(told, F.col("rep") == F.col("told"))
    groups = full.groupBy("grp", "lo", "hi", "crossed").agg(F.collect_list(F.struct("rep", "part", "side", *columns)).alias("members"))
    return groups.select("grp", "crossed", "members").mapInArrow(test, "u long, v long")


def _between_parts(parts: DataFrame, open_: DataFrame, payload: DataFrame, test) -> DataFrame:
    """Edges between members (grp, rep, w, part) of different parts in the groups of ``open_``."""
    rows = parts.join(open_.select("sized"), F.col("grp") == F.col("sized"), "left_semi")
    sizes = rows.groupBy("grp", "part").agg(F.sum("w").alias("weight"))
    large = F.col("weight") > 0.5
    shared = sizes.where(~large).groupBy(F.col("grp").alias("sg")).agg(F.ceil(F.sum("weight")).alias("packs"))
    plan = sizes.join(shared, F.col("grp") == F.col("sg"), "left").select(
        F.col("grp").alias("pg"), F.col("part").alias("pp"), large.alias("large"), F.when(large, F.ceil("weight")).otherwise(F.col("packs")).alias("cuts")
    )
    plan = settle(plan)
    # a large part has blocks of its own, small parts share numbered ones
    label = lambda cut: F.concat_ws(":", F.when(F.col("large"), F.col("pp")), cut.cast("long"))
    blocks = plan.select("pg", F.when(F.col("large"), F.col("pp")).alias("owner"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    blocks = blocks.distinct().select("pg", "owner", F.concat_ws(":", "owner", "cut").alias("lo"))
    other = blocks.select(F.col("pg").alias("og"), F.col("owner").alias("oo"), F.col("lo").alias("hi"))
    apart = ~F.coalesce(F.col("owner") == F.col("oo"), F.lit(False))
    pairs = blocks.join(other, F.col("pg") == F.col("og")).where((F.col("lo") <= F.col("hi")) & apart).select(F.col("pg").alias("bg"), "lo", "hi")
    ends = F.array(F.col("lo"), F.col("hi"))
    held = pairs.select("bg", "lo", "hi", F.explode(F.array_distinct(ends)).alias("block"))
    cut = F.when(F.col("large"), F.pmod(F.xxhash64("rep"), F.col("cuts"))).otherwise(F.pmod(F.xxhash64("part"), F.col("cuts")))
    placed = rows.join(plan, (F.col("grp") == F.col("pg")) & (F.col("part") == F.col("pp"))).select("grp", "rep", "part", label(cut).alias("own"))
    placed = placed.join(held, (F.col("grp") == F.col("bg")) & (F.col("own") == F.col("block"))).select(
        "grp", "rep", "part", "lo", "hi", (F.col("own") == F.col("lo")).alias("side"), (F.col("lo") != F.col("hi")).alias("crossed")
    )
    return _meet(placed, payload, test, few=True)
