"""Hierarchical sampling: a budget shared fairly from the top level down to points.

A parent's budget is poured over its children like water: the largest whole level x with
sum(min(x, capacity)) within the budget, and the rest one each to children above x, chosen by a seeded
order or by id. At level 1 a cluster gives whole copies of all its points and the rest by seeded order or
by rank. An empty cluster has capacity 0. All of it is windows over the cluster tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.operators.hierarchy import cluster_sizes
from siftwell.operators.kmeans import seeded

STRATEGIES = ("r", "c")


def water_fill(children: DataFrame, by: list[str], capacity: str, target: str, child: str, lucky: list[Column]) -> DataFrame:
    """``children`` with ``share``; ``lucky`` orders those above the level for the remainder."""
    rising = Window.partitionBy(*by).orderBy(capacity, child)
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum(capacity).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.count(F.lit(1)).over(group) - F.row_number().over(rising) + 1
    level = F.floor((F.col(target) - before) / left)
    poured = children.withColumn("level_here", level).withColumn("nth", F.row_number().over(rising))
    poured = poured.withColumn(
        "water", F.min(F.when(F.col("level_here") < F.col(capacity), F.struct("nth", "level_here"))).over(group)["level_here"]
    )
    poured = poured.withColumn("base", F.when(F.col("water").isNull(), F.col(capacity)).otherwise(F.least(F.col("water"), F.col(capacity))))
    above = F.when(F.col("water").isNotNull() & (F.col(capacity) > F.col("water")), 1).otherwise(0)
    poured = poured.withColumn("above", above).withColumn("rest", F.col(target) - F.sum("base").over(group))
    chosen = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("above").desc(), *lucky))
    return poured.withColumn("share", (F.col("base") + ((F.col("above") == 1) & (chosen <= F.col("rest"))).cast("long")).cast("long")).drop(
        "level_here", "nth", "water", "base", "above", "rest"
    )


def cluster_targets(edges: DataFrame, levels: int, target: int, multiplier: int = 1, strategy: str = "r", seed: int = 0) -> DataFrame:
    """(cluster_id, size, share) of level 1: how many points every cluster gives."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}: choose r or c")
    if target < 0:
        raise ValueError("the target must not be negative")
    sizes = cluster_sizes(edges, levels)
    lucky = [seeded(seed, "cluster_id"), F.col("cluster_id")] if strategy == "r" else [F.col("cluster_id")]
    capacity = lambda level: sizes.where(F.col("level") == level).select("cluster_id", (F.col("flat_size") * multiplier).alias("capacity"))
    now = capacity(levels).withColumns({"whole": F.lit(0), "target": F.lit(target).cast("long")})
    now = water_fill(now, ["whole"], "capacity", "target", "cluster_id", lucky).select("cluster_id", "share")
    for level in range(levels, 1, -1):
        down = edges.where(F.col("level") == level).select(F.col("cluster_id").alias("parent"), F.col("child_id").alias("child"))
        given = now.select(F.col("cluster_id").alias("p"), F.col("share").alias("target"))
        below = capacity(level - 1)
        rows = down.join(given, F.col("parent") == F.col("p")).join(below, F.col("child") == F.col("cluster_id"))
        now = water_fill(rows.select("parent", "cluster_id", "capacity", "target"), ["parent"], "capacity", "target", "cluster_id", lucky).select("cluster_id", "share")
    first = sizes.where(F.col("level") == 1).select(F.col("cluster_id").alias("c"), "flat_size")
    return now.join(first, F.col("cluster_id") == F.col("c")).select("cluster_id", F.col("flat_size").alias("size"), "share")


def hierarchical_sample(edges: DataFrame, levels: int, target: int, multiplier: int = 1, strategy: str = "r", seed: int = 0) -> DataFrame:
    """(point_id, copies) of the sampled points; ``copies`` is above 1 only with a multiplier."""
    shares = cluster_targets(edges, levels, target, multiplier, strategy, seed).withColumnRenamed("cluster_id", "sc")
    members = edges.where(F.col("level") == 1).select("cluster_id", F.col("child_id").alias("point_id"), "rank")
    rows = members.join(shares, F.col("cluster_id") == F.col("sc"))
    order = [seeded(seed + 1, "point_id"), F.col("point_id")] if strategy == "r" else [F.col("rank"), F.col("point_id")]
    nth = F.row_number().over(Window.partitionBy("cluster_id").orderBy(*order))
    whole = F.floor(F.col("share") / F.col("size"))
    copies = whole + (nth <= F.col("share") - whole * F.col("size")).cast("long")
    return rows.withColumn("copies", copies).where(F.col("copies") > 0).select("point_id", "cluster_id", "copies")


def expand_copies(sample: DataFrame) -> DataFrame:
    """One row a copy, in order of id."""
    return sample.select("point_id", F.explode(F.array_repeat("point_id", F.col("copies").cast("int"))).alias("copy")).select("point_id")


def sample_name(levels: int, strategy: str, multiplier: int, target: int, suffix: str = "") -> str:
    """The file name of a sample."""
    return f"{levels}{strategy}_mul{multiplier}_{target}_balanced_selection{'_' + suffix if suffix else ''}"
