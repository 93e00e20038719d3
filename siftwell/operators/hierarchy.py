"""Hierarchies of clusters: levels of k-means, their edges, and flattened membership.

An edge table has (level, cluster_id, child_id, rank): members of level 1 are points, members of a higher
level are clusters of the level below.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.operators.kmeans import assign_nearest, closest_members, kmeans, random_members, sort_members


@dataclass(frozen=True)
class Level:
    """One level: its number of clusters, and how many members each passes on when resampling."""

    clusters: int
    sample_size: int = 1


def vectors_table(spark: SparkSession, centres: np.ndarray) -> DataFrame:
    """Centroids as points (point_id, embedding)."""
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "point_id long, embedding array<double>")


def hierarchical_kmeans(
    points: DataFrame, levels: list[Level], iterations: int = 50, init: str = "kmeans++", num_init: int = 1,
    resamples: int = 10, strategy: str = "closest", seed: int = 0,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(edges, centroids per level). Each level clusters the centroids below it.

    A level with sample_size above 1 is refined ``resamples`` times: members nearest to their centroid (or a
    seeded choice) are clustered again and all points assigned anew.
    """
    if strategy not in ("closest", "random"):
        raise ValueError(f"unknown strategy {strategy!r}: choose closest or random")
    spark, edges, found = points.sparkSession, None, []
    for depth, level in enumerate(levels, start=1):
        x = points.select("point_id", "embedding") if depth == 1 else vectors_table(spark, found[-1])
        centres, assigned, _ = kmeans(x, level.clusters, iterations, init, num_init, seed=seed + depth)
        for r in range(resamples if level.sample_size > 1 else 0):
            pick = closest_members(assigned, level.sample_size) if strategy == "closest" else random_members(assigned, level.sample_size, seed + r)
            centres, _, _ = kmeans(pick.select("point_id", "embedding"), level.clusters, iterations, init, num_init, seed=seed + depth + 31 * (r + 1))
            assigned = assign_nearest(x, centres)
        own = sort_members(assigned).select(F.lit(depth).alias("level"), "cluster_id", F.col("point_id").alias("child_id"), "rank")
        edges = own if edges is None else edges.unionByName(own)
        found.append(centres)
    return edges, found


def flatten(edges: DataFrame, levels: int) -> DataFrame:
    """(level, cluster_id, point_id) of every level, by one equi-join a level."""
    flat = edges.where(F.col("level") == 1).select("level", "cluster_id", F.col("child_id").alias("point_id"))
    every = flat
    for level in range(2, levels + 1):
        up = edges.where(F.col("level") == level).select(F.col("cluster_id").alias("parent"), F.col("child_id").alias("below"))
        flat = flat.join(up, F.col("cluster_id") == F.col("below")).select(F.lit(level).alias("level"), F.col("parent").alias("cluster_id"), "point_id")
        every = every.unionByName(flat)
    return every


def cluster_sizes(edges: DataFrame, levels: int) -> DataFrame:
    """(level, cluster_id, size, flat_size, size_order, flat_size_order); orders count from 1, largest first."""
    own = edges.groupBy("level", "cluster_id").agg(F.count(F.lit(1)).alias("size"))
    flat = flatten(edges, levels).groupBy(F.col("level").alias("fl"), F.col("cluster_id").alias("fc")).agg(F.count(F.lit(1)).alias("flat_size"))
    both = own.join(flat, (F.col("level") == F.col("fl")) & (F.col("cluster_id") == F.col("fc")), "left").drop("fl", "fc")
    both = both.withColumn("flat_size", F.coalesce("flat_size", F.lit(0)))
    order = lambda c: F.row_number().over(Window.partitionBy("level").orderBy(F.col(c).desc(), "cluster_id"))
    return both.withColumns({"size_order": order("size"), "flat_size_order": order("flat_size")})


def write_hierarchy(edges: DataFrame, path: str) -> None:
    """Edges as Parquet, one folder a level; refuses to overwrite."""
    edges.write.partitionBy("level").parquet(path)


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """Edges written by ``write_hierarchy``; the levels are those found."""
    return spark.read.parquet(path).select("level", "cluster_id", "child_id", "rank")


def edges_of(assigned: list[DataFrame]) -> DataFrame:
    """Edges from one assignment (point_id, cluster_id, dist) a level, the lowest level first."""
    edges = None
    for depth, rows in enumerate(assigned, start=1):
        own = sort_members(rows).select(F.lit(depth).alias("level"), F.col("cluster_id").cast("long").alias("cluster_id"), F.col("point_id").cast("long").alias("child_id"), "rank")
        edges = own if edges is None else edges.unionByName(own)
    return edges


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def stored_hierarchy(
    points: DataFrame, levels: list[Level], folder: str, iterations: int = 50, init: str = "kmeans++", num_init: int = 1,
    resamples: int = 10, strategy: str = "closest", seed: int = 0,
) -> DataFrame:
    """Edges of a hierarchy whose every step is kept in ``folder``; a step that is there is not run again.

    ``centroids/level=L/step=S`` holds (cluster_id, centroid), ``edges/level=L`` the members after the last
    step. Step 0 clusters all points of the level, later steps the members that the clusters pass on.
    """
    if strategy not in ("closest", "random"):
        raise ValueError(f"unknown strategy {strategy!r}: choose closest or random")
    spark = points.sparkSession
    centres = None
    for depth, level in enumerate(levels, start=1):
        x = points.select("point_id", "embedding") if depth == 1 else vectors_table(spark, centres)
        assigned = None
        for step in range(1 + (resamples if level.sample_size > 1 else 0)):
            place = f"{folder}/centroids/level={depth}/step={step}"
            if not _exists(spark, f"{place}/_SUCCESS"):
                pool = x
                if step:
                    pick = closest_members(assigned, level.sample_size) if strategy == "closest" else random_members(assigned, level.sample_size, seed + step - 1)
                    pool = pick.select("point_id", "embedding")
                found, _, _ = kmeans(pool, level.clusters, iterations, init, num_init, seed=seed + depth + 31 * step)
                rows = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(found)], "cluster_id long, centroid array<double>")
                rows.coalesce(1).write.mode("overwrite").parquet(place)
            rows = spark.read.parquet(place).orderBy("cluster_id").collect()
            centres = np.array([r["centroid"] for r in rows])
            assigned = assign_nearest(x, centres)
        place = f"{folder}/edges/level={depth}"
        if not _exists(spark, f"{place}/_SUCCESS"):
            edges_of([assigned]).drop("level").write.mode("overwrite").parquet(place)
    return spark.read.parquet(f"{folder}/edges").select("level", "cluster_id", "child_id", "rank")
