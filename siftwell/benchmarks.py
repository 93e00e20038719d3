"""Timing of image selection over numbers of partitions, and the rollup of such timings."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import PatchOptions
from siftwell.operators.tiling import describe_images


def time_runs(images: DataFrame, partitions: tuple[int, ...], options: PatchOptions = PatchOptions(), warm_up: int = 1) -> list[dict]:
    """Seconds and rates of describing ``images`` dealt over each number of partitions."""
    n, out = images.count(), []
    for parts in partitions:
        for run in range(warm_up + 1):
            began = time.perf_counter()
            tiles = describe_images(images.repartition(parts), options).agg(F.count_if(F.col("error").isNull())).first()[0]
            took = time.perf_counter() - began
        out.append(
            {"backend": "spark", "workers": parts, "images": n, "seconds": took, "seconds_per_image": took / max(n, 1), "images_per_second": n / took, "patches_per_second": tiles / took}
        )
    return out


def summarize(runs: DataFrame) -> DataFrame:
    """(backend, best_workers, best_rate, speedup): the best worker count of each backend by images per second.

    ``speedup`` compares with the first backend by name at the same worker count; null if it has no such run.
    """
    best = runs.groupBy("backend").agg(F.max_by(F.struct("workers", "images_per_second"), F.struct("images_per_second", -F.col("workers"))).alias("b"))
    first = runs.agg(F.min("backend").alias("first"))  # one row: broadcast is bounded by construction
    base = runs.join(F.broadcast(first), F.col("backend") == F.col("first")).groupBy(F.col("workers").alias("w")).agg(F.max("images_per_second").alias("base"))
    return best.join(base, F.col("b.workers") == F.col("w"), "left").select(
        "backend", F.col("b.workers").alias("best_workers"), F.col("b.images_per_second").alias("best_rate"), (F.col("b.images_per_second") / F.col("base")).alias("speedup")
    )
