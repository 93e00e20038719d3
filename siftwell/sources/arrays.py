"""``.npy`` matrices as a Spark data source (row ranges as partitions), and seeded toy data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Range(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        super().__init__((start, end))
        self.start, self.end = start, end


class _NpyReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.rows = options["path"], int(options.get("rowsPerPartition", 100_000))

    def _matrix(self):
        import numpy as np

        return np.load(self.path, mmap_mode="r", allow_pickle=False)

    def partitions(self):
        n = self._matrix().shape[0]
        return [_Range(a, min(a + self.rows, n)) for a in range(0, n, self.rows)] or [_Range(0, 0)]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        part = np.asarray(self._matrix()[partition.start : partition.end], np.float32)
        n = len(part)
        width = part.shape[1] if part.ndim == 2 else 1
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(part.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(partition.start, partition.end)), lists], ["point_id", "embedding"])


class NpyMatrix(DataSource):
    """``spark.read.format("npy_matrix").load(path)``"""

    @classmethod
    def name(cls) -> str:
        return "npy_matrix"

    def schema(self) -> str:
        return "point_id bigint, embedding array<float>"

    def reader(self, schema):
        return _NpyReader(self.options)


def read_npy(spark: SparkSession, path: str, rows_per_partition: int = 100_000) -> DataFrame:
    """The rows of a matrix as points; pickled files are refused."""
    spark.dataSource.register(NpyMatrix)
    return spark.read.format("npy_matrix").option("rowsPerPartition", rows_per_partition).load(path)


def subset(points: DataFrame, ids: DataFrame) -> DataFrame:
    """Points whose id is listed in the only column of ``ids``."""
    listed = ids.select(F.col(ids.columns[0]).alias("listed")).distinct()
    return points.join(listed, F.col("point_id") == F.col("listed"), "left_semi")


def reindexed(points: DataFrame, ids: DataFrame) -> DataFrame:
    """The points listed in ``ids`` (new_id, point_id) under their new ids; a missing point is an error."""
    listed = ids.select(F.col("new_id"), F.col("point_id").alias("old"))
    out = listed.join(points, F.col("old") == F.col("point_id")).select(F.col("new_id").alias("point_id"), "embedding")
    if out.count() != ids.count():
        raise ValueError("some listed points are missing or repeated")
    return out


def rings(spark: SparkSession, sizes: list[int], seed: int = 0, spread: float = 0.05) -> DataFrame:
    """Points on rings of radius 1, 2, ...: (point_id, embedding, ring)."""
    bounds = [sum(sizes[: k + 1]) for k in range(len(sizes))]
    ring = F.coalesce(*[F.when(F.col("id") < b, k) for k, b in enumerate(bounds)])
    angle, radius = F.rand(seed) * (2 * math.pi), ring + 1 + F.randn(seed + 1) * spread
    rows = spark.range(sum(sizes)).withColumns({"ring": ring, "angle": angle}).withColumn("radius", radius)
    place = F.array((F.col("radius") * F.cos("angle")).cast("float"), (F.col("radius") * F.sin("angle")).cast("float"))
    return rows.select(F.col("id").alias("point_id"), place.alias("embedding"), "ring")


def mixture(spark: SparkSession, centres: list[tuple[float, ...]], sizes: list[int], spread: float = 1.0, seed: int = 0) -> DataFrame:
    """Points of a Gaussian mixture: (point_id, embedding, part)."""
    bounds = [sum(sizes[: k + 1]) for k in range(len(sizes))]
    part = F.coalesce(*[F.when(F.col("id") < b, k) for k, b in enumerate(bounds)])
    rows = spark.range(sum(sizes)).withColumn("part", part)
    middle = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    noise = [F.randn(seed + k) * spread for k in range(len(centres[0]))]
    place = F.array(*[(F.element_at(F.element_at(middle, F.col("part") + 1), k + 1) + noise[k]).cast("float") for k in range(len(noise))])
    return rows.select(F.col("id").alias("point_id"), place.alias("embedding"), "part")


def truncated_normal(spark: SparkSession, n: int, mean: float, spread: float, low: float, high: float, seed: int = 0) -> DataFrame:
    """Values of a normal distribution that fall into [low, high]: (point_id, value)."""
    rows = spark.range(n).select(F.col("id").alias("point_id"), (F.randn(seed) * spread + mean).alias("value"))
    return rows.where(F.col("value").between(low, high))


def synthetic_images(spark: SparkSession, count: int, size: int = 256, seed: int = 7) -> DataFrame:
    """Seeded stained-looking images as records (jpg, json, source_shard, source_index)."""

    def run(batches):
        import json

        import numpy as np
        import pyarrow as pa

        from siftwell.sources.codec import encode_png

        for batch in batches:
            out = []
            for i in batch.column("id").to_pylist():
                rng = np.random.default_rng([seed, i])
                rgb = np.full((size, size, 3), 240, np.uint8)
                y, x = np.mgrid[:size, :size]
                for _ in range(10):
                    cy, cx, ry, rx = rng.integers(0, size, 2).tolist() + rng.integers(size // 16 + 1, size // 4 + 2, 2).tolist()
                    round_ = rng.random() < 0.5
                    inside = ((y - cy) / ry) ** 2 + ((x - cx) / rx) ** 2 <= 1 if round_ else (abs(y - cy) <= ry) & (abs(x - cx) <= rx)
                    rgb[inside] = rng.integers(60, 200, 3)
                rgb = np.clip(rgb + rng.integers(-6, 7, rgb.shape), 0, 255).astype(np.uint8)
                told = {"gene": f"gene{i % 4}", "tissue": f"tissue{i % 3}", "md5": f"sample{i:06d}", "is_cancer": i % 2}
                out.append((encode_png(rgb), f"image{i}.png", json.dumps({"custom_metadata": told}), f"synthetic-{i % 4}.arrow", i // 4))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.binary(), pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bytes", "path", "json", "source_shard", "source_index"])

    rows = spark.range(count).mapInArrow(run, "bytes binary, path string, json string, source_shard string, source_index bigint")
    return rows.select(F.struct("bytes", "path").alias("jpg"), "json", "source_shard", "source_index")
