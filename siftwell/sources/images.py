"""Folders of images and Parquet tables with embedded image bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: endings of image files
ENDINGS = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")


def list_images(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """(path, length) of the images of a folder and its subfolders, in order of path; bytes are not read."""
    glob = "*.{" + ",".join([*ENDINGS, *[e.upper() for e in ENDINGS]]) + "}"
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    rows = rows.select("path", "length").orderBy("path")
    return rows if limit is None else rows.limit(limit)


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Image records (jpg struct, json, source_shard, source_index) of a folder; the folder is the shard."""
    glob = "*.{" + ",".join([*ENDINGS, *[e.upper() for e in ENDINGS]]) + "}"
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    told = F.to_json(F.struct(F.regexp_replace(name, r"\.[^.]*$", "").alias("md5")))
    index = F.pmod(F.xxhash64("path"), F.lit(2**62))
    return rows.select(F.struct(F.col("content").alias("bytes"), name.alias("path")).alias("jpg"), told.alias("json"), F.lit(folder).alias("source_shard"), index.alias("source_index"))


def read_embedded(spark: SparkSession, path: str) -> DataFrame:
    """(task_id, image_bytes) of a Parquet table; only these two columns are read."""
    return spark.read.parquet(path).select("task_id", "image_bytes")


def sizes(images: DataFrame) -> DataFrame:
    """(path, height, width, error) of image records, for planning a tiling without keeping pixels."""

    def run(batches):
        import pyarrow as pa

        from siftwell.sources.codec import decode

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    h, w = decode(row["bytes"]).shape[:2]
                    out.append((row["path"], h, w, None))
                except Exception as e:  # one broken image must not end the job
                    out.append((row["path"], None, None, f"{type(e).__name__}: {e}"))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "height", "width", "error"])

    return images.select("jpg.bytes", "jpg.path").mapInArrow(run, "path string, height int, width int, error string")
