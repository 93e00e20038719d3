"""Arrow IPC shards of images as a Spark data source, one partition a shard.

Listing and reading go through Arrow's file systems, so a shard may lie in any store they know.
"""

from __future__ import annotations

import json
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# fixed values: which name parts a split admits
SPLITS = {"train": ("train",), "valid": ("valid", "validation"), "test": ("test",), "eval": ("valid", "validation", "test")}


def prune_split(names: list[str], split: str = "all") -> list[str]:
    """Names whose file name holds a keyword of the split."""
    if split == "all":
        return names
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}: choose all, {', '.join(SPLITS)}")
    kept = [n for n in names if any(k in PurePosixPath(n).name.lower() for k in SPLITS[split])]
    if not kept:
        raise FileNotFoundError(f"no shard of split {split!r}")
    return kept


def _store(path: str):
    """The Arrow file system of an address, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def discover(path: str, split: str = "all") -> list[str]:
    """Sorted ``.arrow`` files of a folder (its own, else any below), or the file itself."""
    from pyarrow import fs

    system, root = _store(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        if not root.endswith(".arrow"):
            raise ValueError(f"{path} is not an .arrow file")
        return prune_split([root], split)
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    found = []
    for deep in (False, True):
        listed = system.get_file_info(fs.FileSelector(root, recursive=deep))
        found = sorted(f.path for f in listed if f.type == fs.FileType.File and f.path.endswith(".arrow"))
        if found:
            return prune_split(found, split)
    hint = " (only Parquet files are there)" if any(f.path.endswith(".parquet") for f in listed) else ""
    raise FileNotFoundError(f"no .arrow files under {path}{hint}")


class _Shard(InputPartition):
    def __init__(self, path: str, store: str) -> None:
        super().__init__(path)
        self.path, self.store = path, store


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.store = options["path"]
        listed = options.get("files")
        self.shards = json.loads(listed) if listed else discover(self.store, options.get("split", "all"))

    def partitions(self):
        return [_Shard(s, self.store) for s in self.shards]

    def read(self, partition):
        import pyarrow as pa

        # the shard lies in the store that the folder's address names
        with _store(partition.store)[0].open_input_file(partition.path) as source:
            try:
                reader = pa.ipc.open_stream(source)
                batches = iter(reader)
            except pa.ArrowInvalid:
                source.seek(0)
                whole = pa.ipc.open_file(source)
                batches = (whole.get_batch(i) for i in range(whole.num_record_batches))
            at = 0
            for batch in batches:
                n = batch.num_rows
                picture = batch.column("jpg")
                raw = picture.field("bytes").cast(pa.binary())
                name = picture.field("path").cast(pa.string()) if "path" in [f.name for f in picture.type] else pa.nulls(n, pa.string())
                told = batch.column("json") if "json" in batch.schema.names else pa.nulls(n, pa.string())
                if not pa.types.is_string(told.type):
                    told = pa.array([None if v is None else json.dumps(v) for v in told.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [raw, name, told, pa.array([partition.path] * n, pa.string()), pa.array(range(at, at + n), pa.int64())],
                    ["bytes", "path", "json", "source_shard", "source_index"],
                )
                at += n


class ArrowShards(DataSource):
    """``spark.read.format("arrow_shards").option("split", ...).load(path)``"""

    @classmethod
    def name(cls) -> str:
        return "arrow_shards"

    def schema(self) -> str:
        return "bytes binary, path string, json string, source_shard string, source_index bigint"

    def reader(self, schema):
        return _Reader(self.options)


def read_shards(spark: SparkSession, path: str, split: str = "all", files: list[str] | None = None) -> DataFrame:
    """Image records (jpg struct, json) with their shard and index; ``files`` are some that ``discover`` has found."""
    spark.dataSource.register(ArrowShards)
    reader = spark.read.format("arrow_shards").option("split", split)
    rows = (reader.option("files", json.dumps(files)) if files is not None else reader).load(path)
    return rows.select(F.struct("bytes", "path").alias("jpg"), "json", "source_shard", "source_index")


def with_bytes(images: DataFrame) -> DataFrame:
    """Records that hold image bytes."""
    return images.where(F.col("jpg.bytes").isNotNull() & (F.octet_length("jpg.bytes") > 0))


def resolve_shards(manifest: DataFrame, shards: DataFrame) -> DataFrame:
    """``manifest`` with the present path of each shard: its own, else one of the same base name in any case.

    ``shards`` has one column, path. Rows whose shard is gone keep a null path.
    """
    base = lambda c: F.lower(F.regexp_extract(c, r"([^/]+)$", 1))
    known = shards.groupBy(base(F.col("path")).alias("base")).agg(F.min("path").alias("found"))
    here = shards.select(F.col("path").alias("same")).distinct()
    rows = manifest.join(here, F.col("source_shard") == F.col("same"), "left").join(known, base(F.col("source_shard")) == F.col("base"), "left")
    return rows.withColumn("shard_path", F.coalesce("same", "found")).drop("same", "found", "base")
