"""Sinks: tar archives and loose files of selected patches, whole images, embedded bytes, manifests.

Tasks write into one folder that all executors share (a mounted store). A task writes a file under a
temporary name and renames it, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.files import write_text
from siftwell.functions.text import custom_metadata, member_name, normalize_metadata, shard_token, slugify
from siftwell.session import bound_batches

#: Rows of one part file of a manifest.
PART_ROWS = 100_000
MODES = ("tar", "files", "both")
STATS = "source_shard string, tar_name string, written long, missing long, empty long"


def write_manifest(rows: DataFrame, path: str, bins: list[str] | None = None) -> None:
    """Selected rows as Parquet: at most ``PART_ROWS`` a file, or with ``bins`` every bin whole in one file."""
    if bins:
        rows.repartition(*bins).write.parquet(path)
    else:
        rows.write.option("maxRecordsPerFile", PART_ROWS).parquet(path)


def write_json(path: str, value: dict) -> None:
    """A small document with sorted keys, in any store that Spark reads."""
    write_text(SparkSession.active(), path, json.dumps(value, indent=2, sort_keys=True))


def crops(manifest: DataFrame, images: DataFrame, image_format: str = "png", per_tar: int | None = None) -> DataFrame:
    """Selected rows with their image's bytes, archive, chunk and member name.

    Null shards are an error. Rows without an image keep null bytes and count as missing.
    """
    if manifest.where(F.col("source_shard").isNull()).limit(1).count():
        raise ValueError("a selected row has no source_shard")
    level = F.col("scale_level") if "scale_level" in manifest.columns else None
    have = set(manifest.columns)
    optional = [F.col(c) if c in have else F.lit(None).alias(c) for c in ("scale_factor", "scaled_image_width", "scaled_image_height")]
    rows = manifest.select(
        "source_shard", "source_index", "patch_index", "patch_x", "patch_y", F.coalesce("patch_size", F.lit(256)).alias("patch_size"),
        *optional, member_name(image_format, level).alias("member"),
    )
    order = Window.partitionBy("source_shard").orderBy("source_index", "patch_index", "patch_y", "patch_x")
    nth = F.row_number().over(order)
    rows = rows.withColumn("chunk", F.floor((nth - 1) / per_tar).cast("int") if per_tar else F.lit(0))
    pictures = images.select(F.col("source_shard").alias("i_shard"), F.col("source_index").alias("i_index"), F.col("jpg.bytes").alias("bytes"))
    return rows.join(pictures, (F.col("source_shard") == F.col("i_shard")) & (F.col("source_index") == F.col("i_index")), "left").drop("i_shard", "i_index")


def cut(rgb, row) -> "object":
    """The patch of a row, from its image at the row's scale; None if nothing of it lies in the image."""
    import pandas as pd

    from siftwell.operators.raster import resize

    w, h, factor = row.scaled_image_width, row.scaled_image_height, row.scale_factor
    if pd.isna(w) or pd.isna(h):
        side = lambda n: max(1, round(n * float(factor))) if not pd.isna(factor) else n
        w, h = side(rgb.shape[1]), side(rgb.shape[0])
    image = resize(rgb, int(w), int(h))
    size = int(row.patch_size)
    patch = image[max(int(row.patch_y), 0) : int(row.patch_y) + size, max(int(row.patch_x), 0) : int(row.patch_x) + size]
    return patch if patch.size else None


def export_patches(
    manifest: DataFrame, images: DataFrame, folder: str, mode: str = "tar", image_format: str = "png", compression: str = "none",
    per_tar: int | None = None, quality: int = 95,
) -> DataFrame:
    """Write the selected patches and return (source_shard, selected, written, missing, empty) a shard.

    Archives hold members in order of image and patch with fixed times and modes. One task writes one
    archive; ``per_tar`` cuts a large shard into several.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: choose one of {MODES}")
    suffix = ".tar.gz" if compression == "gz" else ".tar"
    rows = crops(manifest, images, image_format, per_tar)
    part = F.concat(F.lit("_part"), F.lpad(F.col("chunk").cast("string"), 6, "0")) if per_tar else F.lit("")
    rows = rows.withColumns({"token": shard_token(F.col("source_shard")), "tar_name": F.concat(shard_token(F.col("source_shard")), part, F.lit(suffix))})

    def run(frame):
        import io
        import tarfile

        import pandas as pd

        from siftwell.sources.codec import decode, encode

        frame = frame.sort_values(["source_index", "patch_index", "patch_y", "patch_x"], kind="stable")
        name, token, shard = frame["tar_name"].iloc[0], frame["token"].iloc[0], frame["source_shard"].iloc[0]
        os.makedirs(folder, exist_ok=True)
        temporary = os.path.join(folder, f".{name}.{os.getpid()}.tmp")
        archive = tarfile.open(temporary, "w:gz" if compression == "gz" else "w") if mode != "files" else None
        written = missing = empty = 0
        last, rgb = None, None
        for row in frame.itertuples(index=False):
            if row.bytes is None:
                missing += 1
                continue
            if row.source_index != last:
                last, rgb = row.source_index, decode(row.bytes)
            patch = cut(rgb, row)
            if patch is None:
                empty += 1
                continue
            data = encode(patch, image_format, quality)
            if archive is not None:
                entry = tarfile.TarInfo(row.member)
                entry.size, entry.mtime, entry.mode = len(data), 0, 0o644
                archive.addfile(entry, io.BytesIO(data))
            if mode != "tar":
                os.makedirs(os.path.join(folder, token), exist_ok=True)
                place = os.path.join(folder, token, row.member)
                Path(f"{place}.tmp").write_bytes(data)
                os.replace(f"{place}.tmp", place)
            written += 1
        if archive is not None:
            archive.close()
            if written:
                os.replace(temporary, os.path.join(folder, name))
            else:
                os.remove(temporary)
        return pd.DataFrame([(shard, name, written, missing, empty)], columns=["source_shard", "tar_name", "written", "missing", "empty"])

    from siftwell.tables import settle

    stats = settle(rows.groupBy("source_shard", "chunk").applyInPandas(run, STATS))
    return stats.groupBy("source_shard").agg(
        F.sum(F.col("written") + F.col("missing") + F.col("empty")).alias("selected"), F.sum("written").alias("written"), F.sum("missing").alias("missing"),
        F.sum("empty").alias("empty"), F.count_if(F.col("written") > 0).alias("archives"),
    )


def export_summary(stats: DataFrame, path: str) -> dict:
    """Totals of an export, also written as JSON; shards that wrote nothing are not counted."""
    row = stats.agg(
        F.count_if(F.col("written") > 0), F.coalesce(F.sum("selected"), F.lit(0)), F.coalesce(F.sum("written"), F.lit(0)), F.coalesce(F.sum("missing"), F.lit(0))
    ).first()
    told = dict(zip(("shards", "selected_rows", "written_members", "missing_images"), row, strict=True))
    write_json(path, told)
    return told


def output_names(images: DataFrame) -> DataFrame:
    """``images`` with ``name``: marker, tissue, cell type and index; repeated names get a number."""
    m = normalize_metadata(custom_metadata(F.col("json")))
    ending = F.lower(F.regexp_extract(F.coalesce("jpg.path", F.lit("")), r"(\.[A-Za-z0-9]+)$", 1))
    stem = F.concat_ws(
        "_", slugify(m["gene"], "unknown_marker"), slugify(m["tissue"], "unknown_tissue"), slugify(m["cell_type"], "unknown_celltype"), F.col("source_index").cast("string")
    )
    rows = images.withColumns({"stem": stem, "ending": F.coalesce(F.nullif(ending, F.lit("")), F.lit(".jpg"))})
    nth = F.row_number().over(Window.partitionBy("stem", "ending").orderBy("source_shard", "source_index"))
    return rows.withColumn("nth", nth).withColumn(
        "name", F.concat("stem", F.when(F.col("nth") > 1, F.concat(F.lit("_"), F.col("nth").cast("string"))).otherwise(""), "ending")
    ).drop("stem", "ending", "nth")


def write_files(rows: DataFrame, folder: str, image_format: str | None = None, quality: int = 95) -> int:
    """Rows (name, bytes) as files of a shared folder, in another image format if one is given; returns how many."""

    def run(batches):
        import pyarrow as pa

        from siftwell.sources.codec import decode, encode

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for row in batch.to_pylist():
                data = encode(decode(row["bytes"]), image_format, quality) if image_format else row["bytes"]
                place = os.path.join(folder, row["name"])
                Path(f"{place}.{os.getpid()}.tmp").write_bytes(data)
                os.replace(f"{place}.{os.getpid()}.tmp", place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    bound_batches(rows.sparkSession, 64, 64 << 20)
    return rows.select("name", "bytes").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def export_images(images: DataFrame, folder: str, limit: int | None = None) -> int:
    """Whole images as files; returns how many."""
    from siftwell.sources.arrow_shards import with_bytes

    rows = with_bytes(images)
    if limit is not None:
        rows = rows.orderBy("source_shard", "source_index").limit(limit)
    named = output_names(rows).select("name", F.col("jpg.bytes").alias("bytes"))
    return write_files(named, folder)


def embedded_names(table: DataFrame, ending: str = "jpg", limit: int | None = None) -> DataFrame:
    """(name, bytes) of rows (task_id, image_bytes) that hold bytes: the task and the row's place in the table from 1.

    The place counts rows without bytes, too. Rows are in order of task and bytes, so repeats get places of their own;
    ``limit`` counts what is written.
    """
    from siftwell.tables import settle

    rows = table.select("task_id", "image_bytes", F.md5("image_bytes").alias("print"))
    # places come from counts of tasks: no task orders the whole table
    counts = rows.groupBy("task_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy(F.col("task_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    counts = settle(counts.select(F.col("task_id").alias("t"), F.coalesce(before, F.lit(0)).alias("before")))
    nth = F.row_number().over(Window.partitionBy("task_id").orderBy("print"))
    placed = rows.withColumn("nth", nth).join(counts, F.col("task_id").eqNullSafe(F.col("t")))
    place = (F.col("before") + F.col("nth")).alias("place")
    full = placed.select("task_id", "image_bytes", place).where(F.octet_length("image_bytes") > 0)
    if limit is not None:
        full = full.orderBy("place").limit(limit)
    digits = F.col("place").cast("string")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    name = F.concat(F.coalesce(F.col("task_id").cast("string"), F.lit("patches")), F.lit("_patch_"), padded, F.lit(f".{ending}"))
    return full.select(name.alias("name"), F.col("image_bytes").alias("bytes"))


def export_embedded(table: DataFrame, folder: str, ending: str = "jpg", limit: int | None = None, quality: int = 95) -> int:
    """Bytes of (task_id, image_bytes) as image files of one format; returns how many."""
    return write_files(embedded_names(table, ending, limit), folder, ending, quality)
