"""Command line: local-select, global-select, pack-tars, export-images, export-embedded, sample, benchmark."""

from __future__ import annotations

import argparse
import json
from pathlib import PurePosixPath

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftwell import config
from siftwell.config import PatchOptions, SelectionOptions


def _session(name: str) -> SparkSession:
    return SparkSession.builder.appName(f"siftwell {name}").getOrCreate()


def local_select(spark: SparkSession, a) -> dict:
    """Images to candidates, some shards at a time; batches that are done with the same options are left as they are."""
    from siftwell.files import exists
    from siftwell.operators.tiling import select_and_report
    from siftwell.sources.arrow_shards import discover, read_shards
    from siftwell.streaming.incremental import check_signature

    options = PatchOptions(
        patch_size=a.patch_size, patch_stride=a.patch_stride or a.patch_size, magnification_factors=config.parse_factors(a.magnification_factors),
        use_rle_mask=not a.no_rle_mask, local_keep_ratio=a.keep_ratio, local_keep_min=a.keep_min, local_keep_max=a.keep_max,
    )
    files = discover(a.data_dir, a.split)
    check_signature(a.output_dir, {"options": str(options), "limit": a.limit_images, "files": files, "shards_per_batch": a.shards_per_batch})
    total = usable = 0
    for at in range(0, len(files), a.shards_per_batch):
        if a.limit_images and usable >= a.limit_images:
            break
        images = read_shards(spark, a.data_dir, a.split, files[at : at + a.shards_per_batch])
        good = images.where(F.octet_length("jpg.bytes") > 0)
        seen, fit = images.agg(F.count(F.lit(1)), F.count_if(F.octet_length("jpg.bytes") > 0)).first()
        if a.limit_images and usable + fit > a.limit_images:
            fit = a.limit_images - usable
            good = good.orderBy("source_shard", "source_index").limit(fit)
        total, usable = total + seen, usable + fit
        out, failed = (f"{a.output_dir}/{kind}/batch={at // a.shards_per_batch:06d}" for kind in ("candidates", "failures"))
        if not exists(spark, f"{out}/_SUCCESS"):
            chosen, broken = select_and_report(good, options)
            broken.write.mode("overwrite").parquet(failed)
            chosen.write.mode("overwrite").parquet(out)  # the last of a batch: it counts as done from here on
    told = {kind: spark.read.parquet(f"{a.output_dir}/{kind}").count() if total else 0 for kind in ("candidates", "failures")}
    return {"images": total, "usable": usable, "selected": told["candidates"], "failed": told["failures"]}


def global_select(spark: SparkSession, a) -> dict:
    """Candidates to a balanced manifest within the budget."""
    from siftwell.operators.export import write_manifest
    from siftwell.operators.selection import balanced_select, bin_counts

    rows = spark.read.parquet(a.candidate_dir)
    rows = rows.drop("batch")  # how a run was cut is no column of its candidates
    bins = tuple(c.strip() for c in a.bin_columns.split(",") if c.strip())
    if "is_cancer" in rows.columns:  # a nullable whole number may have been stored as a float
        rows = rows.withColumn("is_cancer", F.nanvl(F.col("is_cancer").cast("double"), F.lit(None)).cast("int"))
    options = SelectionOptions(a.target_size, bins, a.bin_alpha, a.utility_column, a.per_bin_min_quota)
    write_manifest(balanced_select(rows, options), a.output_dir, list(bins))
    files = sorted(PurePosixPath(f).name for f in rows.inputFiles())
    return {"candidate_files": files, "bin_count": bin_counts(rows, bins).count(), "selected_rows": spark.read.parquet(a.output_dir).count()}


def pack_tars(spark: SparkSession, a) -> dict:
    """A manifest's patches into archives or files."""
    from siftwell.operators.export import export_patches, export_summary
    from siftwell.sources.arrow_shards import read_shards

    stats = export_patches(
        spark.read.parquet(a.manifest_dir), read_shards(spark, a.data_dir), a.output_dir, a.mode, config.parse_image_format(a.image_format), a.compression, a.max_images_per_tar,
    )
    return export_summary(stats, f"{a.output_dir}/tar_export_summary.json")


def export_images(spark: SparkSession, a) -> dict:
    """Whole images as files."""
    from siftwell.operators.export import export_images as export
    from siftwell.sources.arrow_shards import read_shards

    return {"exported": export(read_shards(spark, a.data_dir, a.split), a.output_dir, a.limit)}


def export_embedded(spark: SparkSession, a) -> dict:
    """Image bytes of a Parquet table as files."""
    from siftwell.operators.export import export_embedded as export

    kind = config.parse_image_format(a.image_format)
    return {"exported": export(spark.read.parquet(a.table).select("task_id", "image_bytes"), a.output_dir, kind, a.limit)}


def sample(spark: SparkSession, a) -> dict:
    """Points sampled from a stored hierarchy."""
    from siftwell.operators.hierarchy import read_hierarchy
    from siftwell.operators.sampling import expand_copies, hierarchical_sample, sample_name

    edges = read_hierarchy(spark, a.hierarchy)
    levels = edges.agg(F.max("level")).first()[0]
    rows = expand_copies(hierarchical_sample(edges, levels, a.target_size, a.multiplier, a.strategy, a.seed))
    place = f"{a.output_dir}/{sample_name(levels, a.strategy, a.multiplier, a.target_size, a.suffix)}"
    (rows.orderBy("point_id") if a.sort else rows).write.parquet(place)
    return {"sampled": spark.read.parquet(place).count(), "path": place}


def benchmark(spark: SparkSession, a) -> dict:
    """Rates of image description over numbers of partitions."""
    from siftwell.benchmarks import time_runs
    from siftwell.sources.arrays import synthetic_images
    from siftwell.sources.arrow_shards import read_shards

    images = read_shards(spark, a.data_dir).limit(a.limit) if a.data_dir else synthetic_images(spark, max(a.limit, 4), a.size)
    return {"runs": time_runs(images, config.parse_counts(a.workers))}


def parser() -> argparse.ArgumentParser:
    """All commands and their options."""
    top = argparse.ArgumentParser(prog="siftwell")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, **options):
        p = commands.add_parser(name, help=run.__doc__)
        for key, value in options.items():
            flag = f"--{key}"
            if value is bool:
                p.add_argument(flag, action="store_true")
            elif isinstance(value, type):
                p.add_argument(flag, type=value, required=True)
            else:
                default, kind = value if isinstance(value, tuple) else (value, type(value))
                p.add_argument(flag, type=kind, default=default)
        p.set_defaults(run=run)

    none_int = (None, int)
    add("local-select", local_select, data_dir=str, output_dir=str, split="all", patch_size=256, patch_stride=none_int, magnification_factors="1.0,0.5,0.25",
        no_rle_mask=bool, keep_ratio=0.10, keep_min=1, keep_max=4, limit_images=none_int, shards_per_batch=256)
    add("global-select", global_select, candidate_dir=str, output_dir=str, target_size=int, bin_columns="tissue,is_cancer,state_bin,interface_bin", bin_alpha=0.5,
        utility_column="objective_score", per_bin_min_quota=0)
    add("pack-tars", pack_tars, manifest_dir=str, data_dir=str, output_dir=str, mode="tar", image_format="jpg", compression="none", max_images_per_tar=none_int)
    add("export-images", export_images, data_dir=str, output_dir=str, split="all", limit=none_int)
    add("export-embedded", export_embedded, table=str, output_dir=str, limit=none_int, image_format="jpg")
    add("sample", sample, hierarchy=str, output_dir=str, target_size=int, multiplier=1, strategy="r", seed=0, suffix="", sort=bool)
    add("benchmark", benchmark, data_dir=(None, str), limit=8, size=512, workers="1,2,4,8")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Run a command and print its summary as JSON."""
    a = parser().parse_args(argv)
    told = a.run(spark or _session(a.command), a)
    print(json.dumps(told, sort_keys=True))
    return told


if __name__ == "__main__":
    main()
