"""From images to a coreset of described tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import PatchOptions
from siftwell.functions.text import custom_metadata, normalize_metadata, sample_id, slugify, without_large_fields
from siftwell.functions.tiles import scaled_side, tile_starts
from siftwell.operators.coreset import select_coreset
from siftwell.operators.neighbors import neighbor_features
from siftwell.operators.scores import local_scores
from siftwell.schemas import CANDIDATE, METADATA, TILE
from siftwell.session import bound_batches
from siftwell.sources.arrow_shards import with_bytes


def tile_grid(images: DataFrame, options: PatchOptions = PatchOptions()) -> DataFrame:
    """All tiles of images (sample_id, image_width, image_height), without pixels."""
    o = options
    scales = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(f).alias("factor")) for k, f in enumerate(o.magnification_factors)])
    rows = images.withColumn("scale", F.explode(scales)).withColumns(
        {
            "scale_level": F.col("scale.level"), "scale_factor": F.col("scale.factor"),
            "scaled_image_width": scaled_side(F.col("image_width"), F.col("scale.factor")),
            "scaled_image_height": scaled_side(F.col("image_height"), F.col("scale.factor")),
        }
    )
    rows = rows.select("*", F.posexplode(tile_starts(F.col("scaled_image_height"), o.patch_size, o.patch_stride)).alias("grid_row", "patch_y"))
    rows = rows.select("*", F.posexplode(tile_starts(F.col("scaled_image_width"), o.patch_size, o.patch_stride)).alias("grid_col", "patch_x"))
    return rows.drop("scale").withColumn("patch_size", F.lit(o.patch_size))


def prepare(images: DataFrame) -> DataFrame:
    """Image records with sample id, slug and normalized metadata; records without bytes go."""
    told = with_bytes(images).withColumn("m", custom_metadata(F.col("json")))
    rows = told.withColumn("n", normalize_metadata(F.col("m")))
    own = sample_id(F.col("n.md5"), F.col("source_shard"), F.col("source_index"))
    small = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(without_large_fields(F.col("m"))))))
    return rows.select(
        F.col("jpg.bytes").alias("bytes"), "source_shard", "source_index", own.alias("sample_id"), slugify(own, "sample").alias("sample_slug"),
        F.col("m")["rle_mask"].alias("rle_mask"), F.coalesce(small, F.lit("{}")).alias("metadata_json"), *[F.col(f"n.{c}") for c in METADATA], F.col("n.is_cancer"),
    )


def _starts(length: int, patch: int, stride: int) -> list[int]:
    if length <= patch:
        return [0]
    return sorted({*range(0, length - patch + 1, stride), length - patch})


def tiles_of(rgb, rle_text, o: PatchOptions, describe=None, stats=None) -> list[dict]:
    """Described tiles of one image: geometry, mask shares and features; tiles with too little tissue are absent."""
    import numpy as np

    from siftwell.operators import raster

    describe, stats = describe or raster.describe, stats or raster.slide_stats
    h, w = rgb.shape[:2]
    mask = raster.decode_rle(rle_text, h, w) if o.use_rle_mask else None
    out, index = [], 0
    for level, factor in enumerate(o.magnification_factors):
        near_one = np.isclose(factor, 1.0)
        sw, sh = (w, h) if near_one else (max(1, round(w * factor)), max(1, round(h * factor)))
        image = rgb if (sw, sh) == (w, h) else raster.resize(rgb, sw, sh)
        part = None if mask is None else mask if (sw, sh) == (w, h) else raster.resize_mask(mask, sw, sh)
        known = stats(image, o, part)
        for row, top in enumerate(_starts(sh, o.patch_size, o.patch_stride)):
            for col, left in enumerate(_starts(sw, o.patch_size, o.patch_stride)):
                at = np.s_[top : top + o.patch_size, left : left + o.patch_size]
                share = None if part is None else float(part[at].mean())
                if share is not None and share < o.rle_min_fraction:
                    continue
                features = describe(image[at], known, o, None if part is None else part[at])
                if features is not None:
                    out.append(
                        {
                            "patch_index": index, "patch_size": o.patch_size, "patch_x": left, "patch_y": top, "scale_level": level, "scale_factor": float(factor),
                            "grid_row": row, "grid_col": col, "image_width": w, "image_height": h, "scaled_image_width": sw, "scaled_image_height": sh,
                            "rle_available": int(mask is not None), "rle_patch_foreground_frac": share,
                            "rle_slide_foreground_frac": None if mask is None else float(mask.mean()), "features": features,
                        }
                    )
                index += 1
    return out


def describe_images(images: DataFrame, options: PatchOptions = PatchOptions()) -> DataFrame:
    """One row a described tile. An image that cannot be read gives one row with ``error`` and no features.

    Decoding, tiling and description of an image are one narrow step; image bytes are never shuffled.
    """
    about = ["sample_id", "sample_slug", "source_shard", "source_index", *METADATA, "metadata_json", "is_cancer"]
    names = [f.name for f in TILE.fields]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        from siftwell.schemas import BASE_FEATURES
        from siftwell.sources.codec import decode

        schema = to_arrow_schema(TILE)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                told = {k: row[k] for k in about}
                try:
                    for tile in tiles_of(decode(row["bytes"]), row["rle_mask"], options):
                        features = tile.pop("features").tolist()
                        out.append(dict.fromkeys(names) | told | tile | dict(zip(BASE_FEATURES, features, strict=True)))
                except Exception as e:  # one broken image must not end the job
                    out.append(dict.fromkeys(names) | told | {"error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    # a few images at a time: an image may be large
    bound_batches(images.sparkSession, 64, 64 << 20)
    return prepare(images).mapInArrow(run, TILE)


def local_select(images: DataFrame, options: PatchOptions = PatchOptions()) -> DataFrame:
    """Candidates of all images: tiles described, compared with neighbours, scored and thinned per sample."""
    return select_and_report(images, options)[0]


def select_and_report(images: DataFrame, options: PatchOptions = PatchOptions()) -> tuple[DataFrame, DataFrame]:
    """The candidates of all images, and (source_shard, source_index, sample_id, error) of those that cannot be read."""
    from siftwell.tables import settle

    tiles = settle(describe_images(images, options))
    good = tiles.where(F.col("error").isNull()).drop("error")
    chosen = select_coreset(local_scores(neighbor_features(good), options), options)
    failed = tiles.where(F.col("error").isNotNull()).select("source_shard", "source_index", "sample_id", "error")
    return chosen.withColumn("descriptor_backend", F.lit("spark")).select(*CANDIDATE), failed
