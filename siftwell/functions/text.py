"""Scalar text and metadata functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: metadata aliases in order of preference
ALIASES = {
    "gene": ("gene", "marker", "antibody"),
    "tissue": ("tissue", "organ", "tissue_name"),
    "cell_type": ("cell_type", "celltype", "cell", "cell line"),
    "diagnosis": ("snomed_text", "diagnosis", "description"),
    "snomed_code": ("snomed_code", "snomed"),
    "md5": ("md5", "image_md5"),
}
# fixed values: how metadata tell malignancy
MALIGNANCY_KEYS = ("is_cancer", "malignancy", "malignancy_status", "cancer")
MALIGNANT_WORDS = ("cancer", "malignant", "tumor", "yes", "true", "1")
BENIGN_WORDS = ("normal", "benign", "no", "false", "0")
MALIGNANT_TERMS = ("cancer", "carcinoma", "adenocarcinoma", "sarcoma", "lymphoma", "melanoma", "glioma", "tumor", "malignan")
MALIGNANCY_TEXTS = ("tissue", "diagnosis", "snomed_text", "title")


def slugify(c: Column, fallback: str) -> Column:
    """Lower case, ``&`` as and, other runs as one underscore, trimmed; ``fallback`` if nothing is left."""
    text = F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "&", " and ")
    text = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(fallback))


def json_object(c: Column) -> Column:
    """A JSON object as a map of texts; anything else is the empty map."""
    return F.coalesce(F.from_json(c, "map<string,string>", {"mode": "PERMISSIVE"}), F.expr("cast(map() as map<string,string>)"))


def custom_metadata(c: Column) -> Column:
    """The metadata of a record: its ``custom_metadata`` (an object or the text of one) or the record itself."""
    outer = json_object(c)
    return F.when(F.map_contains_key(outer, "custom_metadata"), json_object(outer["custom_metadata"])).otherwise(outer)


def without_large_fields(m: Column) -> Column:
    """Metadata without the mask."""
    return F.map_filter(m, lambda k, v: k != "rle_mask")


def first_filled(m: Column, keys: tuple[str, ...]) -> Column:
    """The first of the keys that holds text, else the empty text."""
    return F.coalesce(*[F.nullif(m[k], F.lit("")) for k in keys], F.lit(""))


def infer_malignancy(m: Column) -> Column:
    """1, 0 or null: the first key that says so, else 1 if a text names a malignant term."""
    said = []
    for key in MALIGNANCY_KEYS:
        word = F.lower(F.trim(m[key]))
        number = word.try_cast("double")
        said.append(
            F.when(word.isin(*MALIGNANT_WORDS), 1).when(word.isin(*BENIGN_WORDS), 0).when(number.isNotNull(), (number != 0).cast("int"))
        )
    text = F.lower(F.concat_ws(" ", *[F.coalesce(m[k], F.lit("")) for k in MALIGNANCY_TEXTS]))
    return F.coalesce(*said, F.when(text.rlike("|".join(MALIGNANT_TERMS)), 1)).cast("int")


def normalize_metadata(m: Column) -> Column:
    """Struct of gene, tissue, cell_type, diagnosis, snomed_code, md5 (never null) and is_cancer (nullable)."""
    return F.struct(*[first_filled(m, keys).alias(name) for name, keys in ALIASES.items()], infer_malignancy(m).alias("is_cancer"))


def sample_id(md5: Column, shard: Column, index: Column) -> Column:
    """The image's md5, or its shard's stem and its index."""
    stem = F.regexp_replace(F.regexp_extract(shard, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.coalesce(F.nullif(md5, F.lit("")), F.concat_ws(":", stem, index.cast("string")))


def rle_runs(c: Column) -> Column:
    """Runs (start from 0, length) of a mask text, or null if it isn't one."""
    tokens = F.split(F.trim(c), r"\s+")
    good = c.isNotNull() & (F.trim(c) != "") & (F.size(tokens) % 2 == 0) & F.forall(tokens, lambda t: t.rlike(r"^[+-]?\d{1,18}$"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest((F.size(tokens) / 2).cast("int") - 1, F.lit(0))),
        lambda i: F.struct((tokens[i * 2].try_cast("long") - 1).alias("start"), tokens[i * 2 + 1].try_cast("long").alias("len")),
    )
    return F.when(good, pairs)


def shard_token(shard: Column) -> Column:
    """A file-safe name of a shard: slug of its stem and ten digits of its path's md5."""
    stem = F.regexp_replace(F.regexp_extract(shard, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.concat_ws("_", slugify(stem, "arrow_shard"), F.substring(F.md5(shard), 1, 10))


def tar_name(shard: Column, compression: str = "none", chunk: Column | None = None) -> Column:
    """The name of a shard's archive, with its part if it is cut into chunks."""
    name = shard_token(shard)
    if chunk is not None:
        name = F.concat(name, F.lit("_part"), F.lpad(chunk.cast("string"), 6, "0"))
    return F.concat(name, F.lit(".tar.gz" if compression == "gz" else ".tar"))


def padded(c: Column, width: int) -> Column:
    """A whole number with leading zeros, never cut."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def member_name(image_format: str = "jpg", level: Column | None = None) -> Column:
    """The name of a patch inside an archive."""
    slug = slugify(F.coalesce(F.nullif(F.col("sample_slug"), F.lit("")), F.col("sample_id")), "sample")
    scale = F.when(level.isNotNull(), F.concat(F.lit("__m"), padded(level, 2))).otherwise("") if level is not None else F.lit("")
    return F.concat(
        slug, F.lit("__i"), padded(F.col("source_index"), 7), F.lit("__p"), padded(F.col("patch_index"), 4), scale,
        F.lit("__x"), padded(F.col("patch_x"), 5), F.lit("__y"), padded(F.col("patch_y"), 5), F.lit(f".{image_format.lower().lstrip('.')}"),
    )


def scale_token(level: Column, factor: Column) -> Column:
    """A short name of a magnification."""
    return F.concat(F.lit("m"), level.cast("string"), F.lit("_s"), padded(F.bround(factor * 100).cast("int"), 3))


def patch_filename(image_format: str = "jpg") -> Column:
    """The name of a loose patch image."""
    return F.concat(
        slugify(F.col("gene"), "unknown_marker"), F.lit("_"), slugify(F.col("tissue"), "unknown_tissue"), F.lit("_"),
        slugify(F.col("cell_type"), "unknown_celltype"), F.lit("_"), F.col("sample_slug"), F.lit("_"),
        scale_token(F.col("scale_level"), F.col("scale_factor")), F.lit("_p"), padded(F.col("patch_index"), 4),
        F.lit("_r"), padded(F.col("grid_row"), 2), F.lit("_c"), padded(F.col("grid_col"), 2),
        F.concat(F.lit("_x"), F.col("patch_x").cast("string"), F.lit("_y"), F.col("patch_y").cast("string"), F.lit(f".{image_format}")),
    )
