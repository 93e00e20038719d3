"""Scores of tiles within their sample: rarity, quality, nuisance and the objective made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.config import PatchOptions
from siftwell.functions.stats import robust_scale, zscore
from siftwell.schemas import SEMANTIC_FEATURES


def nearest_mean(points: DataFrame, sample: str, point: str, vector: str, k: int = 3) -> DataFrame:
    """(sample, point, rarity): mean L1 distance to the ``k`` nearest others of the sample, 0 if alone.

    A self-join within a sample, whose size the tiling bounds; the ``k`` least distances are kept early.
    """
    a = points.select(F.col(sample).alias("s"), F.col(point).alias("p"), F.col(vector).alias("x"))
    b = points.select(F.col(sample).alias("s2"), F.col(point).alias("p2"), F.col(vector).alias("y"))
    gap = F.aggregate(F.zip_with("x", "y", lambda u, v: F.abs(u - v)), F.lit(0.0), lambda t, u: t + u)
    pairs = a.join(b, F.col("s").eqNullSafe(F.col("s2")) & (F.col("p") != F.col("p2"))).select("s", "p", gap.alias("gap"), "p2")
    near = pairs.withColumn("nth", F.row_number().over(Window.partitionBy("s", "p").orderBy("gap", "p2"))).where(F.col("nth") <= k)
    return near.groupBy("s", "p").agg(F.avg("gap").alias("rarity"))


def local_scores(tiles: DataFrame, options: PatchOptions = PatchOptions()) -> DataFrame:
    """``tiles`` (one row a sample_id, patch_index) with all scores."""
    scaled = robust_scale(
        tiles.select("sample_id", "patch_index", *[F.col(c).cast("double").alias(c) for c in SEMANTIC_FEATURES]),
        SEMANTIC_FEATURES, ["sample_id"],
    )
    by_sample = Window.partitionBy("sample_id")
    centre = sum((F.abs(F.col(c) - F.avg(c).over(by_sample)) for c in SEMANTIC_FEATURES), F.lit(0.0))
    points = scaled.select(
        F.col("sample_id").alias("ps"), F.col("patch_index").alias("pp"), (-centre).alias("raw_centrality"), F.array(*SEMANTIC_FEATURES).alias("semantic")
    )
    rarity = nearest_mean(points, "ps", "pp", "semantic")
    full = tiles.join(points, F.col("sample_id").eqNullSafe(F.col("ps")) & (F.col("patch_index") == F.col("pp")))
    full = full.join(rarity, F.col("sample_id").eqNullSafe(F.col("s")) & (F.col("patch_index") == F.col("p")), "left")
    d = lambda c: F.col(c).cast("double")
    tail = d("d_hist_50_75") + 2.0 * d("d_hist_75_100") + 0.5 * d("d_pos_mean")
    full = full.withColumns(
        {
            "raw_rarity": F.coalesce("rarity", F.lit(0.0)),
            "raw_tail": tail,
            "raw_quality": d("log_lap_var") + 0.5 * d("grad_p90"),
            "raw_interface": d("neigh_sem_l1_mean") + 0.5 * d("neigh_posfrac_diff") + 0.5 * d("neigh_state_change_frac"),
            "raw_nuisance": d("unexpected_color_frac") + d("fold_frac") + 0.5 * d("hole_frac") + 0.25 * d("border_tissue_frac"),
            "raw_coverage": F.coalesce("rarity", F.lit(0.0)) + 0.5 * tail + 0.25 * d("compartment_margin"),
        }
    )
    z = lambda c: zscore(F.col(c), "sample_id")
    full = full.withColumns(
        {
            "rarity_score": z("raw_rarity"), "quality_score": z("raw_quality"), "interface_score": z("raw_interface"), "nuisance_score": z("raw_nuisance"),
            "semantic_coverage_score": z("raw_coverage"), "z_centrality": z("raw_centrality"), "z_tail": z("raw_tail"),
        }
    ).withColumn("redundancy_penalty", F.when(F.col("rarity_score") == 0, 0.0).otherwise(-F.col("rarity_score")))
    q, n, i, s = (F.col(c) for c in ("quality_score", "nuisance_score", "interface_score", "semantic_coverage_score"))
    o = options
    full = full.withColumns(
        {
            "prototype_score": F.col("z_centrality") + 0.5 * q - 0.5 * n,
            "positive_tail_score": F.col("z_tail") + 0.25 * q - 0.5 * n,
            "rare_state_score": s + 0.25 * i - 0.25 * n,
            "interface_role_score": i + 0.25 * q - 0.5 * n,
            "objective_score": o.semantic_weight * s + o.interface_weight * i + o.quality_weight * q
            - o.redundancy_weight * F.col("redundancy_penalty") - o.nuisance_weight * n,
        }
    ).withColumn("utility", F.col("objective_score"))
    helpers = ["ps", "pp", "s", "p", "rarity", "semantic", "z_centrality", "z_tail"]
    return full.drop(*helpers, *[c for c in full.columns if c.startswith("raw_")])
