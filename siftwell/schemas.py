"""Column names and schemas of patch candidates."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: descriptor feature names, in order
BASE_FEATURES = [
    "tissue_frac", "odsum_mean", "gray_mean", "sat_mean", "h_mean", "h_std", "h_q10", "h_q50", "h_q90",
    "d_mean", "d_std", "d_q10", "d_q50", "d_q90", "residual_mean", "residual_q90",
    "h_hist_00_25", "h_hist_25_50", "h_hist_50_75", "h_hist_75_100",
    "d_hist_00_25", "d_hist_25_50", "d_hist_50_75", "d_hist_75_100", "d_pos_mean",
    "nuclei_frac", "nuclei_count_density", "nuclei_area_mean", "nuclei_area_cv",
    "dab_in_nuc_frac", "dab_ring_frac", "dab_extra_frac", "dab_cc_density", "dab_edge_to_area",
    "log_lap_var", "grad_mean", "grad_p90", "hole_frac", "unexpected_color_frac", "fold_frac",
    "border_tissue_frac", "compartment_margin",
]
NEIGHBOR_FEATURES = [
    "neigh_sem_l1_mean", "neigh_sem_l1_max", "neigh_d_mean_diff", "neigh_posfrac_diff", "neigh_nuc_frac_diff", "neigh_state_change_frac",
]
FEATURES = BASE_FEATURES + NEIGHBOR_FEATURES
SEMANTIC_FEATURES = [
    "h_mean", "h_q10", "h_q90", "d_mean", "d_q10", "d_q90", "d_hist_25_50", "d_hist_50_75", "d_hist_75_100",
    "d_pos_mean", "nuclei_frac", "dab_in_nuc_frac", "dab_ring_frac", "dab_extra_frac", "compartment_margin",
]
# fixed values: roles, scores, metadata and candidate columns, in order
ROLES = ("prototype", "positive_tail", "interface", "rare_state")
ROLE_SCORES = {"prototype": "prototype_score", "positive_tail": "positive_tail_score", "interface": "interface_role_score", "rare_state": "rare_state_score"}
SCORES = [
    "objective_score", "utility", "quality_score", "nuisance_score", "semantic_coverage_score", "interface_score",
    "redundancy_penalty", "rarity_score", "prototype_score", "positive_tail_score", "interface_role_score", "rare_state_score",
]
METADATA = ["gene", "tissue", "cell_type", "diagnosis", "snomed_code", "md5"]

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

#: A described tile before neighbours, scores and selection.
TILE = T.StructType(
    [T.StructField(n, _S) for n in ("sample_id", "sample_slug", "source_shard")]
    + [T.StructField("source_index", _L)]
    + [T.StructField(n, _I) for n in ("patch_index", "patch_size", "patch_x", "patch_y", "scale_level")]
    + [T.StructField("scale_factor", _D)]
    + [T.StructField(n, _I) for n in ("grid_row", "grid_col", "image_width", "image_height", "scaled_image_width", "scaled_image_height", "rle_available")]
    + [T.StructField(n, _D) for n in ("rle_patch_foreground_frac", "rle_slide_foreground_frac")]
    + [T.StructField(n, _S) for n in [*METADATA, "metadata_json"]]
    + [T.StructField("is_cancer", _I)]
    + [T.StructField("error", _S)]
    + [T.StructField(n, T.FloatType()) for n in BASE_FEATURES]
)

# fixed values: columns of a selected candidate, in order
CANDIDATE = (
    ["sample_id", "sample_slug", "source_shard", "source_index", "patch_index", "patch_size", "patch_x", "patch_y", "scale_level", "scale_factor",
     "grid_row", "grid_col", "image_width", "image_height", "scaled_image_width", "scaled_image_height", "local_valid_patch_count", "selection_rank",
     "selection_role", "descriptor_backend", "rle_available", "rle_patch_foreground_frac", "rle_slide_foreground_frac"]
    + SCORES + ["state_bin", "interface_bin"] + METADATA + ["is_cancer", "metadata_json"] + FEATURES
)
