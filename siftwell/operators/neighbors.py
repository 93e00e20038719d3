"""Features of a tile against its four neighbours on the same scale of the same sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.tiles import interface_bin, positive_mass, state_bin
from siftwell.schemas import NEIGHBOR_FEATURES, SEMANTIC_FEATURES

KEY = ["sample_id", "scale_level", "grid_row", "grid_col"]


def neighbor_features(tiles: DataFrame) -> DataFrame:
    """``tiles`` with the six neighbour features, state_bin and interface_bin.

    A self equi-join on the four shifted grid places; missing neighbours are absent, and a tile without any
    gets zeros. One row a grid place is expected.
    """
    own = tiles.withColumn("state_bin", state_bin())
    facts = own.select(
        *KEY,
        F.array(*[F.col(c).cast("double") for c in SEMANTIC_FEATURES]).alias("semantic"),
        F.col("d_mean").cast("double").alias("d"),
        positive_mass().alias("mass"),
        F.col("nuclei_frac").cast("double").alias("nuclei"),
        "state_bin",
    )
    shifts = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    asks = facts.withColumn("shift", F.explode(shifts)).withColumns(
        {"at_row": F.col("grid_row") + F.col("shift.r"), "at_col": F.col("grid_col") + F.col("shift.c")}
    )
    others = facts.select(
        F.col("sample_id").alias("o_sample"), F.col("scale_level").alias("o_scale"), F.col("grid_row").alias("o_row"), F.col("grid_col").alias("o_col"),
        F.col("semantic").alias("o_semantic"), F.col("d").alias("o_d"), F.col("mass").alias("o_mass"), F.col("nuclei").alias("o_nuclei"),
        F.col("state_bin").alias("o_state"),
    )
    pairs = asks.join(
        others,
        F.col("sample_id").eqNullSafe(F.col("o_sample")) & F.col("scale_level").eqNullSafe(F.col("o_scale"))
        & (F.col("at_row") == F.col("o_row")) & (F.col("at_col") == F.col("o_col")),
    )
    gap = F.aggregate(F.zip_with("semantic", "o_semantic", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x)
    found = pairs.groupBy(*KEY).agg(
        F.avg(gap), F.max(gap), F.avg(F.abs(F.col("d") - F.col("o_d"))), F.avg(F.abs(F.col("mass") - F.col("o_mass"))),
        F.avg(F.abs(F.col("nuclei") - F.col("o_nuclei"))), F.avg((F.col("state_bin") != F.col("o_state")).cast("double")),
    ).toDF(*[f"n_{c}" for c in KEY], *NEIGHBOR_FEATURES)
    same = F.col("sample_id").eqNullSafe(F.col("n_sample_id"))
    for c in KEY[1:]:
        same = same & F.col(c).eqNullSafe(F.col(f"n_{c}"))
    full = own.join(found, same, "left").drop(*[f"n_{c}" for c in KEY])
    full = full.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)).cast("float") for c in NEIGHBOR_FEATURES})
    return full.withColumn(
        "interface_bin", interface_bin(F.col("neigh_posfrac_diff").cast("double"), F.col("neigh_state_change_frac").cast("double"))
    )
