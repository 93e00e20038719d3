"""A small, varied subset of each sample's tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.config import PatchOptions
from siftwell.schemas import ROLE_SCORES
from siftwell.tables import settle


def keep_count(n: Column, options: PatchOptions = PatchOptions()) -> Column:
    """How many of ``n`` tiles a sample keeps."""
    share = F.ceil(F.lit(options.local_keep_ratio) * n)
    return F.least(n, F.least(F.lit(options.local_keep_max), F.greatest(F.lit(options.local_keep_min), share))).cast("long")


def _roles(options: PatchOptions):
    """Picks of one sample: a tile for each role in turn, then whatever adds most to what is covered."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        n, keep = len(group), int(group["keep"].iloc[0])
        group = group.sort_values("patch_index", kind="stable").reset_index(drop=True)
        objective = group["objective_score"].to_numpy(float)
        state, edge = group["state_bin"].to_numpy(), group["interface_bin"].to_numpy()
        free, role = np.ones(n, bool), np.full(n, None, object)

        def take(k: int, name: str) -> None:
            free[k], role[k] = False, name

        for name, column in ROLE_SCORES.items():
            if (~free).sum() < keep:
                # the best score, then the best objective, then the first tile
                order = np.lexsort((np.arange(n), -objective, -group[column].to_numpy(float), ~free))
                take(order[0], name)
        while (~free).sum() < keep:
            new = lambda values: ~np.isin(values, values[~free])  # noqa: B023, E731
            gain = objective + options.state_gain_bonus * new(state) + options.interface_gain_bonus * new(edge)
            take(int(np.where(free, gain, -np.inf).argmax()), "coverage_fill")
        out = group.loc[~free, ["sample_id", "patch_index"]].copy()
        out["selection_role"] = role[~free]
        return out

    return run


def select_coreset(tiles: DataFrame, options: PatchOptions = PatchOptions()) -> DataFrame:
    """The kept tiles with local_valid_patch_count, selection_rank and selection_role.

    Samples that keep all their tiles never leave the JVM; the greedy picks of the others are sequential and
    run per sample, whose size the tiling bounds, on a few narrow columns.
    """
    by_sample = Window.partitionBy("sample_id")
    counted = tiles.withColumn("local_valid_patch_count", F.count(F.lit(1)).over(by_sample).cast("int"))
    # three branches read it: neighbours and scores are worked out once
    counted = settle(counted.withColumn("keep", keep_count(F.col("local_valid_patch_count"), options)))
    whole = counted.where(F.col("keep") >= F.col("local_valid_patch_count")).withColumn("selection_role", F.lit("all_retained"))
    part = counted.where(F.col("keep") < F.col("local_valid_patch_count"))
    narrow = part.select("sample_id", "patch_index", "keep", "objective_score", "state_bin", "interface_bin", *ROLE_SCORES.values())
    kinds = {f.name: f.dataType for f in narrow.schema}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in ("sample_id", "patch_index")] + [T.StructField("selection_role", T.StringType())])
    picks = narrow.groupBy("sample_id").applyInPandas(_roles(options), schema)
    picks = picks.select(F.col("sample_id").alias("ks"), F.col("patch_index").alias("kp"), "selection_role")
    chosen = part.join(picks, F.col("sample_id").eqNullSafe(F.col("ks")) & (F.col("patch_index") == F.col("kp"))).drop("ks", "kp")
    both = whole.unionByName(chosen).drop("keep")
    rank = F.row_number().over(by_sample.orderBy(F.col("objective_score").desc(), "patch_index")).cast("int")
    return both.withColumn("selection_rank", rank)
