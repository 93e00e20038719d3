"""Per-group statistics as aggregates and windows; empty groups give the stated defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile(c: Column, p: float, default: float = 0.0) -> Column:
    """Exact quantile with linear interpolation."""
    return F.coalesce(F.percentile(c, F.lit(p)), F.lit(default))


def safe_mean(c: Column) -> Column:
    """Mean, 0 if empty."""
    return F.coalesce(F.avg(c), F.lit(0.0))


def safe_std(c: Column) -> Column:
    """Population standard deviation, 0 if empty."""
    return F.coalesce(F.stddev_pop(c), F.lit(0.0))


def histogram4(c: Column) -> list[Column]:
    """Shares of four equal bins of [0, 1], the right edge included; values outside count nowhere."""
    inside = (c >= 0) & (c <= 1)
    place = F.least(F.floor(c * 4), F.lit(3))
    total = F.count_if(inside)
    return [F.when(total > 0, F.count_if(inside & (place == k)) / total).otherwise(0.0).alias(f"bin{k}") for k in range(4)]


def zscore(c: Column, *by: str) -> Column:
    """Standard score within a group; zeros if the deviation is under 1e-6."""
    w = Window.partitionBy(*by)
    std = F.stddev_pop(c).over(w)
    return F.when(std < 1e-6, 0.0).otherwise((c - F.avg(c).over(w)) / std)


def robust_scale(df: DataFrame, columns: list[str], by: list[str], suffix: str = "") -> DataFrame:
    """Columns centred on their group's median and divided by 1.4826 times the median deviation.

    Where that is at most 1e-6 the standard deviation stands in, and 1 where that is too. The medians are
    aggregates joined back, so no group is gathered in one task.
    """
    first = df.groupBy(*by).agg(
        *[F.percentile(c, F.lit(0.5)).alias(f"med_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]
    )
    centred = _join_back(df, first, by)
    second = centred.groupBy(*by).agg(*[F.percentile(F.abs(F.col(c) - F.col(f"med_{c}")), F.lit(0.5)).alias(f"mad_{c}") for c in columns])
    full = _join_back(centred, second, by)
    for c in columns:
        scale = F.when(F.col(f"mad_{c}") > 1e-6, 1.4826 * F.col(f"mad_{c}")).otherwise(F.col(f"std_{c}"))
        scale = F.when(scale > 1e-6, scale).otherwise(1.0)
        full = full.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"med_{c}")) / scale)
    return full.drop(*[f"{p}_{c}" for p in ("med", "std", "mad") for c in columns])


def _join_back(df: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    totals = totals.select(*[F.col(c).alias(f"key_{c}") for c in by], *[c for c in totals.columns if c not in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"key_{c}"))
    return df.join(totals, same).drop(*[f"key_{c}" for c in by])
