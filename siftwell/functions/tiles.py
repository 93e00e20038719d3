"""Tile geometry, colour arithmetic and the bins of a tile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_starts(length: Column, patch: int, stride: int) -> Column:
    """Starts of tiles along one side: every stride, and one that ends at the edge."""
    last = (length - patch).cast("int")
    return F.when(length <= patch, F.array(F.lit(0))).otherwise(
        F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(stride)), F.array(last)))
    )


def scaled_side(side: Column, factor: Column) -> Column:
    """A side under a magnification: rounded half to even, at least 1, unchanged near 1."""
    return F.when(F.abs(factor - 1.0) <= 1e-8 + 1e-5, side.cast("int")).otherwise(F.greatest(F.lit(1), F.bround(side * factor).cast("int")))


def gray(r: Column, g: Column, b: Column) -> Column:
    """Luma of an 8-bit colour, 0 to 1."""
    return (0.299 * r + 0.587 * g + 0.114 * b) / 255.0


def saturation(r: Column, g: Column, b: Column) -> Column:
    """Saturation of an 8-bit colour, 0 to 1."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    return F.when(high > 0, (high - low) / high).otherwise(0.0)


def normalize_channel(c: Column, low: Column, high: Column) -> Column:
    """A channel on the scale of its slide, clipped to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c - low) / F.greatest(high - low, F.lit(1e-3))))


def positive_mass() -> Column:
    """Share of strongly stained pixels."""
    return (F.col("d_hist_50_75") + F.col("d_hist_75_100")).cast("double")


def state_bin() -> Column:
    """Four times the strongest compartment plus the grade of the positive mass, 0 to 11."""
    places = F.array("dab_in_nuc_frac", "dab_ring_frac", "dab_extra_frac")
    mass = positive_mass()
    grade = F.when(mass < 0.05, 0).when(mass < 0.20, 1).when(mass < 0.45, 2).otherwise(3)
    return (4 * (F.array_position(places, F.array_max(places)) - 1) + grade).cast("int")


def interface_bin(posfrac: Column, change: Column) -> Column:
    """How much a tile differs from its neighbours, 0 to 3."""
    return (
        F.when((change < 0.25) & (posfrac < 0.08), 0).when((change < 0.50) & (posfrac < 0.15), 1).when((change < 0.75) & (posfrac < 0.30), 2).otherwise(3)
    )
