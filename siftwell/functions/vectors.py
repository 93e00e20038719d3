"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def squared_norm(a: Column) -> Column:
    """Squared length."""
    return dot(a, a)


def l2_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)


def cos_distance(a: Column, b: Column) -> Column:
    """2 - 2xy: the squared distance of unit vectors."""
    return 2 - 2 * dot(a, b)


def power_distance(x: Column, centre: Column, n: int) -> Column:
    """(x - centre) to the power 2n."""
    return F.pow(x - centre, F.lit(2 * n))


def power_slope(x: Column, centre: Column, n: int) -> Column:
    """First derivative of ``power_distance`` in x."""
    return 2 * n * F.pow(x - centre, F.lit(2 * n - 1))


def power_curve(x: Column, centre: Column, n: int) -> Column:
    """Second derivative of ``power_distance`` in x."""
    return 2 * n * (2 * n - 1) * F.pow(x - centre, F.lit(2 * n - 2))
