"""Helpers that several operators share: checkpoints, seeded order keys, size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.session import bound_batches
from siftwell.tables import drop, settle

__all__ = ["BATCH_ROWS", "BROADCAST_ROWS", "WORD", "arrow_batches", "drop", "order_key", "settle", "small"]

#: Most rows of a table that may be broadcast; beyond it Spark picks the join itself.
BROADCAST_ROWS = 100_000
#: Rows and bytes of an Arrow batch handed to Python: they bound a worker's memory on very long texts.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20
#: White space that parts words, as a Java and Python character class.
WORD = r"[^\x20\x09-\x0D]+"


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast only if its counted rows stay below ``BROADCAST_ROWS``."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def order_key(seed: int, *cols: str) -> Column:
    """A seeded hexadecimal sort key; nulls count as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def arrow_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for very long texts."""
    bound_batches(spark, BATCH_ROWS, BATCH_BYTES)
