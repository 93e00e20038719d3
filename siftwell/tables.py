"""Settled tables: results written to the folder that all executors share, and read again.

The folder is ``spark.checkpoint.dir``. Each application writes into a folder of its own below it, so what a
killed driver leaves behind can be told by its application id. A table goes when the ``settled`` call that it
served ends, when a later one takes its place (``instead_of``), or with the driver.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Paths that each running ``settled`` call has written so far.
_running: list[list[str]] = []
_left: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The application's folder below ``spark.checkpoint.dir``; only a session on one machine may leave that unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "/tmp/checkpoints"
    return f"{folder}/{context.applicationId}"


def settle(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it again; ``instead_of``, a settled table, is dropped then."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    _left[path] = spark
    if _running:
        _running[-1].append(path)
    if instead_of is not None:
        drop(instead_of)
    return out


def drop(table: DataFrame) -> None:
    """Remove a settled table that nothing will read again."""
    _remove(table.settled_path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The settled result of ``make``; the tables that it settled on its way are dropped."""
    _running.append([])
    kept = None
    try:
        out = settle(make())
        kept = out.settled_path
    finally:
        for path in _running.pop():
            if path != kept:
                _remove(path)
    if _running:
        _running[-1].append(kept)
    return out


def _remove(path: str) -> None:
    """Drop a settled table if the driver's JVM still answers."""
    spark = _left.pop(path, None)
    if spark is not None:
        with contextlib.suppress(Exception):
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _remove_all() -> None:
    for path in list(_left):
        _remove(path)
