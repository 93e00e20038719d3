"""Small texts in whatever store Hadoop knows, written whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    place, system = _place(spark, path)
    return system.exists(place)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    place, system = _place(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under another name, then rename."""
    place, system = _place(spark, path)
    part, _ = _place(spark, f"{path}.{uuid.uuid4().hex}.part")
    system.mkdirs(place.getParent())
    sink = system.create(part, True)
    sink.write(bytearray(text.encode()))
    sink.close()
    if system.exists(place):
        system.delete(place, False)
    system.rename(part, place)
