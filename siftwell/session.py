"""Session helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "siftwell", **conf: object) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder, opened by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int, size: int) -> None:
    """Let Arrow batches hold at most so many rows and bytes; a lower bound that is already set stays."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name, None)
        if not now or not now.isdigit() or int(now) == 0 or int(now) > most:
            spark.conf.set(name, str(most))
