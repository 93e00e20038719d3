"""Incremental selection runs: new input files are processed once, under a signature that must not change."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftwell.files import exists, read_text, write_text


class SignatureMismatch(RuntimeError):
    """The stored run was made with other options."""


def check_signature(folder: str, signature: dict) -> bool:
    """Record the signature of a run, or compare with the one recorded; True if the run was already there."""
    spark, place = SparkSession.active(), f"{folder}/_signature.json"
    told = json.dumps(signature, sort_keys=True)
    if exists(spark, place):
        if read_text(spark, place) != told:
            raise SignatureMismatch(f"the run in {folder} does not match the present options")
        return True
    write_text(spark, place, told)
    return False


def run_incrementally(
    spark: SparkSession, source: str, schema, output: str, transform: Callable[[DataFrame], DataFrame], signature: dict, files_per_batch: int = 1000
) -> dict:
    """Apply ``transform`` to the Parquet files of ``source`` not seen yet; returns how much has been done.

    Each batch overwrites its own folder, so a batch that is repeated after a crash leaves the same rows.
    The options in ``signature`` guard the checkpoint; what only changes speed stays out of it.
    """
    check_signature(output, signature)
    done = {"batches": 0}

    def each(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{output}/batch={number:06d}")
        done["batches"] += 1

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.option("checkpointLocation", f"{output}/_checkpoint").trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return done


def results(spark: SparkSession, output: str) -> DataFrame:
    """Everything written so far."""
    return spark.read.parquet(f"{output}/batch=*")
