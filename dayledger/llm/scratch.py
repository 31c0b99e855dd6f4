"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayledger.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Give Python workers at most `rows` texts at a time, as several of them share an executor's memory."""
    spark.conf.set(_BATCH, str(min(rows, int(spark.conf.get(_BATCH, str(rows))))))


class Scratch:
    """Writes a table below the checkpoint folder and reads it back, which cuts its lineage.

    The shuffle files of the write are dropped as soon as it is done: everything later reads
    the written table, which outlives any executor.
    """

    def __init__(self, frame: DataFrame):
        self.spark = frame.sparkSession

    def __call__(self, rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            rows.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(rows.schema).parquet(path)
