"""Plain file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Comma files with a header line each."""
    writer = rows.write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
