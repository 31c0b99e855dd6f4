"""Append-only bookkeeping tables: ledger, run params, run metrics, versions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dayledger.sources.filesystem import path_missing


def append_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or no rows while nothing has been appended."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], schema)


def metrics_long(rows: DataFrame, names: list[str], run_id: str = "run_id") -> DataFrame:
    """Metric columns as (run_id, key, value) rows; a null metric was not logged.

    NaN is refused: Spark orders it above every number, so it would win every
    promotion.
    """
    long = rows.unpivot(run_id, names, "key", "value").where(F.col("value").isNotNull())
    refused = F.raise_error(F.concat(F.lit("NaN metric: "), F.col("key"))).cast("double")
    return long.withColumn("value", F.when(F.isnan("value"), refused).otherwise(F.col("value")))
