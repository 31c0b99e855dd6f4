"""Day-partitioned parquet with per-day overwrite."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.schema import DAY
from dayledger.sources.filesystem import delete

AS_READ = "as_read"
REBALANCE = "rebalance"


def write_days(
    rows: DataFrame,
    root: str,
    spread: str | int = REBALANCE,
    partition_by: tuple[str, ...] = (DAY,),
    salt_by: str = "tranaction_id",
) -> None:
    """Replace the days present in `rows`; other days stay as they are.

    `spread` sets how rows reach the writers:

    * `"as_read"`: no shuffle. Right for rows read from one file per day, where an
      input split holds one day and a day has about one output file per split.
    * `"rebalance"`: a shuffle by day whose partitions Spark splits or merges to an
      even size, so a day with a third of all rows still gets many writers.
    * a number: at most that many files per day, each a hash share of the day.
    """
    if spread == REBALANCE and not adaptive(rows.sparkSession):
        # Without adaptive execution a rebalance keeps a hot day in one task.
        spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spread == REBALANCE:
        rows = rows.hint("rebalance", *partition_by)
    elif spread != AS_READ:
        salt = F.pmod(F.xxhash64(salt_by), F.lit(int(spread)))
        rows = rows.repartition(*partition_by, salt)
    (
        rows.write.partitionBy(*partition_by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def drop_days(spark: SparkSession, root: str, days: Iterable[dt.date]) -> None:
    """Remove the partitions of days that no longer have rows.

    Dynamic overwrite replaces only days it writes rows for, so the old rows of a day
    that is empty now would stay.
    """
    for day in days:
        delete(spark, f"{root.rstrip('/')}/{DAY}={day:%Y-%m-%d}")
