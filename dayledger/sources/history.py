"""The cleaned history and the training set cut from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.functions import day_of_file, is_day_name
from dayledger.schema import DAY, LABEL
from dayledger.sources.filesystem import glob


def scan_history(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Every parquet file below the root, whatever the folders; the day is in the path.

    Columns come from the file footers, so extra numeric columns become features.
    Prefer `read_history` for a `src_date=` table: filters on its day prune folders.
    """
    roots = [root] if isinstance(root, str) else root
    rows = spark.read.option("recursiveFileLookup", True).parquet(*roots)
    day = day_of_file(F.col("_metadata.file_path"), F.col("_metadata.file_name"))
    return rows.withColumn(DAY, day)


def read_history(spark: SparkSession, root: str, days: list[dt.date] | None = None) -> DataFrame:
    """The `src_date=` table. With `days` no other folder is even listed."""
    base = root.rstrip("/")
    paths = [base] if days is None else [f"{base}/{DAY}={d:%Y-%m-%d}" for d in days]
    return spark.read.option("basePath", base).parquet(*paths)


def folder_days(spark: SparkSession, root: str) -> DataFrame:
    """Names of the plain day folders directly below the root, empty ones included."""
    names = [(path.rsplit("/", 1)[-1],) for path, _ in glob(spark, f"{root.rstrip('/')}/*")]
    return spark.createDataFrame(names, "name STRING").where(is_day_name(F.col("name")))


def partition_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days of the `src_date=` folders directly below the root, ascending; one folder per day is listed."""
    names = [path.rsplit("=", 1)[-1] for path, _ in glob(spark, f"{root.rstrip('/')}/{DAY}=*-*-*")]
    return sorted(dt.date.fromisoformat(name) for name in names)


def latest_days(days: DataFrame, last_n: int, day: str = DAY) -> DataFrame:
    """The last `last_n` distinct days, ascending."""
    return days.select(day).distinct().orderBy(F.desc(day)).limit(last_n).orderBy(day)


def training_set(
    spark: SparkSession,
    root: str,
    last_n: int | None = None,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Labelled rows of the latest `last_n` days, or of the whole history.

    With a ledger the root is a `src_date=` table; days whose clean count is zero count
    among the N but have no folder. Without one the folders are the days that count: those of
    a `src_date=` table, as a stream writes it, or else plain day folders.
    """
    if last_n is not None and last_n < 0:
        raise ValueError("last_n must not be negative")
    written = partition_days(spark, root) if ledger is None else []
    if not last_n:
        whole = read_history if ledger is not None or written else scan_history
        return labelled(whole(spark, root))
    if written:
        return labelled(read_history(spark, root, written[-last_n:]))
    # At most last_n dates reach the driver: they become literal folder paths.
    if ledger is None:
        base = root.rstrip("/")
        names = latest_days(folder_days(spark, base), last_n, "name").collect()
        found = [f"{base}/{r['name']}" for r in names]
    else:
        newest = latest_entries(ledger).orderBy(F.desc(DAY)).limit(last_n).collect()
        found = sorted(r[DAY] for r in newest if r["n_clean"])
    if not found:
        raise ValueError(f"no day with rows under {root}")
    return labelled(scan_history(spark, found) if ledger is None else read_history(spark, root, found))


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The newest ledger row of each day: a day may have been ingested again."""
    newest = F.max_by(F.struct("source_key", "run_id", "n_raw", "n_clean", "n_labelled", "ingest_ts"), "ingest_ts")
    return ledger.groupBy(DAY).agg(newest.alias("e")).select(DAY, "e.*")


def labelled(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(LABEL).isNotNull())
