"""Row filters, lineage columns and per-day counts of the cleaning step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from dayledger.schema import DAY, INGEST_TS, LABEL, RUN_ID


def is_clean(drop_nan: bool = False) -> Column:
    """True for a row that passes cleaning; false or null otherwise.

    Comparisons are three-valued, so a null amount or id does not pass. NaN is
    greater than zero in Spark and passes unless `drop_nan` is set.
    """
    passes = (
        (F.col("tx_amount") > 0)
        & (F.col("customer_id") > 0)
        & (F.col("terminal_id") > 0)
        & F.col("tx_datetime").isNotNull()
    )
    return passes & ~F.isnan("tx_amount") if drop_nan else passes


def clean(rows: DataFrame, drop_nan: bool = False) -> DataFrame:
    return rows.where(is_clean(drop_nan))


def with_lineage(rows: DataFrame, run_id: str | Column) -> DataFrame:
    """Add the run and the time of ingest; the source key comes with the scan."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return rows.withColumns({RUN_ID: run, INGEST_TS: F.current_timestamp()})


def clean_counts(rows: DataFrame, by: str | None = DAY, drop_nan: bool = False) -> DataFrame:
    """Raw and clean row counts per day (or in total) in one pass."""
    grouped = rows.groupBy(by) if by else rows.groupBy()
    return grouped.agg(
        F.count("*").alias("n_raw"), F.count_if(is_clean(drop_nan)).alias("n_clean")
    )


def count_columns(days: list[dt.date], drop_nan: bool = False) -> list[Column]:
    """Aggregates to observe on a scan of a few days: raw, clean and clean labelled rows of each."""
    columns = []
    for day in days:
        here = F.col(DAY) == F.lit(day)
        columns += [
            F.count_if(here).alias(f"raw_{day}"),
            F.count_if(here & is_clean(drop_nan)).alias(f"clean_{day}"),
            F.count_if(here & is_clean(drop_nan) & F.col(LABEL).isNotNull()).alias(f"labelled_{day}"),
        ]
    return columns
