"""Moments kept beside the ledger, so scaler statistics of any window of days need no history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.operators.features import feature_columns
from dayledger.operators.moments import day_moments, scaler_stats_window
from dayledger.plans.cycle import Store
from dayledger.schema import DAY, MOMENTS
from dayledger.sinks import drop_days, read_table, write_days
from dayledger.sources import latest_entries


def moments_path(store: Store) -> str:
    return store.path("moments")


def update_moments(spark: SparkSession, store: Store) -> list[dt.date]:
    """Write the moments of ledger days that have none, or were ingested again since; returns those days.

    Only these days are read. Days that are empty now lose theirs.
    """
    entries = latest_entries(store.ledger(spark)).select(DAY, "run_id", "ingest_ts", "n_clean")
    known = read_table(spark, moments_path(store), MOMENTS).select(DAY, "run_id", "ingest_ts").distinct()
    stale = entries.join(known, [DAY, "run_id", "ingest_ts"], "left_anti")
    found = {r[DAY]: r["n_clean"] for r in stale.collect()}  # one row per day
    drop_days(spark, moments_path(store), [day for day, n in found.items() if not n])
    days = sorted(day for day, n in found.items() if n)
    if days:
        rows = store.day_rows(spark, days)
        moments = day_moments(rows, feature_columns(rows)).join(F.broadcast(stale.drop("n_clean")), DAY)
        write_days(moments, moments_path(store))
    return days


def window_stats(spark: SparkSession, store: Store, last_n: int) -> DataFrame:
    """Mean and deviation of every feature over the last `last_n` ledger days up to each day."""
    return scaler_stats_window(read_table(spark, moments_path(store), MOMENTS), store.ledger(spark), last_n)
