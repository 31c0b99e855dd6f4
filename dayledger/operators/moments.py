"""Counts, means and sums of squares that can be merged, so a window of days needs no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayledger.schema import DAY


def day_moments(rows: DataFrame, columns: list[str], by: str = DAY) -> DataFrame:
    """(day, idx, feature, n, mean, m2) of each day and feature, from one pass.

    `m2` is the sum of squared distances from the mean. A feature that is null all day has n = 0.
    """

    def moment(i: int, name: str) -> Column:
        value = F.col(name).cast("double")
        n = F.count(value)
        return F.struct(
            F.lit(i).alias("idx"),
            F.lit(name).alias("feature"),
            n.alias("n"),
            F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"),
        )

    wide = rows.groupBy(by).agg(F.array(*(moment(i, c) for i, c in enumerate(columns))).alias("moments"))
    return wide.select(by, F.inline("moments"))


def merge(parts: Column) -> Column:
    """One struct (n, mean, m2) for an array of them, without cancellation where means are large."""

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n))).alias("m2"),
        )
        return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)

    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, nothing, add)


def day_windows(days: DataFrame, last_n: int, by: str = DAY) -> DataFrame:
    """(window_end, day): every day with each of the `last_n` days that end with it.

    One row per day is numbered, and each day is in at most `last_n` windows.
    """
    placed = days.select(by).distinct().withColumn("_at", F.row_number().over(Window.orderBy(by)))
    ends = placed.select(F.col(by).alias("window_end"), F.col("_at").alias("_end"))
    within = F.explode(F.sequence(F.col("_at"), F.col("_at") + (last_n - 1)))
    return placed.withColumn("_end", within).join(ends, "_end").select("window_end", by)


def scaler_stats_window(moments: DataFrame, days: DataFrame, last_n: int, by: str = DAY) -> DataFrame:
    """(window_end, idx, feature, n, mean, std) over the last days up to each day, from stored moments.

    `days` are those that count, empty ones too. `std` is the sample standard deviation, null for
    fewer than two values, and `mean` is null for none.
    """
    part = F.struct("n", "mean", "m2")
    grouped = moments.join(day_windows(days, last_n, by), by).groupBy("window_end", "idx", "feature")
    merged = grouped.agg(merge(F.collect_list(part)).alias("m"))
    n, m2 = F.col("m.n"), F.col("m.m2")
    return merged.select(
        "window_end", "idx", "feature", n.alias("n"),
        F.when(n > 0, F.col("m.mean")).alias("mean"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("std"),
    )


def auc_window(counts: DataFrame, days: DataFrame, last_n: int, by: str = DAY) -> DataFrame:
    """(window_end, score, pos, neg): score counts of the last days up to each day, for `metrics.auc_of`."""
    merged = counts.join(day_windows(days, last_n, by), by).groupBy("window_end", "score")
    return merged.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
