"""Synthetic labelled transactions with class-conditional distributions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayledger.functions.hashing import bernoulli, exponential, standard_normal, uniform_int
from dayledger.operators.positions import with_shuffled_position

# Parameters of each class, as (normal, fraud).
AMOUNT_MU = (5.0, 6.0)
AMOUNT_SIGMA = (1.0, 2.0)
HOME_SCALE = (30.0, 100.0)
LAST_SCALE = (20.0, 100.0)
RATIO_MEAN = (1.0, 3.0)
RATIO_SD = (0.5, 1.0)
REPEAT_P = (0.5, 0.2)
CHIP_P = (0.9, 0.2)
PIN_P = (0.8, 0.2)
ONLINE_P = (0.4, 0.8)
HOURS = 24
WEEKDAYS = 7
MINUTES = 60 * 24 * 30
FRAUD_RATE = 0.05
ROWS = 100_000
SEED = 42
# Timestamps count back from an anchor rather than from now, so runs can be compared.
ANCHOR = dt.datetime(2024, 1, 31)


def synth_transactions(
    spark: SparkSession, n: int = ROWS, fraud_rate: float = FRAUD_RATE, seed: int = SEED
) -> DataFrame:
    return synthesize(spark.range(n), F.lit(n), fraud_rate, seed)


def synthesize(
    ids: DataFrame,
    n: Column,
    fraud_rate: float = FRAUD_RATE,
    seed: int = SEED,
    anchor: dt.datetime = ANCHOR,
) -> DataFrame:
    """One transaction per id 0..n-1; the last ones are fraud, then ids are shuffled.

    Every value is a function of the id, so a recomputed partition gets the same rows, and
    only the ids are shuffled: the other columns are drawn afterwards.
    """
    is_fraud = (F.col("id") >= F.floor(n * (1 - fraud_rate))).cast("int")
    rows = with_shuffled_position(ids.select("id"), "id", seed).withColumn("fraud", is_fraud)
    i = F.col("id")

    def by_class(values: tuple[float, float]) -> Column:
        return F.when(F.col("fraud") == 1, F.lit(values[1])).otherwise(F.lit(values[0]))

    minutes_ago = F.make_dt_interval(mins=uniform_int(i, 13, 1, MINUTES, seed))
    amount = by_class(AMOUNT_MU) + by_class(AMOUNT_SIGMA) * standard_normal(i, 1, seed)
    ratio = by_class(RATIO_MEAN) + by_class(RATIO_SD) * standard_normal(i, 7, seed)
    return rows.select(
        transaction_id(F.col("position") - 1).alias("transaction_id"),
        (F.lit(anchor).cast("timestamp") - minutes_ago).alias("timestamp"),
        F.exp(amount).alias("amount"),
        uniform_int(i, 3, 0, HOURS, seed).alias("hour_of_day"),
        uniform_int(i, 4, 0, WEEKDAYS, seed).alias("day_of_week"),
        exponential(i, 5, by_class(HOME_SCALE), seed).alias("distance_from_home"),
        exponential(i, 6, by_class(LAST_SCALE), seed).alias("distance_from_last_transaction"),
        ratio.alias("ratio_to_median_purchase_price"),
        bernoulli(i, 9, by_class(REPEAT_P), seed).alias("repeat_retailer"),
        bernoulli(i, 10, by_class(CHIP_P), seed).alias("used_chip"),
        bernoulli(i, 11, by_class(PIN_P), seed).alias("used_pin_number"),
        bernoulli(i, 12, by_class(ONLINE_P), seed).alias("online_order"),
        "fraud",
    )


def transaction_id(number: Column) -> Column:
    """`tx_` and at least eight digits."""
    digits = number.cast("string")
    return F.concat(F.lit("tx_"), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def union_classes(normal: DataFrame, fraud: DataFrame) -> DataFrame:
    """All rows of both classes, duplicates included."""
    return normal.unionByName(fraud)
