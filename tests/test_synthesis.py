from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dayledger.operators.synthesis import ANCHOR, synth_transactions, transaction_id, union_classes


@pytest.fixture(scope="module")
def rows(spark):
    frame = synth_transactions(spark, 20_000).cache()
    yield frame
    frame.unpersist()


def test_class_sizes_and_ids(rows):
    assert rows.count() == 20_000
    assert rows.where("fraud = 1").count() == 1000
    ids = rows.agg(F.min("transaction_id"), F.max("transaction_id"), F.countDistinct("transaction_id")).first()
    assert tuple(ids) == ("tx_00000000", "tx_00019999", 20_000)


def test_fraud_is_spread_over_the_ids(rows):
    early = rows.where("transaction_id < 'tx_00010000'").where("fraud = 1").count()
    assert 400 < early < 600


def test_distributions(rows):
    per_class = {
        r["fraud"]: r
        for r in rows.groupBy("fraud").agg(
            F.avg(F.ln("amount")).alias("mu"),
            F.stddev(F.ln("amount")).alias("sigma"),
            F.avg("distance_from_home").alias("home"),
            F.avg("distance_from_last_transaction").alias("last"),
            F.avg("ratio_to_median_purchase_price").alias("ratio"),
            F.stddev("ratio_to_median_purchase_price").alias("ratio_sd"),
            F.avg("repeat_retailer").alias("repeat"),
            F.avg("used_chip").alias("chip"),
            F.avg("used_pin_number").alias("pin"),
            F.avg("online_order").alias("online"),
        ).collect()
    }
    wanted = {
        0: (5.0, 1.0, 30.0, 20.0, 1.0, 0.5, 0.5, 0.9, 0.8, 0.4),
        1: (6.0, 2.0, 100.0, 100.0, 3.0, 1.0, 0.2, 0.2, 0.2, 0.8),
    }
    for label, values in wanted.items():
        for name, value in zip(per_class[label].__fields__[1:], values):
            assert per_class[label][name] == pytest.approx(value, rel=0.15), (label, name)


def test_ranges(rows):
    low = rows.agg(*(F.min(c).alias(c) for c in ("hour_of_day", "day_of_week", "distance_from_home"))).first()
    high = rows.agg(F.max("hour_of_day"), F.max("day_of_week"), F.max("timestamp"), F.min("timestamp")).first()
    assert (low["hour_of_day"], low["day_of_week"]) == (0, 0) and low["distance_from_home"] > 0
    assert (high[0], high[1]) == (23, 6)
    assert 60 <= (ANCHOR - high[2]).total_seconds() and (ANCHOR - high[3]).total_seconds() <= 43_199 * 60


def test_rows_do_not_depend_on_partitions(spark, rows):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert synth_transactions(spark, 20_000).exceptAll(rows).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_union_keeps_duplicates(spark):
    one = spark.createDataFrame([(1, 0)], "a INT, b INT")
    assert union_classes(one, one.select("b", "a")).count() == 2


def test_long_ids_keep_their_digits(spark):
    numbers = spark.createDataFrame([(7,), (123_456_789_012,)], "n BIGINT")
    got = [r[0] for r in numbers.select(transaction_id(F.col("n"))).collect()]
    assert got == ["tx_00000007", "tx_123456789012"]
