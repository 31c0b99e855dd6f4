"""Demo data: synthetic transactions, split 80/20 and written as comma files."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession, functions as F

from dayledger.operators.metrics import label_rate
from dayledger.operators.splits import exact_sample, holdout
from dayledger.operators.synthesis import FRAUD_RATE, ROWS, SEED, synth_transactions
from dayledger.sinks import write_csv

TRAIN_SHARE = 0.8


def write_demo_data(
    spark: SparkSession, root: str, n: int = ROWS, fraud_rate: float = FRAUD_RATE, seed: int = SEED
) -> Row:
    """Write `train` and `test` below the root; returns rows, frauds and their percentage."""
    base = root.rstrip("/")
    rows = synth_transactions(spark, n, fraud_rate, seed)
    keyed = rows.withColumn("_number", F.substring("transaction_id", 4, 20).cast("bigint"))
    train = exact_sample(keyed, "_number", TRAIN_SHARE, seed)
    write_csv(train.drop("_number"), f"{base}/train")
    write_csv(holdout(keyed, train, "_number").drop("_number"), f"{base}/test")
    return label_rate(rows, "fraud").first()
