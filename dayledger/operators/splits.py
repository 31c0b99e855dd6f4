"""Train/test splits, folds, exact-size samples and shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayledger.functions.hashing import PRIME, hash31
from dayledger.operators.positions import first_of_any, first_positions
from dayledger.session import scratch_path


def random_split(rows: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split. The same seed gives other rows on another partitioning."""
    first, second = rows.randomSplit([train, 1 - train], seed=seed)
    return first, second


def in_train(key: Column, tenths: int = 8, seed: int = 42) -> Column:
    """True for about `tenths` tenths of the keys, always the same ones; false for a null key."""
    return F.coalesce(hash31(key, seed=seed) % 10 < tenths, F.lit(False))


def hash_split(
    rows: DataFrame, key: str, tenths: int = 8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: no shuffle, and the same on every partitioning.

    Rows without a key go to the second part, so none is lost and none is trained on.
    """
    chosen = in_train(F.col(key), tenths, seed)
    return rows.where(chosen), rows.where(~chosen)


def with_fold(rows: DataFrame, key: str, folds: int = 3, seed: int = 42) -> DataFrame:
    return rows.withColumn("fold", (hash31(F.col(key), seed=seed) % folds).cast("int"))


def exact_sample(rows: DataFrame, key: str, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Exactly round(fraction * n) rows; `key` must identify a row. See `exact_split` for other keys."""
    return first_positions(rows, key, fraction, seed)


def exact_split(
    rows: DataFrame, key: str, fraction: float = 0.8, seed: int = 42, bits: int = 16
) -> tuple[DataFrame, DataFrame]:
    """Exactly round(fraction * n) rows and the rest, which together are all rows.

    Keys may be null or repeat. The rows are written to the scratch folder once, as rows that are
    alike can only be told apart by their place in a stored table; which of them is chosen depends
    on that table. Where keys are unique the choice is that of `exact_sample`.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "split")
    rows.withColumn("_uid", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    chosen = first_of_any(stored, F.col(key), "_uid", fraction, seed, bits)
    return stored.where(chosen).drop("_uid"), stored.where(~chosen).drop("_uid")


def share_split(
    rows: DataFrame, share: float = 0.8, key: str | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """A Bernoulli draw for each row from its own hash: the same rows on any partitioning, any share.

    The hash is that of the key, or of all columns; a null key goes to the second part. Rows with
    the same hash stay together.
    """
    own = F.col(key) if key else F.xxhash64(*(f"`{c}`" for c in rows.columns))
    drawn = F.coalesce(hash31(own, seed=seed) < int(share * PRIME), F.lit(False))
    return rows.where(drawn), rows.where(~drawn)


def holdout(rows: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `train`; duplicates stay."""
    return rows.join(train.select(key), key, "left_anti")
