"""Exact global row numbers and exact-size samples without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dayledger.functions.hashing import hash31

HASH_BITS = 31


def bucket_bits(spark: SparkSession) -> int:
    """Bits of a bucket number: at least four buckets per shuffle partition.

    The bucket table has one row per bucket, so it follows the width of the cluster's
    shuffles and never the data; at most 2**18 rows.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max((4 * width - 1).bit_length(), 6), 18)


def bucket_of(hashed: Column, bits: int) -> Column:
    """Top bits of the hash, so buckets are in hash order and evenly filled."""
    return F.shiftright(hashed, HASH_BITS - bits).cast("int")


def bucket_sizes(rows: DataFrame, key: str, seed: int, bits: int) -> DataFrame:
    """Rows of each bucket and of the buckets before it."""
    sizes = rows.groupBy(bucket_of(hash31(F.col(key), seed=seed), bits).alias("_bucket")).agg(
        F.count("*").alias("_size")
    )
    return sizes.withColumn("_before", rows_before("_bucket", "_size"))


def rows_before(bucket: str, size: str, by: tuple[str, ...] = ()) -> Column:
    """Running total of the earlier buckets. One task (for each group), but one row per bucket only."""
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(earlier), F.lit(0))


def with_shuffled_position(
    rows: DataFrame, key: str, seed: int = 42, bits: int | None = None, name: str = "position"
) -> DataFrame:
    """Number the rows 1..n in a pseudo-random order fixed by the row id `key` and seed.

    Rows are ordered by a hash of the id, ties by the id. They are numbered within ranges
    of the hash, which hold an even share whatever the ids are, and shifted by the size of
    the ranges before.
    """
    bits = bits or bucket_bits(rows.sparkSession)
    placed = rows.withColumn("_hash", hash31(F.col(key), seed=seed)).withColumn(
        "_bucket", bucket_of(F.col("_hash"), bits)
    )
    offsets = bucket_sizes(rows, key, seed, bits).select("_bucket", "_before")
    within = Window.partitionBy("_bucket").orderBy("_hash", key)
    # At most 2**bits rows are broadcast, whatever the size of the data. Every row has a
    # bucket; the left join only keeps a null test of the hash out of the scan.
    return (
        placed.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket", "left")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_bucket", "_hash", "_row", "_before")
    )


def first_positions(
    rows: DataFrame, key: str, fraction: float, seed: int = 42, bits: int | None = None
) -> DataFrame:
    """The rows whose shuffled position is at most round(fraction * n).

    No row is shuffled: the bucket sizes tell in which bucket the last position falls, only
    that bucket is numbered, and the hash and id found there cut the whole table. A null key
    has no position and fails; `first_of_any` takes any keys.
    """
    bits = bits or max(bucket_bits(rows.sparkSession), 16)
    null_key = F.raise_error(F.lit(f"null in the key {key}")).cast("bigint")
    hashed = F.coalesce(hash31(F.col(key), seed=seed), null_key)
    sizes = bucket_sizes(rows, key, seed, bits)
    target = rows.agg(F.round(F.count("*") * fraction).cast("bigint").alias("target")).scalar()
    last = sizes.withColumn("_need", target - F.col("_before")).where(
        (F.col("_need") > 0) & (F.col("_need") <= F.col("_size"))
    )
    within = Window.partitionBy("_bucket").orderBy("_hash", key)
    cut = (
        rows.select(key, hashed.alias("_hash"))
        .withColumn("_bucket", bucket_of(F.col("_hash"), bits))
        # One row: the bucket the last position falls in.
        .join(F.broadcast(last), "_bucket")
        .withColumn("_row", F.row_number().over(within))
        .where(F.col("_row") == F.col("_need"))
        .select(F.struct("_hash", F.col(key).alias("_key")).alias("cut"))
    )
    return rows.where(F.struct(hashed.alias("_hash"), F.col(key).alias("_key")) <= cut.scalar())


def first_of_any(stored: DataFrame, key: Column, uid: str, fraction: float, seed: int = 42, bits: int = 16) -> Column:
    """True for exactly round(fraction * n) rows, whatever nulls and repeats the key has.

    `stored` must be a written table and `uid` a column of it that tells its rows apart. Rows are
    in the order of the key's hash; rows of one key are in the order of the hash of `uid`, and a
    row without key is a key of its own. Four counts narrow the cut down: the range of hashes it
    falls in, the key, the range of that key's rows, and the row. Each brings one row to the
    driver, and no task numbers more than one such range.
    """
    own = F.coalesce(key.cast("bigint"), -1 - F.col(uid))
    place = {
        "_hash": hash31(own, seed=seed), "_key": own, "_tie": hash31(F.col(uid), stream=1, seed=seed), "_uid": F.col(uid),
    }
    rows = stored.select(*(column.alias(name) for name, column in place.items()))
    need = int(stored.agg(F.round(F.count("*") * fraction).cast("bigint")).first()[0])
    if not need:
        return F.lit(False)
    for names in ((bucket_of(F.col("_hash"), bits),), ("_hash", "_key"), (bucket_of(F.col("_tie"), bits),), ("_tie", "_uid")):
        named = [(F.col(c) if isinstance(c, str) else c).alias(f"_at{i}") for i, c in enumerate(names)]
        at = [f"_at{i}" for i in range(len(names))]
        sizes = rows.select(*named).groupBy(*at).agg(F.count("*").alias("_size"))
        order = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = sizes.withColumn("_upto", F.sum("_size").over(order)).where(F.col("_upto") >= need).orderBy("_upto").first()
        need -= last["_upto"] - last["_size"]
        for c, found in zip(names, at, strict=True):
            rows = rows.where((F.col(c) if isinstance(c, str) else c) == F.lit(last[found]))
    cut = rows.first()
    ordered = F.struct(*(column.alias(name) for name, column in place.items()))
    return ordered <= F.struct(*(F.lit(cut[name]).cast("bigint").alias(name) for name in place))
