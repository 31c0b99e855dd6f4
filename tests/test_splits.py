from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dayledger.functions import hash31
from dayledger.operators.positions import with_shuffled_position
from dayledger.operators.splits import exact_sample, exact_split, hash_split, holdout, random_split, share_split, with_fold


def ids(frame, key="id"):
    return {r[key] for r in frame.select(key).collect()}


def test_positions_are_a_permutation_in_hash_order(spark):
    placed = with_shuffled_position(spark.range(5000).repartition(7), "id").collect()
    assert sorted(r["position"] for r in placed) == list(range(1, 5001))
    hashes = {r["id"]: r["h"] for r in spark.range(5000).select("id", hash31(F.col("id")).alias("h")).collect()}
    by_hash = sorted(hashes, key=lambda i: (hashes[i], i))
    assert [r["id"] for r in sorted(placed, key=lambda r: r["position"])] == by_hash


def test_positions_do_not_depend_on_buckets_or_partitions(spark):
    few = with_shuffled_position(spark.range(1000), "id", bits=2)
    many = with_shuffled_position(spark.range(1000).repartition(5), "id", bits=9)
    assert few.exceptAll(many).isEmpty()


def test_exact_sample_is_the_first_positions(spark):
    for n in (0, 1, 2, 10, 999, 4000):
        rows = spark.range(n)
        chosen = ids(exact_sample(rows, "id"))
        assert len(chosen) == round(0.8 * n)
        placed = with_shuffled_position(rows, "id")
        assert chosen == ids(placed.where(F.col("position") <= round(0.8 * n)))


def test_exact_sample_bounds(spark):
    rows = spark.range(100)
    assert exact_sample(rows, "id", 0.0).count() == 0
    assert exact_sample(rows, "id", 1.0).count() == 100


def test_holdout_keeps_duplicates(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id INT")
    train = spark.createDataFrame([(1,), (3,)], "id INT")
    assert [r["id"] for r in holdout(rows, train, "id").collect()] == [2, 2]


def test_sample_and_holdout_cover_the_rows(spark):
    rows = spark.range(1000)
    train = exact_sample(rows, "id")
    test = holdout(rows, train, "id")
    assert ids(train) | ids(test) == set(range(1000)) and not ids(train) & ids(test)


def test_hash_split_is_stable_across_partitionings(spark):
    rows = spark.range(10_000)
    first, rest = hash_split(rows.coalesce(1), "id")
    again, _ = hash_split(rows.repartition(9), "id")
    assert ids(first) == ids(again)
    assert abs(first.count() - 8000) < 200 and first.count() + rest.count() == 10_000


def test_random_split_shares(spark):
    train, test = random_split(spark.range(10_000))
    assert train.count() + test.count() == 10_000 and abs(train.count() - 8000) < 250


def test_folds_are_even(spark):
    counts = with_fold(spark.range(9000), "id").groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == [0, 1, 2]
    assert all(abs(r["count"] - 3000) < 200 for r in counts)


def test_hash_split_loses_no_row_without_key(spark):
    rows = spark.createDataFrame([(None,), (None,), *((i,) for i in range(50))], "id INT")
    train, test = hash_split(rows, "id")
    assert train.count() + test.count() == 52
    assert train.where("id IS NULL").count() == 0


def test_exact_sample_refuses_null_keys(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "id INT")
    with pytest.raises(Exception, match="null in the key id"):
        exact_sample(rows, "id").collect()


@pytest.mark.parametrize("name, key", [
    ("unique", "id"), ("mostly null", "IF(id % 10 = 0, id, NULL)"), ("all null", "CAST(NULL AS BIGINT)"), ("one key", "7L"),
    ("few keys", "id % 3"), ("hot key", "IF(id % 3 = 0, -5L, id)"), ("negative", "-id"),
])
def test_exact_split_of_any_keys(spark, name, key):
    for n, fraction, bits in ((0, 0.8, 16), (1, 0.8, 16), (101, 0.3, 2), (101, 1.0, 2), (1001, 0.8, 4)):
        rows = spark.range(n).selectExpr("id", f"{key} AS k").repartition(3)
        first, rest = (ids(part) for part in exact_split(rows, "k", fraction, bits=bits))
        assert len(first) == round(fraction * n) and not first & rest and first | rest == set(range(n)), (name, n, fraction)


def test_exact_split_of_unique_keys_is_the_exact_sample(spark):
    rows = spark.range(3000).selectExpr("id * 7 - 900 AS id")
    first, rest = exact_split(rows, "id", 0.37)
    assert ids(first) == ids(exact_sample(rows, "id", 0.37)) and first.columns == rows.columns
    same = spark.range(50).selectExpr("1 AS a", "CAST(NULL AS INT) AS k")
    first, rest = exact_split(same, "k", 0.5)
    assert first.count() == rest.count() == 25


def test_share_split_on_any_partitioning(spark):
    rows = spark.range(4000).selectExpr("id", "id % 10 AS a", "IF(id % 4 = 0, NULL, concat('x', id)) AS b")
    for key in (None, "id"):
        found = [ids(share_split(rows.repartition(n), 0.8375, key)[0]) for n in (1, 4, 8)]
        assert found[0] == found[1] == found[2] and abs(len(found[0]) - 3350) < 5 * (4000 * 0.8375 * 0.1625) ** 0.5
        first, rest = share_split(rows, 0.8375, key)
        assert first.count() + rest.count() == 4000
    assert share_split(rows, 1.0)[1].count() == 0 and share_split(rows, 0.0)[0].count() == 0
    first, rest = share_split(spark.createDataFrame([(None,), (3,)], "id INT"), 1.0, "id")
    assert [r[0] for r in first.collect()] == [3] and rest.count() == 1
