from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayledger import functions as fn
from dayledger.functions.hashing import PRIME
from dayledger.sources import parse_watermark, read_watermark

START = dt.date(2019, 8, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "path, day",
    [
        ("s3a://b/2019-08-23.txt", "2019-08-23"),
        ("s3a://b/2019-01-01/2019-08-23.txt", "2019-08-23"),
        ("file:/b/by_file/2019-08-23/part-0.snappy.parquet", "2019-08-23"),
        ("/b/src_date=2019-08-23/part-00000-ab.c000.csv", "2019-08-23"),
        ("/b/2019-08-23.txt/part-0.csv", "2019-08-23"),
        ("/b/part-0.csv", None),
        ("/b/2019-02-30.txt", None),
    ],
)
def test_day_of_file(spark, path, day):
    got = one(spark, fn.day_of_file(F.lit(path), F.lit(path.rsplit("/", 1)[-1])))
    assert (str(got) if got else None) == day


@pytest.mark.parametrize(
    "text, day",
    [
        ("2019-08-22\n", "2019-08-22"),
        (" \t2019-08-22.txt\r\n", "2019-08-22"),
        ("2019-8-2", "2019-08-02"),
        ("", "2019-08-01"),
        (" \n", "2019-08-01"),
        (".txt", "2019-08-01"),
        (None, "2019-08-01"),
    ],
)
def test_watermark_texts(spark, text, day):
    assert str(one(spark, parse_watermark(F.lit(text).cast("string"), START))) == day


def test_bad_watermark_fails(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed|CAST_INVALID"):
        one(spark, parse_watermark(F.lit("yesterday"), START))


def test_watermark_file(spark, tmp_path):
    file = tmp_path / "last_date.txt"
    assert read_watermark(spark, str(file), START) == START
    file.write_text("2019-08-22\n")
    assert read_watermark(spark, str(file), START) == dt.date(2019, 8, 22)
    file.write_text("")
    assert read_watermark(spark, str(file), START) == START


def test_split_uri(spark):
    parts = one(spark, fn.split_uri(F.lit("s3a://bucket//clean/history/")))
    assert tuple(parts) == ("bucket", "clean/history/")
    assert tuple(one(spark, fn.split_uri(F.lit("S3://my_bucket")))) == ("my_bucket", "")
    assert one(spark, fn.split_uri(F.lit("http://x/y"), strict=False)) is None
    with pytest.raises(Exception, match="expected s3a:// or s3://"):
        one(spark, fn.split_uri(F.lit("http://x/y")))


def test_day_name_shape(spark):
    names = ["2019-08-22", "abcd-ef-gh", "2019/08/22", "20190822", "2019-08-222"]
    rows = spark.createDataFrame([(n,) for n in names], ["n"])
    kept = [r["n"] for r in rows.where(fn.is_day_name(F.col("n"))).collect()]
    assert kept == ["2019-08-22", "abcd-ef-gh"]


def test_hash_is_spread_and_keyed_by_id_only(spark):
    ids = spark.range(100_000)
    bins = ids.groupBy((fn.hash31(F.col("id")) % 10).alias("b")).count().collect()
    assert len(bins) == 10
    assert all(abs(r["count"] - 10_000) < 500 for r in bins)
    extremes = ids.agg(F.min(fn.hash31(F.col("id"))), F.max(fn.hash31(F.col("id")))).first()
    assert 0 <= extremes[0] and extremes[1] < PRIME
    assert ids.select(fn.hash31(F.col("id"))).distinct().count() == 100_000
    one_part = ids.coalesce(1).select("id", fn.hash31(F.col("id")))
    many = ids.repartition(7).select("id", fn.hash31(F.col("id")))
    assert one_part.exceptAll(many).isEmpty()


def test_hash_takes_large_and_negative_ids(spark):
    ids = spark.createDataFrame([(2**62 + 12,), (2**31,), (-5,), (2**63 - 9,)], "id BIGINT")
    values = [r[0] for r in ids.select(fn.hash31(F.col("id"))).collect()]
    assert all(0 <= v < PRIME for v in values) and len(set(values)) == 4


def test_streams_are_not_correlated(spark):
    ids = spark.range(50_000)
    pairs = ids.select(fn.uniform(F.col("id"), 1).alias("a"), fn.uniform(F.col("id"), 2).alias("b"))
    assert abs(pairs.agg(F.corr("a", "b")).first()[0]) < 0.02
