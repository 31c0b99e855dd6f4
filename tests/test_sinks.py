from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dayledger.schema import LEDGER
from dayledger.sinks import append_table, drop_days, read_table, write_csv, write_days
from dayledger.sources import folder_days, latest_days, read_history, scan_history, training_set


def day_rows(spark, day_of, n=300):
    return spark.range(n).select(
        F.col("id").cast("int").alias("tranaction_id"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 2).cast("int")).alias("tx_fraud"),
        day_of.alias("src_date"),
    )


def three_days(spark, n=300):
    return day_rows(spark, F.date_add(F.lit(dt.date(2019, 8, 22)), (F.col("id") % 3).cast("int")), n)


def counts(spark, root):
    rows = read_history(spark, root).groupBy("src_date").count().collect()
    return {str(r["src_date"]): r["count"] for r in rows}


@pytest.mark.parametrize("spread", ["rebalance", "as_read", 4])
def test_only_written_days_are_replaced(spark, tmp_path, spread):
    root = str(tmp_path / "history")
    write_days(three_days(spark), root, spread)
    write_days(day_rows(spark, F.lit(dt.date(2019, 8, 23)), 7), root, spread)
    assert counts(spark, root) == {"2019-08-22": 100, "2019-08-23": 7, "2019-08-24": 100}
    write_days(day_rows(spark, F.lit(dt.date(2019, 8, 23)), 7), root, spread)
    assert sum(counts(spark, root).values()) == 207


def test_a_number_caps_the_files_of_a_day(spark, tmp_path):
    root = tmp_path / "history"
    write_days(three_days(spark, 3000).repartition(20), str(root), 4)
    for folder in root.glob("src_date=*"):
        assert 1 <= len(list(folder.glob("*.parquet"))) <= 4


def test_a_hot_day_gets_several_writers(spark, tmp_path):
    root = tmp_path / "history"
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = day_rows(spark, F.lit(dt.date(2019, 8, 23)), 200_000)
        rows = rows.withColumn("pad", F.sha2(F.col("tranaction_id").cast("string"), 256))
        write_days(rows.repartition(16), str(root))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list((root / "src_date=2019-08-23").glob("*.parquet"))) > 4


def test_without_adaptive_execution_days_are_salted(spark, tmp_path):
    root = tmp_path / "history"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_days(day_rows(spark, F.lit(dt.date(2019, 8, 23)), 20_000), str(root))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((root / "src_date=2019-08-23").glob("*.parquet"))) > 2


def test_drop_days(spark, tmp_path):
    root = str(tmp_path / "history")
    write_days(three_days(spark), root)
    drop_days(spark, root, [dt.date(2019, 8, 23), dt.date(2030, 1, 1)])
    assert sorted(counts(spark, root)) == ["2019-08-22", "2019-08-24"]


def test_tables_start_empty_and_grow(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_table(spark, path, LEDGER).count() == 0
    entry = [(dt.date(2019, 8, 22), "k", "r", 3, 2, 1, dt.datetime(2024, 1, 1))]
    for size in (1, 2):
        append_table(spark.createDataFrame(entry, LEDGER), path)
        assert read_table(spark, path, LEDGER).count() == size


def test_csv_has_a_header(spark, tmp_path):
    path = tmp_path / "csv"
    write_csv(spark.range(3).coalesce(1), str(path))
    texts = [f.read_text() for f in Path(path).glob("*.csv")]
    assert texts == ["id\n0\n1\n2\n"]


def plain_folders(spark, root):
    """Day folders without `key=value` names, as an older writer left them."""
    for day, n in (("2019-08-21", 4), ("2019-08-22", 0), ("2019-08-23", 6)):
        rows = day_rows(spark, F.lit(dt.date.fromisoformat(day)), n).drop("src_date")
        rows.coalesce(1).write.parquet(f"{root}/{day}")
    spark.range(1).write.parquet(f"{root}/other")


def test_plain_day_folders(spark, tmp_path):
    root = str(tmp_path / "by_file")
    plain_folders(spark, root)
    days = folder_days(spark, root)
    assert sorted(r["name"] for r in days.collect()) == ["2019-08-21", "2019-08-22", "2019-08-23"]
    assert [r["name"] for r in latest_days(days, 2, "name").collect()] == ["2019-08-22", "2019-08-23"]
    # The empty day counts as one of the latest two.
    chosen = training_set(spark, root, 2)
    assert {str(r["src_date"]) for r in chosen.collect()} == {"2019-08-23"}
    assert chosen.where("tx_fraud IS NULL").isEmpty()
    assert scan_history(spark, f"{root}/2019-08-21").count() == 4


def test_training_set_edges(spark, tmp_path):
    root = str(tmp_path / "by_file")
    plain_folders(spark, root)
    with pytest.raises(ValueError):
        training_set(spark, root, -1)
    assert training_set(spark, f"{root}/2019-08-2*", 0).count() == training_set(spark, root, 99).count()
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        training_set(spark, str(tmp_path / "empty"), 3)


def test_training_set_reads_only_the_chosen_folders(spark, tmp_path):
    root = str(tmp_path / "history")
    write_days(three_days(spark), root)
    stamp = dt.datetime(2024, 1, 1)
    ledger = spark.createDataFrame(
        [(dt.date(2019, 8, d), "k", "r", 9, n, n, stamp) for d, n in ((22, 100), (23, 100), (24, 100), (25, 0))],
        LEDGER,
    )
    rows = training_set(spark, root, 2, ledger)
    assert all("src_date=2019-08-24" in f for f in rows.inputFiles())
    assert {str(r["src_date"]) for r in rows.collect()} == {"2019-08-24"}
