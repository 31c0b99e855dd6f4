from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, days_from, row
from dayledger.operators.cleaning import clean
from dayledger.operators.features import feature_columns
from dayledger.schema import RAW
from dayledger.sources import read_history, read_raw, training_set
from dayledger.streaming import stream_ingest


def drain(spark, landing, tmp_path):
    query = stream_ingest(
        spark, landing.root, str(tmp_path / "history"), str(tmp_path / "cursor"), files_per_trigger=2
    )
    query.awaitTermination()
    return query


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*RAW.names, "src_date").collect())


def test_stream_equals_batch_and_reads_late_files(spark, landing, tmp_path):
    for number, day in enumerate(days_from("2019-08-23", 5)):
        landing(day, [row(number * 100 + i, day, customer=str(i % 4)) for i in range(20)])
    history = str(tmp_path / "history")
    first = drain(spark, landing, tmp_path)
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 3
    assert rows_of(read_history(spark, history)) == rows_of(clean(read_raw(spark, landing.root)))
    again = drain(spark, landing, tmp_path)
    assert not [p for p in again.recentProgress if p["numInputRows"]]
    landing("2019-08-20", [row(900, "2019-08-20")])
    drain(spark, landing, tmp_path)
    late = read_history(spark, history).where(F.col("tranaction_id") == 900)
    assert late.count() == 1
    assert rows_of(read_history(spark, history)) == rows_of(clean(read_raw(spark, landing.root)))


def test_streamed_history_can_be_trained_on(spark, landing, tmp_path):
    for number, day in enumerate(days_from("2019-08-23", 4)):
        landing(day, [row(number * 100 + i, day) for i in range(5)])
    drain(spark, landing, tmp_path)
    rows = training_set(spark, str(tmp_path / "history"), 2)
    assert {str(r["src_date"]) for r in rows.collect()} == {"2019-08-25", "2019-08-26"}
    assert training_set(spark, str(tmp_path / "history")).count() == 20
    assert "batch_id" in rows.columns and "batch_id" not in feature_columns(rows)


@pytest.mark.parametrize("name", ["2019-08-23.txt", "2019-08-23", "src_date=2019-08-23"])
def test_a_day_in_two_batches_keeps_both(spark, tmp_path, name):
    folder = tmp_path / "landing" / name
    folder.mkdir(parents=True)

    class Area:
        root = str(tmp_path / "landing")

    for part in range(2):
        (folder / f"part-{part}.csv").write_text("h\n" + row(part + 1, "2019-08-23") + "\n")
        drain(spark, Area, tmp_path)
    history = read_history(spark, str(tmp_path / "history"))
    assert sorted(r["tranaction_id"] for r in history.collect()) == [1, 2]
    assert {r["batch_id"] for r in history.collect()} == {0, 1}
    assert {r["_source_key"] for r in history.collect()} == {"2019-08-23.txt"}


def test_no_layout_hides_another(spark, landing, tmp_path):
    landing("2024-01-01", [row(1, "2024-01-01"), row(2, "2024-01-01")])

    def add(folder, i, day):
        path = tmp_path / "landing" / folder
        path.mkdir(exist_ok=True)
        (path / f"part-{i}.csv").write_text(f"{HEADER}\n{row(i, day)}\n")

    add("src_date=2024-01-02", 3, "2024-01-02")
    add("2024-01-03", 4, "2024-01-03")
    add("2024-01-04.txt", 5, "2024-01-04")
    drain(spark, landing, tmp_path)
    history = str(tmp_path / "history")
    assert rows_of(read_history(spark, history)) == rows_of(clean(read_raw(spark, landing.root)))
    assert [r[0] for r in rows_of(read_history(spark, history))] == [1, 2, 3, 4, 5]
    # Layouts that appear after the query has begun.
    add("src_date=2024-01-01", 6, "2024-01-01")
    add("2024-01-02", 7, "2024-01-02")
    drain(spark, landing, tmp_path)
    found = {r["tranaction_id"]: str(r["src_date"]) for r in read_history(spark, history).collect()}
    assert found == {1: "2024-01-01", 2: "2024-01-01", 3: "2024-01-02", 4: "2024-01-03", 5: "2024-01-04", 6: "2024-01-01", 7: "2024-01-02"}
    assert {r["_source_key"] for r in read_history(spark, history).collect()} == {f"2024-01-0{i}.txt" for i in range(1, 5)}


def test_a_file_that_names_no_day_stops_the_stream_or_is_set_aside(spark, landing, tmp_path):
    landing("2024-01-01", [row(1, "2024-01-01")])
    landing("2024-01-01_backup", [row(2, "2024-01-01"), row(3, "2024-01-01", amount="-1")])
    with pytest.raises(Exception, match="no day in the path of .*2024-01-01_backup.txt"):
        drain(spark, landing, tmp_path)
    aside = str(tmp_path / "quarantine")
    for _ in range(2):
        stream_ingest(
            spark, landing.root, str(tmp_path / "history"), str(tmp_path / "cursor"), files_per_trigger=2, quarantine=aside
        ).awaitTermination()
    assert [r["tranaction_id"] for r in read_history(spark, str(tmp_path / "history")).collect()] == [1]
    held = spark.read.parquet(aside).collect()
    assert sorted(r["tranaction_id"] for r in held) == [2, 3] and all(r["_source_file"].endswith("_backup.txt") for r in held)
