"""Statistics and AUC of moving windows from stored, mergeable states."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import days_from, row
from dayledger import CommittedStore, Store, clean_cycle
from dayledger.operators import metrics, moments
from dayledger.plans import windows
from test_metrics import pairwise_auc

START = dt.date(2019, 8, 22)


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_merged_moments_equal_those_of_all_values(spark, shift):
    rnd = random.Random(3)
    values = [[shift + rnd.gauss(0, 1 + day) for _ in range(size)] for day, size in enumerate([5, 0, 1, 400, 2, 30])]
    rows = [(f"2024-01-0{1 + day}", v, None) for day, own in enumerate(values) for v in own] + [("2024-01-02", None, None)]
    frame = spark.createDataFrame(rows, "src_date STRING, a DOUBLE, none DOUBLE").withColumn("src_date", F.col("src_date").cast("date"))
    kept = moments.day_moments(frame.repartition(7), ["a", "none"])
    assert kept.count() == 12
    for last_n in (1, 3, 100):
        found = {(r["window_end"].day, r["feature"]): r for r in moments.scaler_stats_window(kept, frame.select("src_date"), last_n).collect()}
        for end in range(1, 7):
            own = [v for day in values[max(0, end - last_n) : end] for v in day]
            got = found[end, "a"]
            assert got["n"] == len(own) and found[end, "none"]["n"] == 0 and found[end, "none"]["mean"] is None
            assert got["mean"] == pytest.approx(statistics.fmean(own), rel=1e-12) if own else got["mean"] is None
            assert got["std"] == pytest.approx(statistics.stdev(own), rel=1e-6) if len(own) > 1 else got["std"] is None


@pytest.mark.parametrize("kind", [Store, CommittedStore])
def test_moments_follow_the_ledger(spark, landing, tmp_path, kind):
    days = days_from("2019-08-23", 6)
    for number, day in enumerate(days):
        landing(day, None if number == 2 else [row(number * 100 + i, day, amount=str(1 + i * number)) for i in range(20)])
    store = kind(str(tmp_path / "store"))
    clean_cycle(spark, landing.root, store, START, take_n=4)
    assert list(map(str, windows.update_moments(spark, store))) == [days[0], days[1], days[3]]
    assert windows.update_moments(spark, store) == []
    clean_cycle(spark, landing.root, store, START, take_n=4)
    assert list(map(str, windows.update_moments(spark, store))) == days[4:]
    written = {p: p.stat().st_mtime_ns for p in Path(windows.moments_path(store)).rglob("*.parquet")}
    found = {(str(r["window_end"]), r["feature"]): r for r in windows.window_stats(spark, store, 3).collect()}
    assert {p: p.stat().st_mtime_ns for p in Path(windows.moments_path(store)).rglob("*.parquet")} == written
    amounts = {day: [1.0 + i * number for i in range(20)] if number != 2 else [] for number, day in enumerate(days)}
    for at, day in enumerate(days):
        own = [v for d in days[max(0, at - 2) : at + 1] for v in amounts[d]]
        got = found[day, "tx_amount"]
        assert (got["n"], got["mean"]) == (len(own), pytest.approx(statistics.fmean(own))) and got["std"] == pytest.approx(statistics.stdev(own))


def test_auc_of_any_window(spark):
    rnd = random.Random(8)
    rows = [(1 + i % 6, float(rnd.random() < 0.4), rnd.randrange(12) / 12) for i in range(300)] + [(8, 1.0, 0.5)]
    frame = spark.createDataFrame(rows, "src_date INT, label DOUBLE, score DOUBLE")
    counts = metrics.score_counts(frame.repartition(4), "label", "score", ("src_date",))
    for last_n in (1, 3, 10):
        merged = moments.auc_window(counts, frame.select("src_date"), last_n)
        found = {r["window_end"]: r["auc"] for r in metrics.auc_of(merged, ("window_end",)).collect()}
        days = [1, 2, 3, 4, 5, 6, 8]
        assert sorted(found) == days
        for at, end in enumerate(days):
            own = [(label, 0, score) for day, label, score in rows if day in days[max(0, at - last_n + 1) : at + 1]]
            single = len({label for label, _, _ in own}) == 1
            assert found[end] == (0.0 if single else pytest.approx(pairwise_auc(own), abs=1e-12))
