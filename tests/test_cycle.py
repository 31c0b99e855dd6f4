from __future__ import annotations

import datetime as dt
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, days_from, row
from dayledger.operators.cleaning import clean_counts
from dayledger.plans import cycle, model
from dayledger.plans.cycle import Store, clean_cycle, promotions, register, train_cycle, training_growth
from dayledger.schema import MODEL_VERSIONS, RAW, wide
from dayledger.sinks import append_table
from dayledger.sources import ledger_watermark, read_history, read_raw

START = dt.date(2019, 8, 22)
SMALL = {"num_trees": (3, 5), "max_depth": (2, 3)}


def fill(landing, days, n=60):
    for number, day in enumerate(days):
        landing(day, [row(number * 1000 + i, day, amount=str(i % 9), terminal=str(1 + i % 3)) for i in range(n)])


def watermark(spark, store):
    return ledger_watermark(store.ledger(spark), START).first()[0]


def test_cycles_walk_over_a_gapped_source(spark, landing, tmp_path):
    days = [d for d in days_from("2019-08-22", 9) if d not in ("2019-08-25", "2019-08-28")]
    fill(landing, days)
    store = Store(str(tmp_path / "store"))
    seen = []
    while (done := clean_cycle(spark, landing.root, store, START, take_n=2)).counts:
        seen.append(sorted(map(str, done.counts)))
        assert watermark(spark, store) == done.watermark == max(done.counts)
    # The start day itself is never ingested.
    assert seen == [["2019-08-23", "2019-08-24"], ["2019-08-26", "2019-08-27"], ["2019-08-29", "2019-08-30"]]
    assert done.status == "nothing_found" and done.watermark == dt.date(2019, 8, 30)
    ledger = {str(r["src_date"]): r for r in store.ledger(spark).collect()}
    counted = {str(r["src_date"]): r for r in clean_counts(read_raw(spark, landing.root)).collect()}
    for day, entry in ledger.items():
        assert (entry["n_raw"], entry["n_clean"]) == (counted[day]["n_raw"], counted[day]["n_clean"])
        assert entry["source_key"] == f"{day}.txt"
    assert read_history(spark, store.history).count() == sum(e["n_clean"] for e in ledger.values())
    growth = [r["train_rows"] for r in training_growth(store.ledger(spark), 3).orderBy("src_date").collect()]
    per_day = [ledger[d]["n_labelled"] for d in sorted(ledger)]
    assert growth == [sum(per_day[max(0, i - 2): i + 1]) for i in range(len(per_day))]


def test_scan_cap_stops_short_and_stays(spark, landing, tmp_path):
    fill(landing, ["2019-09-10"])
    store = Store(str(tmp_path / "store"))
    for _ in range(2):
        assert clean_cycle(spark, landing.root, store, START, max_scan_days=5).status == "nothing_found"
    assert watermark(spark, store) == START


def test_late_file_is_not_read(spark, landing, tmp_path):
    store = Store(str(tmp_path / "store"))
    fill(landing, ["2019-08-24"])
    clean_cycle(spark, landing.root, store, START)
    fill(landing, ["2019-08-23"])
    assert clean_cycle(spark, landing.root, store, START).status == "nothing_found"


def test_empty_day_is_ledgered_and_clears_old_rows(spark, landing, tmp_path):
    store = Store(str(tmp_path / "store"))
    fill(landing, ["2019-08-23"])
    landing("2019-08-24", None)
    landing("2019-08-25", [row(1, "2019-08-25", amount="-1")])
    done = clean_cycle(spark, landing.root, store, START)
    assert {str(d): c for d, c in done.counts.items()} == {
        "2019-08-23": (60, 53), "2019-08-24": (0, 0), "2019-08-25": (1, 0),
    }
    assert (done.n_raw, done.n_clean) == (61, 53)
    # Ingesting the first day again, now without a clean row, removes its old rows.
    landing("2019-08-23", [row(1, "2019-08-23", customer="0")])
    again = {dt.date(2019, 8, 23): [f"{landing.root}/2019-08-23.txt"]}
    assert cycle.clean_days(spark, landing.root, store, again, "again") == {dt.date(2019, 8, 23): (1, 0, 0)}
    cycle.drop_days(spark, store.history, again)
    assert not (Path(store.history) / "src_date=2019-08-23").exists()


def test_only_empty_days(spark, landing, tmp_path):
    landing("2019-08-23", None)
    done = clean_cycle(spark, landing.root, Store(str(tmp_path / "store")), START)
    assert done.counts == {dt.date(2019, 8, 23): (0, 0)} and done.watermark == dt.date(2019, 8, 23)


def test_a_repeated_run_changes_nothing(spark, landing, tmp_path):
    fill(landing, ["2019-08-23", "2019-08-24"])
    store = Store(str(tmp_path / "store"))
    paths = {dt.date(2019, 8, d): [f"{landing.root}/2019-08-{d}.txt"] for d in (23, 24)}
    first = cycle.clean_days(spark, landing.root, store, paths, "died_before_the_ledger")
    assert watermark(spark, store) == START
    done = clean_cycle(spark, landing.root, store, START)
    assert done.counts == {day: counted[:2] for day, counted in first.items()}
    assert read_history(spark, store.history).count() == done.n_clean


def test_long_catch_up_is_several_writes(spark, landing, tmp_path, monkeypatch):
    days = days_from("2019-08-23", 4)
    fill(landing, days)
    one = clean_cycle(spark, landing.root, Store(str(tmp_path / "a")), START, take_n=4)
    monkeypatch.setattr(cycle, "WRITE_DAYS", 3)
    several = clean_cycle(spark, landing.root, Store(str(tmp_path / "b")), START, take_n=4)
    assert several.counts == one.counts
    assert read_history(spark, str(tmp_path / "b/history")).count() == one.n_clean


def test_every_layout_of_a_day_is_read(spark, tmp_path):
    root = tmp_path / "landing"
    lines = lambda day, n: "\n".join([HEADER, *(row(i + 1, day) for i in range(n))]) + "\n"
    forms = {"2019-08-23.txt": 1, "2019-08-24/part-0.csv": 2, "src_date=2019-08-25/part-0.csv": 4, "2019-08-26.txt/part-0.csv": 8}
    forms |= {"2019-08-27.txt": 16, "2019-08-27/part-0.csv": 32, "src_date=2019-08-27/part-0.csv": 64}
    for name, n in forms.items():
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(lines(name.removeprefix("src_date=")[:10], n))
    done = clean_cycle(spark, str(root), Store(str(tmp_path / "store")), START, take_n=9)
    assert [kept for _, (_, kept) in sorted(done.counts.items())] == [1, 2, 4, 8, 112]
    assert [raw for _, (raw, _) in sorted(done.counts.items())] == [1, 2, 4, 8, 112]


def test_wide_ids(spark, landing, tmp_path):
    landing("2019-08-23", [row(1, "2019-08-23", customer=str(1 << 40))])
    store = Store(str(tmp_path / "store"))
    assert clean_cycle(spark, landing.root, store, START, schema=wide(RAW)).n_clean == 1
    assert read_history(spark, store.history).first()["customer_id"] == 1 << 40


def test_train_register_and_promote(spark, landing, tmp_path):
    days = days_from("2019-08-23", 3)
    fill(landing, days, 120)
    store = Store(str(tmp_path / "store"))
    clean_cycle(spark, landing.root, store, START)
    run = train_cycle(
        spark, store, last_n=2, model_name="m", split="hash", run_id="run1",
        output=str(tmp_path / "model/"), **SMALL,
    )
    assert run.columns == [
        "tranaction_id", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
        "tx_time_days", "tx_fraud_scenario",
    ]
    assert (run.alias, run.version) == ("champion", 1)
    assert set(run.metrics) == {"auc", "accuracy", "f1"}
    params = {r["key"]: r["value"] for r in store.run_params(spark).collect()}
    assert params["train_last_n"] == "2" and params["features_count"] == "7"
    assert params["numTrees_grid"] == "3,5" and params["maxDepth_grid"] == "2,3"
    assert params["best_numTrees"] == str(run.params["numTrees"]) and params["label_col"] == "tx_fraud"
    assert params["saved_model_path"] == str(tmp_path / "model")
    logged = {r["key"]: r["value"] for r in store.run_metrics(spark).collect()}
    assert logged == run.metrics
    # A stored model scores as the trained one.
    rows = read_history(spark, store.history)
    stored = model.load_model(str(tmp_path / "model")).transform(rows)
    fresh = model.load_model(store.model("run1")).transform(rows)
    keys = ["tranaction_id", "prediction"]
    assert stored.select(*keys).exceptAll(fresh.select(*keys)).isEmpty()
    # The same metrics again are a tie, which does not promote.
    cycle.log_run(spark, store, "run2", {}, run.metrics)
    assert register(spark, store, "m", "run2") == ("challenger", 2)
    better = {**run.metrics, "auc": run.metrics["auc"] + 0.01}
    cycle.log_run(spark, store, "run3", {}, better)
    assert register(spark, store, "m", "run3") == ("champion", 3)
    assert register(spark, store, "other", "run2") == ("champion", 1)
    assert promotions(spark, store, "f1").where("version = 3").first()["alias"] == "challenger"


def test_two_registers_at_once_are_two_versions(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for run in ("r2", "r1"):
        append_table(spark.createDataFrame([("m", run, now)], MODEL_VERSIONS), store.path("model_versions"))
    assert {(r["run_id"], r["version"]) for r in store.versions(spark).collect()} == {("r1", 1), ("r2", 2)}
    assert register(spark, store, "m", "r3") == ("champion", 3)


def test_training_guards(spark, landing, tmp_path):
    store = Store(str(tmp_path / "store"))
    landing("2019-08-23", [row(i, "2019-08-23", fraud="") for i in range(5)])
    clean_cycle(spark, landing.root, store, START)
    with pytest.raises(ValueError, match="no labelled rows"):
        train_cycle(spark, store)
    with pytest.raises(ValueError, match="metric must be"):
        train_cycle(spark, store, metric="loss")


def test_null_feature_fails_unless_skipped(spark):
    rows = spark.range(40).select(
        (F.col("id") % 2).cast("int").alias("tx_fraud"),
        F.when(F.col("id") != 7, F.col("id")).alias("a"),
    )
    assert model.grid_search(rows, ["a"], handle_invalid="skip", **SMALL).avgMetrics
    with pytest.raises(Exception, match="(?i)null|handleInvalid"):
        model.grid_search(rows, ["a"], **SMALL)


def test_forests_and_folds_wait_for_memory(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 2).cast("int").alias("tx_fraud"), (F.col("id") % 7 + F.col("id") % 2).alias("a"))
    lock, growing, most, kept = threading.Lock(), [0], [0], [0]
    fit = model.RandomForestClassifier.fit

    def watched(self, *args):
        with lock:
            growing[0] += 1
            most[0] = max(most[0], growing[0])
            kept[0] = max(kept[0], spark.sparkContext._jsc.getPersistentRDDs().size() - before)
        try:
            return fit(self, *args)
        finally:
            with lock:
                growing[0] -= 1

    monkeypatch.setattr(model.RandomForestClassifier, "fit", watched)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ample = model.grid_search(rows, ["a"], **SMALL)
    assert model.free_storage(spark) > 1 << 20
    monkeypatch.setattr(model, "free_storage", lambda spark: 0)
    growing[0] = most[0] = kept[0] = 0
    tight = model.grid_search(rows, ["a"], **SMALL)
    # The folded rows, the vectors of one fold, and no more than one forest's rows and their sample.
    assert most[0] == 1 and kept[0] <= 5
    assert tight.avgMetrics == ample.avgMetrics and tight.stdMetrics == ample.stdMetrics


def test_run_cycle_trains_even_without_new_files(spark, landing, tmp_path):
    fill(landing, ["2019-08-23"], 120)
    store = Store(str(tmp_path / "store"))
    args = {"start": START, "split": "hash", **SMALL}
    first, trained = cycle.run_cycle(spark, landing.root, store, **args)
    assert first.n_raw == 120 and trained.alias == "champion"
    second, again = cycle.run_cycle(spark, landing.root, store, **args)
    assert second.status == "nothing_found" and again.version == 2
