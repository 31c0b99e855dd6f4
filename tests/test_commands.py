from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from conftest import days_from, row
from dayledger import CommittedStore
from dayledger.__main__ import parser, run
from dayledger.plans.cycle import Store
from dayledger.sources import read_history


def call(spark, *argv):
    run(spark, parser().parse_args([str(a) for a in argv]))


def test_clean_and_stream_commands(spark, landing, tmp_path, capsys):
    for number, day in enumerate(days_from("2019-08-23", 3)):
        landing(day, [row(number * 10 + i, day) for i in range(5)])
    store = tmp_path / "store"
    call(spark, "clean", landing.root, store, "--start-date", "2019-08-22", "--take-n", "2")
    call(spark, "clean", landing.root, store, "--start-date", "2019-08-22", "--take-n", "2")
    call(spark, "clean", landing.root, store, "--start-date", "2019-08-22")
    printed = capsys.readouterr().out.splitlines()
    assert printed[0] == "cleaned: 10 -> 10 rows, watermark 2019-08-24"
    assert printed[1] == "cleaned: 5 -> 5 rows, watermark 2019-08-25"
    assert printed[2] == "nothing_found: 0 -> 0 rows, watermark 2019-08-25"
    call(spark, "stream", landing.root, tmp_path / "streamed", tmp_path / "cursor")
    streamed = read_history(spark, str(tmp_path / "streamed")).select("tranaction_id")
    batch = read_history(spark, Store(str(store)).history).select("tranaction_id")
    assert streamed.exceptAll(batch).isEmpty() and streamed.count() == 15


def test_commands_on_a_committed_store(spark, landing, tmp_path, capsys):
    for number, day in enumerate(days_from("2019-08-23", 2)):
        landing(day, [row(number * 10 + i, day) for i in range(5)])
    store = tmp_path / "store"
    clean = ("clean", landing.root, store, "--start-date", "2019-08-22", "--committed")
    call(spark, *clean)
    landing("2019-08-23", [row(50 + i, "2019-08-23") for i in range(3)])
    call(spark, *clean)
    call(spark, *clean, "--reconcile")
    call(spark, "stream", landing.root, store, tmp_path / "cursor", "--committed", "--files-per-trigger", "1")
    call(spark, "compact", store)
    printed = capsys.readouterr().out.splitlines()
    assert printed == [
        "cleaned: 10 -> 10 rows, watermark 2019-08-24", "nothing_found: 0 -> 0 rows, watermark 2019-08-24",
        "cleaned: 3 -> 3 rows, watermark 2019-08-24", "2 days compacted",
    ]
    assert CommittedStore(str(store)).rows(spark).count() == 16


def test_demo_command(spark, tmp_path, capsys):
    call(spark, "demo", tmp_path, "--rows", "1000")
    assert capsys.readouterr().out.strip() == "1000 rows, 50 fraudulent (5.00%)"
    train, test = (spark.read.option("header", True).csv(f"{tmp_path}/{part}") for part in ("train", "test"))
    assert (train.count(), test.count()) == (800, 200)
    assert train.select("transaction_id").union(test.select("transaction_id")).distinct().count() == 1000
    assert len(train.columns) == 13


def test_options_match_the_defaults():
    args = parser().parse_args(["clean", "l", "s"])
    assert (args.take_n, args.max_scan_days, str(args.start_date)) == (3, 30, "2019-08-01")
    args = parser().parse_args(["cycle", "l", "s"])
    assert (args.take_n, args.max_scan_days, args.model_name) == (1, 365, "fraud_model")
    assert (args.last_n, args.promote_metric, args.split) == (5, "auc", "random")


def test_starts_by_its_path_from_any_folder(tmp_path):
    script = Path(__file__).resolve().parents[1] / "dayledger" / "__main__.py"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), "--help"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "cycle" in done.stdout
