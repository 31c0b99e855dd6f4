"""Commits, two writers, stale days, streamed commits and compaction."""

from __future__ import annotations

import datetime as dt
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, days_from, row
from dayledger import CommittedStore, Store, clean_cycle, compact_days, drop_unreferenced, stream_ingest, train_cycle
from dayledger.operators.cleaning import clean
from dayledger.plans import cycle
from dayledger.schema import DAY, RAW
from dayledger.sinks.commits import Commits
from dayledger.sources import read_raw
from dayledger.sources.filesystem import write_new
from dayledger.sources.landing import changed_days, source_files

START = dt.date(2019, 8, 22)


def fill(landing, days, n=30):
    for number, day in enumerate(days):
        landing(day, [row(number * 1000 + i, day, amount=str(i % 9), terminal=str(1 + i % 3)) for i in range(n)])


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*RAW.names, DAY).collect())


def expected(spark, landing):
    return rows_of(clean(read_raw(spark, landing.root)))


def days_of(ledger):
    return sorted(str(r[DAY]) for r in ledger.collect())


def test_a_file_is_made_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert write_new(spark, path, "a\nb") and not write_new(spark, path, "c")
    assert Path(path).read_text() == "a\nb"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["1.json"]
    with pytest.raises(Exception, match="file_in_the_way|Not a directory|not a directory|Parent path"):
        (tmp_path / "file_in_the_way").write_text("")
        write_new(spark, str(tmp_path / "file_in_the_way" / "x"), "a")


def test_many_writers_lose_no_change(spark, tmp_path):
    log = Commits(str(tmp_path / "commits"))
    days = [dt.date(2024, 1, 1 + i) for i in range(12)]

    def enter(day):
        def change(state, version):
            return state | {day: {"src_date": day, "version": version, "folders": [str(day)]}}

        log.commit(spark, change)

    threads = [threading.Thread(target=enter, args=(day,)) for day in days]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert log.versions(spark) == list(range(1, 13))
    found = log.read(spark).collect()
    assert [r["src_date"] for r in found] == days and sorted(r["version"] for r in found) == list(range(1, 13))
    assert log.changes(spark).count() == 12
    assert log.commit(spark, lambda state, version: None) is None and log.newest(spark) == 12


def test_committed_cycles_equal_plain_ones(spark, landing, tmp_path):
    fill(landing, [d for d in days_from("2019-08-23", 9) if d != "2019-08-27"])
    landing("2019-08-27", None)
    plain, store = Store(str(tmp_path / "plain")), CommittedStore(str(tmp_path / "store"))
    while clean_cycle(spark, landing.root, plain, START, take_n=4, run_id="r").counts:
        done = clean_cycle(spark, landing.root, store, START, take_n=4, run_id="r")
        assert done.status == "cleaned"
    ledger = lambda s: sorted(map(tuple, s.ledger(spark).drop("ingest_ts").collect()))
    assert ledger(store) == ledger(plain) and store.commits.newest(spark) == 3
    assert rows_of(store.rows(spark)) == expected(spark, landing)
    assert rows_of(store.training_rows(spark, 5)) == rows_of(plain.training_rows(spark, 5))
    assert clean_cycle(spark, landing.root, store, START).status == "nothing_found"
    run = train_cycle(spark, store, 3, "m", split="hash", num_trees=(2,), max_depth=(2,))
    assert run.alias == "champion" and "run" not in run.columns


class Interrupted(CommittedStore):
    """Runs something between the write and the commit."""

    def record(self, spark, entries, write_id, begun, sources):
        self.between[0]()
        return super().record(spark, entries, write_id, begun, sources)


def test_two_interleaved_cycles_give_each_day_once(spark, landing, tmp_path):
    fill(landing, days_from("2019-08-23", 6))
    root = str(tmp_path / "store")
    store, slow = CommittedStore(root), Interrupted(root)
    object.__setattr__(slow, "between", [lambda: clean_cycle(spark, landing.root, store, START, take_n=2, run_id="fast")])
    done = clean_cycle(spark, landing.root, slow, START, take_n=5, run_id="slow")
    assert sorted(map(str, done.counts)) == days_from("2019-08-25", 3) and list(map(str, done.superseded)) == days_from("2019-08-23", 2)
    assert days_of(store.ledger(spark)) == days_from("2019-08-23", 5)
    assert {r["run_id"]: r["n"] for r in store.ledger(spark).groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"fast": 2, "slow": 3}
    ids = [r["tranaction_id"] for r in store.rows(spark).collect()]
    assert len(ids) == len(set(ids)) == sum(r["n_clean"] for r in store.ledger(spark).collect())
    object.__setattr__(slow, "between", [lambda: clean_cycle(spark, landing.root, store, START, run_id="fast")])
    done = clean_cycle(spark, landing.root, slow, START, run_id="slow")
    assert done.status == "superseded" and not done.counts
    assert rows_of(store.rows(spark)) == expected(spark, landing)


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, landing, tmp_path):
    fill(landing, days_from("2019-08-23", 4))
    store = CommittedStore(str(tmp_path / "store"))
    clean_cycle(spark, landing.root, store, START, take_n=2)
    before = rows_of(store.rows(spark))

    def die():
        raise KeyboardInterrupt

    slow = Interrupted(store.root)
    object.__setattr__(slow, "between", [die])
    with pytest.raises(KeyboardInterrupt):
        clean_cycle(spark, landing.root, slow, START, take_n=2)
    assert rows_of(store.rows(spark)) == before and days_of(store.ledger(spark)) == days_from("2019-08-23", 2)
    assert drop_unreferenced(spark, store) == []
    gone = drop_unreferenced(spark, store, older_than=dt.timedelta(0))
    assert [folder.split("/")[0] for folder in gone] == ["src_date=2019-08-25", "src_date=2019-08-26"]
    clean_cycle(spark, landing.root, store, START, take_n=2)
    assert rows_of(store.rows(spark)) == expected(spark, landing)


def test_late_and_changed_days_are_reconciled(spark, landing, tmp_path):
    days = days_from("2019-08-23", 6)
    fill(landing, [d for d in days if d != "2019-08-25"])
    store = CommittedStore(str(tmp_path / "store"))
    clean_cycle(spark, landing.root, store, START, take_n=9)
    listing = lambda: changed_days(source_files(spark, landing.root), store.commits.read(spark), START)
    assert listing().count() == 0
    assert clean_cycle(spark, landing.root, store, START, reconcile=True).status == "nothing_found"
    landing("2019-08-25", [row(900, "2019-08-25")])
    landing("2019-08-24", [row(901, "2019-08-24"), row(902, "2019-08-24")])
    landing("2019-08-21", [row(903, "2019-08-21")])  # before the start
    landing("2019-08-30", [row(904, "2019-08-30")])  # ahead of the watermark: the next cycle's
    extra = Path(landing.root) / "src_date=2019-08-27"
    extra.mkdir()
    (extra / "part-0.csv").write_text(f"{HEADER}\n{row(905, '2019-08-27')}\n")
    (extra / "_SUCCESS").write_text("")
    found = {str(r[DAY]): (r["status"], r["n_changed"]) for r in listing().collect()}
    assert found == {"2019-08-24": ("changed", 1), "2019-08-25": ("late", 1), "2019-08-27": ("changed", 1)}
    (Path(landing.root) / "2019-08-23.txt").unlink()  # tidied up, not changed
    kept = [r for r in rows_of(store.rows(spark)) if str(r[-1]) == "2019-08-23"]
    done = clean_cycle(spark, landing.root, store, START, take_n=1, reconcile=True)
    assert sorted(map(str, done.counts)) == ["2019-08-24", "2019-08-25", "2019-08-27", "2019-08-30"]
    assert done.watermark == dt.date(2019, 8, 30) and listing().count() == 0
    want = sorted(kept + [r for r in expected(spark, landing) if str(r[-1]) != "2019-08-21"])
    assert rows_of(store.rows(spark)) == want
    with pytest.raises(ValueError, match="CommittedStore"):
        clean_cycle(spark, landing.root, Store(str(tmp_path / "plain")), START, reconcile=True)


def test_a_day_that_lost_its_rows_is_empty(spark, landing, tmp_path):
    fill(landing, days_from("2019-08-23", 2))
    store = CommittedStore(str(tmp_path / "store"))
    clean_cycle(spark, landing.root, store, START)
    landing("2019-08-24", None)
    clean_cycle(spark, landing.root, store, START, reconcile=True)
    assert {str(r[0]) for r in store.rows(spark).select(DAY).distinct().collect()} == {"2019-08-23"}
    assert {str(r[DAY]): r["n_clean"] > 0 for r in store.ledger(spark).collect()} == {"2019-08-23": True, "2019-08-24": False}
    with pytest.raises(ValueError, match="no day"):
        CommittedStore(str(tmp_path / "none")).rows(spark)


def drain(spark, landing, store, cursor, files=1):
    stream_ingest(spark, landing.root, store, str(cursor), files_per_trigger=files).awaitTermination()


def test_streamed_commits_and_compaction(spark, landing, tmp_path):
    days = days_from("2019-08-23", 3)
    fill(landing, days)
    for number, day in enumerate(days):
        for part in range(5):
            folder = Path(landing.root) / day
            folder.mkdir(exist_ok=True)
            (folder / f"part-{part}.csv").write_text(f"{HEADER}\n{row(100_000 + number * 10 + part, day)}\n")
    store = CommittedStore(str(tmp_path / "store"))
    drain(spark, landing, store, tmp_path / "cursor", files=2)
    assert rows_of(store.rows(spark)) == expected(spark, landing)
    assert {str(r[DAY]): r["n_clean"] for r in store.ledger(spark).collect()} == {d: len([r for r in expected(spark, landing) if str(r[-1]) == d]) for d in days}
    before = store.begin(spark)
    old = store.rows(spark)  # a reader that has begun
    assert compact_days(spark, store, file_bytes=1) and not compact_days(spark, store, file_bytes=1)
    state = store.commits.state(spark, store.begin(spark))
    for entry in state.values():
        files = [f for folder in entry["folders"] for f in Path(store.history, folder).glob("*.parquet")]
        assert len(entry["folders"]) == 1 and 1 <= len(files) <= 4
    assert rows_of(store.rows(spark)) == rows_of(old) == rows_of(store.rows(spark, version=before)) == expected(spark, landing)
    # The last batch again, as after a crash between its commit and the checkpoint's.
    newest = max((tmp_path / "cursor" / "commits").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
    newest.unlink()
    for crc in (tmp_path / "cursor" / "commits").glob(f".{newest.name}.crc"):
        crc.unlink()
    drain(spark, landing, store, tmp_path / "cursor", files=2)
    assert rows_of(store.rows(spark)) == expected(spark, landing)
    landing("2019-08-20", [row(5, "2019-08-20")])
    drain(spark, landing, store, tmp_path / "cursor")
    assert rows_of(store.rows(spark)) == expected(spark, landing)
    compact_days(spark, store, max_files=1)
    assert rows_of(store.rows(spark)) == expected(spark, landing)


def test_compaction_leaves_days_that_change_meanwhile(spark, landing, tmp_path, monkeypatch):
    fill(landing, days_from("2019-08-23", 2))
    store = CommittedStore(str(tmp_path / "store"))
    monkeypatch.setattr(cycle, "WRITE_DAYS", 1)
    clean_cycle(spark, landing.root, store, START)
    for day in days_from("2019-08-23", 2):
        (Path(landing.root) / day).mkdir()
        for part in range(3):
            (Path(landing.root) / day / f"p{part}.csv").write_text(f"{HEADER}\n{row(700 + part, day)}\n")
    clean_cycle(spark, landing.root, store, START, reconcile=True)

    class Busy(CommittedStore):
        def read_folders(self, spark, folders):
            if not done:
                done.append(True)
                landing("2019-08-23", [row(1, "2019-08-23")])
                clean_cycle(spark, landing.root, store, START, reconcile=True)
            return super().read_folders(spark, folders)

    done: list[bool] = []
    assert list(map(str, compact_days(spark, Busy(store.root), max_files=1))) == ["2019-08-24"]
    assert rows_of(store.rows(spark)) == expected(spark, landing)
