"""A store that several runs may write to: committed days, stale days, compaction."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.plans.cycle import Store
from dayledger.schema import DAY, LABEL, LEDGER, RUN
from dayledger.sinks.commits import Commits, State
from dayledger.sinks.days import AS_READ, write_days
from dayledger.sources.filesystem import delete, files_at, glob
from dayledger.sources.history import labelled
from dayledger.sources.landing import changed_days, source_files

# Files of a day after compaction, and the size from which a day gets one more.
MAX_FILES = 4
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class CommittedStore(Store):
    """The days of the history are those that the newest manifest names, in the folders it names.

    Every run writes `src_date=D/run=R` folders of its own, so no run touches what another wrote or
    what someone reads. Of two runs that clean the same days at once the one that commits first
    counts, and the other's folders are never part of the history; `drop_unreferenced` removes them.
    The ledger is part of the manifest. Run, metric and version tables are those of a plain store.
    """

    @property
    def commits(self) -> Commits:
        return Commits(self.path("commits"))

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self.commits.read(spark).select(*LEDGER.names)

    def begin(self, spark: SparkSession) -> int:
        return self.commits.newest(spark)

    def stale_days(self, spark: SparkSession, landing: str, after: dt.date) -> list[dt.date]:
        return [r[DAY] for r in self.changed_days(spark, landing, after).select(DAY).collect()]

    def changed_days(self, spark: SparkSession, landing: str, after: dt.date | None = None) -> DataFrame:
        """Late and changed days of the landing area among those already passed."""
        return changed_days(source_files(spark, landing), self.commits.read(spark), after)

    def write(self, rows: DataFrame, write_id: str) -> None:
        write_days(rows.withColumn(RUN, F.lit(write_id)), self.history, AS_READ, (DAY, RUN))

    def record(
        self, spark: SparkSession, entries: list[tuple], write_id: str, begun: int, sources: DataFrame
    ) -> list[dt.date]:
        """Commit the written days but for those that another run has committed since `begun`."""
        files: dict[dt.date, list[dict]] = {}
        for r in sources.collect():  # one row for each landing file of the days just read
            files.setdefault(r[DAY], []).append({"path": r["path"], "n_bytes": r["n_bytes"], "modified": r["modified"]})
        recorded: list[dt.date] = []

        def change(state: State, version: int) -> State | None:
            recorded.clear()
            for entry in entries:
                row = dict(zip(LEDGER.names, entry, strict=True))
                day = row[DAY]
                if day in state and state[day]["version"] > begun:
                    continue
                folders = [f"{DAY}={day}/{RUN}={write_id}"] if row["n_clean"] else []
                state[day] = row | {"version": version, "folders": folders, "sources": files.get(day, []), "streams": {}}
                recorded.append(day)
            return state if recorded else None

        self.commits.commit(spark, change)
        return recorded

    def append(self, spark: SparkSession, rows: DataFrame, run_id: str, stream: str, batch_id: int) -> list[dt.date]:
        """Write a batch of a stream and commit it beside what its days hold already.

        A batch that comes again after it was committed, even if its days were compacted since, is
        left out; `stream` must be the name of one checkpoint, as batches of another start anew.
        """
        state = self.commits.state(spark, self.begin(spark))
        if any((entry["streams"] or {}).get(stream, -1) >= batch_id for entry in state.values()):
            return []
        write_id = f"{run_id}_{stream}"
        self.write(rows, write_id)
        found = [path.rsplit("/", 2)[-2:] for path, _ in glob(spark, f"{self.history}/{DAY}=*/{RUN}={write_id}")]
        if not found:
            return []
        rows = self.read_folders(spark, ["/".join(parts) for parts in found])
        counted = rows.groupBy(DAY).agg(F.count("*").alias("n"), F.count(LABEL).alias("labelled")).collect()
        now = dt.datetime.now(dt.timezone.utc)
        added: list[dt.date] = []

        def change(state: State, version: int) -> State | None:
            added.clear()
            for r in counted:  # one row for each day of the run
                day, folder = r[DAY], f"{DAY}={r[DAY]}/{RUN}={write_id}"
                fresh = {"source_key": f"{day}.txt", "n_raw": None, "n_clean": 0, "n_labelled": 0, "folders": [], "sources": [], "streams": {}}
                old = state.get(day, fresh)
                state[day] = old | {
                    DAY: day, "run_id": run_id, "ingest_ts": now, "version": version, "folders": [*old["folders"], folder],
                    "n_clean": old["n_clean"] + r["n"], "n_labelled": (old["n_labelled"] or 0) + r["labelled"],
                    "streams": (old["streams"] or {}) | {stream: batch_id},
                }
                added.append(day)
            return state if added else None

        self.commits.commit(spark, change)
        return added

    def read_folders(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        rows = spark.read.option("basePath", self.history).parquet(*(f"{self.history}/{folder}" for folder in folders))
        return rows.drop(RUN)

    def rows(self, spark: SparkSession, last_n: int | None = None, version: int | None = None) -> DataFrame:
        """Cleaned rows of the latest `last_n` days, or of all, as one manifest has them."""
        manifest = self.commits.read(spark, version).select(DAY, "folders")
        if last_n:
            manifest = manifest.orderBy(F.desc(DAY)).limit(last_n)
        folders = sorted(folder for r in manifest.collect() for folder in r["folders"])  # a few for each day
        if not folders:
            raise ValueError(f"no day with rows under {self.root}")
        return self.read_folders(spark, folders)

    def day_rows(self, spark: SparkSession, days: list[dt.date]) -> DataFrame:
        state = self.commits.state(spark, self.begin(spark))
        return self.read_folders(spark, [folder for day in days for folder in state[day]["folders"]])

    def training_rows(self, spark: SparkSession, last_n: int | None = None) -> DataFrame:
        if last_n is not None and last_n < 0:
            raise ValueError("last_n must not be negative")
        return labelled(self.rows(spark, last_n))


def compact_days(
    spark: SparkSession,
    store: CommittedStore,
    max_files: int = MAX_FILES,
    file_bytes: int = FILE_BYTES,
    salt_by: str = "tranaction_id",
) -> list[dt.date]:
    """Rewrite days of more files than their size asks for; returns the days that were swapped in.

    A day gets a file for every `file_bytes`, at most `max_files`. The rows go to folders of their
    own, and one commit names those instead: a reader sees either state, with the same rows. A day
    that another run changes meanwhile stays as that run left it.
    """
    state = store.commits.state(spark, store.begin(spark))
    day_of = {folder: day for day, entry in state.items() for folder in entry["folders"]}
    sizes: dict[dt.date, list[int]] = {}
    for path, n_bytes, _ in files_at(spark, f"{store.history}/{DAY}=*/{RUN}=*/*.parquet"):
        day = day_of.get("/".join(path.split("/")[-3:-1]))
        if day:
            sizes.setdefault(day, []).append(n_bytes)
    wanted = {day: min(max(1, -(-sum(files) // file_bytes)), max_files) for day, files in sizes.items()}
    wanted = {day: n for day, n in wanted.items() if len(sizes[day]) > n}
    if not wanted:
        return []
    run_id = f"compact_{uuid.uuid4().hex}"
    rows = store.read_folders(spark, [folder for folder, day in day_of.items() if day in wanted])
    files = spark.createDataFrame(list(wanted.items()), f"{DAY} date, _files int")
    # One row per day.
    salted = rows.join(F.broadcast(files), DAY).withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.col("_files")))
    dealt = salted.repartition(DAY, "_salt").drop("_files", "_salt").withColumn(RUN, F.lit(run_id))
    write_days(dealt, store.history, AS_READ, (DAY, RUN))
    swapped: list[dt.date] = []

    def change(now: State, version: int) -> State | None:
        swapped.clear()
        for day in sorted(wanted):
            if day in now and now[day]["folders"] == state[day]["folders"]:
                now[day] |= {"version": version, "folders": [f"{DAY}={day}/{RUN}={run_id}"]}
                swapped.append(day)
        return now if swapped else None

    store.commits.commit(spark, change)
    return swapped


def drop_unreferenced(spark: SparkSession, store: CommittedStore, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove the folders that none of the last `keep` manifests names; returns them.

    Files younger than `older_than` may belong to a run that has yet to commit, so their folders stay.
    """
    named = {
        folder for version in store.commits.versions(spark)[-keep:] for entry in store.commits.state(spark, version).values() for folder in entry["folders"]
    }
    newest: dict[str, int] = {}
    for path, _, modified in files_at(spark, f"{store.history}/{DAY}=*/{RUN}=*/*"):
        folder = "/".join(path.split("/")[-3:-1])
        newest[folder] = max(newest.get(folder, 0), modified)
    before = (time.time() - older_than.total_seconds()) * 1000
    gone = sorted(folder for folder, modified in newest.items() if folder not in named and modified <= before)
    for folder in gone:
        delete(spark, f"{store.history}/{folder}")
    return gone
