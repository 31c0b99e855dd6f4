"""One retraining cycle: clean the next days, train on the latest ones, promote."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from dayledger.operators import registry
from dayledger.operators.cleaning import clean, count_columns, with_lineage
from dayledger.operators.features import feature_columns
from dayledger.operators.splits import hash_split, random_split
from dayledger.plans import model as modelling
from dayledger.schema import DAY, LABEL, LEDGER, MODEL_VERSIONS, RAW, RUN_METRICS, RUN_PARAMS
from dayledger.session import sibling_session
from dayledger.sinks import append_table, drop_days, metrics_long, read_table, write_days
from dayledger.sinks.days import AS_READ
from dayledger.sources import (
    latest_entries,
    ledger_watermark,
    list_days,
    next_days,
    read_history,
    read_raw,
    training_set,
)
from dayledger.sources.filesystem import glob
from dayledger.sources.landing import day_glob, require_files, source_files

# Defaults of a cycle.
START = dt.date(2019, 8, 1)
TAKE_N = 3
MAX_SCAN_DAYS = 30

# Days in one write. Each counts its days by aggregates observed on the write, three for each day
# and row; a longer catch-up is more writes, and every file is read once.
WRITE_DAYS = 4
# Such writes at a time.
SIDE_BY_SIDE = 4


@dataclass(frozen=True)
class Store:
    """Paths of everything a cycle keeps, below one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def history(self) -> str:
        return self.path("history")

    def ledger(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("ledger"), LEDGER)

    def begin(self, spark: SparkSession) -> int:
        """What a run has seen when it begins; `record` takes it back."""
        return 0

    def stale_days(self, spark: SparkSession, landing: str, after: dt.date) -> list[dt.date]:
        """Days already passed whose files are new or changed; only a committed store knows them."""
        raise ValueError("a plain store does not know which files it has read; use a CommittedStore")

    def write(self, rows: DataFrame, write_id: str) -> None:
        """Write cleaned rows of some days; what other days hold stays."""
        write_days(rows, self.history, AS_READ)

    def record(
        self, spark: SparkSession, entries: list[tuple], write_id: str, begun: int, sources: DataFrame
    ) -> list[dt.date]:
        """Enter the written days in the ledger; returns those that count."""
        drop_days(spark, self.history, [e[0] for e in entries if not e[4]])
        append_table(spark.createDataFrame(entries, LEDGER).coalesce(1), self.path("ledger"))
        return [e[0] for e in entries]

    def day_rows(self, spark: SparkSession, days: list[dt.date]) -> DataFrame:
        """Cleaned rows of days that have some."""
        return read_history(spark, self.history, days)

    def training_rows(self, spark: SparkSession, last_n: int | None = None) -> DataFrame:
        """Labelled rows of the latest days, or of all."""
        ledger = self.ledger(spark)
        # A history that only a stream has written has no ledger; its folders name its days.
        return training_set(spark, self.history, last_n, None if ledger.isEmpty() else ledger)

    def run_params(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("run_params"), RUN_PARAMS)

    def run_metrics(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("run_metrics"), RUN_METRICS)

    def versions(self, spark: SparkSession) -> DataFrame:
        return registry.model_versions(read_table(spark, self.path("model_versions"), MODEL_VERSIONS))

    def model(self, run_id: str) -> str:
        return self.path(f"models/{run_id}")


@dataclass(frozen=True)
class Cleaned:
    """What a cleaning run did. No days means that no new file was found, or that another run
    committed all of them first."""

    run_id: str
    watermark: dt.date
    counts: dict[dt.date, tuple[int, int]] = field(default_factory=dict)
    superseded: tuple[dt.date, ...] = ()

    @property
    def status(self) -> str:
        return "cleaned" if self.counts else "superseded" if self.superseded else "nothing_found"

    @property
    def n_raw(self) -> int:
        return sum(raw for raw, _ in self.counts.values())

    @property
    def n_clean(self) -> int:
        return sum(kept for _, kept in self.counts.values())


@dataclass(frozen=True)
class Trained:
    run_id: str
    columns: list[str]
    metrics: dict[str, float]
    params: dict[str, int]
    search: CrossValidatorModel
    alias: str | None = None
    version: int | None = None

    @property
    def model(self) -> PipelineModel:
        return self.search.bestModel


def stamped(prefix: str, now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{prefix}_{now:%Y%m%d_%H%M%S}"


def clean_cycle(
    spark: SparkSession,
    landing: str,
    store: Store,
    start: dt.date = START,
    take_n: int = TAKE_N,
    max_scan_days: int = MAX_SCAN_DAYS,
    run_id: str | None = None,
    drop_nan: bool = False,
    schema: StructType = RAW,
    reconcile: bool = False,
) -> Cleaned:
    """Clean the next `take_n` existing days after the watermark.

    The watermark is exclusive and starts at `start`. It moves to the last found day, so
    gaps are skipped and a file that shows up later for a passed day is not read, unless
    `reconcile` is set: then passed days with new or changed files are cleaned again as well,
    which takes a store that knows the files it has read. The watermark moves only after every
    day is written: a run that dies is repeated and overwrites its days.
    """
    run_id = run_id or stamped("clean")
    # Where run ids repeat, as they do in a rerun, what they write still is not the same.
    write_id = f"{run_id}_{uuid.uuid4().hex[:8]}"
    begun = store.begin(spark)
    after = ledger_watermark(store.ledger(spark), start).first()[DAY]
    window = [after + dt.timedelta(days=i) for i in range(1, max_scan_days + 1)]
    listing = list_days(spark, landing, window)
    found = {r[DAY]: r for r in next_days(listing, after, take_n, max_scan_days).collect()}
    stale = store.stale_days(spark, landing, start) if reconcile else []
    if stale:
        found |= {r[DAY]: r for r in list_days(spark, landing, stale).collect()}
    if not found:
        return Cleaned(run_id, after)
    # Listed before they are read: a file that changes meanwhile differs from this list later.
    sources = source_files(spark, landing, sorted(found))
    paths = {day: entry["paths"] for day, entry in found.items()}
    counts = clean_days(spark, landing, store, paths, run_id, drop_nan, schema, write_id)
    # Timezone-aware, so the session zone does not shift the stored instant.
    now = dt.datetime.now(dt.timezone.utc)
    entries = [
        (d, found[d]["source_key"], run_id, *counted, now) for d, counted in counts.items()
    ]
    recorded = store.record(spark, entries, write_id, begun, sources)
    kept = {d: counts[d][:2] for d in recorded}
    return Cleaned(run_id, max(after, *found), kept, tuple(sorted(set(found) - set(recorded))))


def clean_days(
    spark: SparkSession,
    landing: str,
    store: Store,
    paths: dict[dt.date, list[str]],
    run_id: str,
    drop_nan: bool = False,
    schema: StructType = RAW,
    write_id: str | None = None,
) -> dict[dt.date, tuple[int, int, int]]:
    """Write the days found at `paths`, a few in each scan; returns the raw, clean and clean labelled
    rows of each.

    The write has no shuffle, so the observed counts come from its final tasks, whose
    updates Spark counts once even when lost executors make it run some of them again.
    Scans run side by side, as a few days seldom fill a cluster.
    """
    session = sibling_session(spark)
    sizes = dict(glob(session, day_glob(landing, paths)))

    def clean_group(group: list[dt.date]) -> dict[dt.date, tuple[int, int, int]]:
        files = [path for day in group for path in paths[day]]
        rows = read_raw(session, files, schema, base=landing)
        require_files(rows, {file: sizes.get(file, 0) for file in files})
        seen = Observation()
        source = rows.observe(seen, *count_columns(group, drop_nan))
        store.write(with_lineage(clean(source, drop_nan), run_id), write_id or run_id)
        counted = seen.get
        return {d: tuple(counted.get(f"{kind}_{d}") or 0 for kind in ("raw", "clean", "labelled")) for d in group}

    days = sorted(paths)
    groups = [days[at : at + WRITE_DAYS] for at in range(0, len(days), WRITE_DAYS)]
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        found = list(pool.map(inheritable_thread_target(session)(clean_group), groups))
    return {day: counted for group in found for day, counted in group.items()}


def train_cycle(
    spark: SparkSession,
    store: Store,
    last_n: int | None = None,
    model_name: str | None = None,
    metric: str = "auc",
    exclude: tuple[str, ...] = (),
    split: str = "random",
    split_key: str = "tranaction_id",
    run_id: str | None = None,
    output: str | None = None,
    **search,
) -> Trained:
    """Train on the latest days, log and save the run, and register it if named.

    `split="random"` is Spark's 80/20 split; `"hash"` splits on the key and gives the same
    test rows on any cluster.
    """
    if metric not in modelling.METRICS:
        raise ValueError(f"metric must be one of {modelling.METRICS}")
    # Two runs may start in one second; the suffix keeps their metrics and models apart.
    run_id = run_id or f"{stamped('fraud_rf')}_{uuid.uuid4().hex[:8]}"
    rows = store.training_rows(spark, last_n)
    columns = feature_columns(rows, LABEL, exclude)
    if not columns:
        raise ValueError("no numeric feature column")
    kept = dict.fromkeys([LABEL, *columns, *([split_key] if split == "hash" else [])])
    data = rows.select(*kept).persist()
    try:
        if data.isEmpty():
            raise ValueError("no labelled rows to train on")
        train, test = hash_split(data, split_key) if split == "hash" else random_split(data)
        searched = modelling.grid_search(train, columns, **search)
        metrics = modelling.evaluate(searched.bestModel.transform(test))
    finally:
        data.unpersist()
    params = modelling.best_params(searched.bestModel)
    modelling.save_model(searched.bestModel, store.model(run_id))
    logged = {
        "label_col": LABEL,
        "features_count": len(columns),
        "numTrees_grid": ",".join(map(str, search.get("num_trees", modelling.NUM_TREES))),
        "maxDepth_grid": ",".join(map(str, search.get("max_depth", modelling.MAX_DEPTH))),
        **({"train_last_n": last_n} if last_n else {}),
        **{f"best_{name}": value for name, value in params.items()},
    }
    if output:
        modelling.save_model(searched.bestModel, output.rstrip("/"))
        logged["saved_model_path"] = output.rstrip("/")
    log_run(spark, store, run_id, logged, metrics)
    alias, version = register(spark, store, model_name, run_id, metric) if model_name else (None, None)
    return Trained(run_id, columns, metrics, params, searched, alias, version)


def log_run(
    spark: SparkSession, store: Store, run_id: str, params: dict, metrics: dict[str, float]
) -> None:
    """Append the parameters and metrics of one run."""
    texts = [(run_id, key, str(value)) for key, value in params.items()]
    append_table(spark.createDataFrame(texts, RUN_PARAMS).coalesce(1), store.path("run_params"))
    wide = spark.createDataFrame([(run_id, *metrics.values())], ["run_id", *metrics])
    long = metrics_long(wide, list(metrics)).withColumn("log_ts", F.current_timestamp())
    append_table(long.coalesce(1), store.path("run_metrics"))


def register(
    spark: SparkSession, store: Store, model_name: str, run_id: str, metric: str = "auc"
) -> tuple[str, int]:
    """Add the run as the next version of the model; returns its alias and version.

    Only the run and its time are stored, so two runs that register at once get two versions.
    """
    now = dt.datetime.now(dt.timezone.utc)
    entry = [(model_name, run_id, now)]
    append_table(
        spark.createDataFrame(entry, MODEL_VERSIONS).coalesce(1), store.path("model_versions")
    )
    own = (F.col("model_name") == model_name) & (F.col("run_id") == run_id) & (F.col("run_ts") == F.lit(now))
    decided = promotions(spark, store, metric).where(own).first()
    return decided["alias"], decided["version"]


def promotions(spark: SparkSession, store: Store, metric: str = "auc") -> DataFrame:
    """The champion / challenger history of every registered model."""
    with_values = registry.with_metric(store.versions(spark), store.run_metrics(spark), metric)
    return registry.champion_history(with_values)


def run_cycle(
    spark: SparkSession,
    landing: str,
    store: Store,
    start: dt.date = START,
    take_n: int = 1,
    max_scan_days: int = 365,
    last_n: int | None = 5,
    model_name: str = "fraud_model",
    **train,
) -> tuple[Cleaned, Trained]:
    """Clean, then train on the latest days, as one cycle of a schedule does.

    Training runs even when no new file was found.
    """
    cleaned = clean_cycle(spark, landing, store, start, take_n, max_scan_days)
    return cleaned, train_cycle(spark, store, last_n, model_name, **train)


def training_growth(ledger: DataFrame, last_n: int = 5) -> DataFrame:
    """Training rows, which are the labelled ones, that each cycle sees while days accumulate.

    One cycle per day. Sorts one row per day, not the data. An entry from before labelled rows
    were counted stands with its clean ones.
    """
    window = Window.orderBy(DAY).rowsBetween(1 - last_n, 0)
    return latest_entries(ledger).select(DAY, F.sum(F.coalesce("n_labelled", "n_clean")).over(window).alias("train_rows"))
