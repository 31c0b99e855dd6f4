"""Every operator as a query over the given tables.

The `events` table is read as a stream of card transactions: `transactions` maps it to
the raw layout, with nulls, zero ids and negative amounts mixed in.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayledger import functions as fn
from dayledger.operators import features, metrics, moments, registry, splits, synthesis
from dayledger.operators.cleaning import clean, clean_counts, with_lineage
from dayledger.operators.positions import with_shuffled_position
from dayledger.plans import cycle, model, windows
from dayledger.plans.committed import CommittedStore, compact_days
from dayledger.schema import (
    DAY,
    LABEL,
    MODEL_VERSIONS,
    RAW,
    RUN_ID,
    RUN_METRICS,
    SOURCE_FILE,
    SOURCE_KEY,
)
from dayledger.session import scratch_path
from dayledger.sinks import append_table, metrics_long, read_table, write_csv, write_days
from dayledger.sources import (
    calendar,
    changed_days,
    labelled,
    latest_days,
    ledger_watermark,
    list_days,
    next_days,
    parse_watermark,
    read_history,
    read_raw,
    scan_history,
    source_exists,
    source_files,
    training_set,
)
from dayledger.sources.filesystem import files_at, glob, rename
from dayledger.sources.rejected import rejected_cells as cells_not_read
from dayledger.streaming import stream_ingest as start_stream
from dayledger.streaming import stream_promotions as start_promotions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "tranaction_id"
EPOCH = dt.date(2024, 1, 1)
START = dt.date(2023, 12, 31)
SCAN_DAYS = 366
LAST_N = 5
RUN = "clean_20240131_000000"
# 2024-01-05 is a Friday, so a feed that rests at weekends leaves a gap after it.
WATERMARK = dt.date(2024, 1, 5)
CALENDAR_DAYS = 40


def query(key: str) -> Callable[[Query], Query]:
    """Register a query; its session runs in UTC."""

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        QUERIES[key] = run
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    event_id = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    error = F.col("event_type") == "error"
    return events.select(
        event_id.cast("int").alias(KEY),
        F.when(event_id % 13 != 0, F.date_trunc("second", ts)).alias("tx_datetime"),
        F.col("user_id").cast("int").alias("customer_id"),
        (event_id % 11).cast("int").alias("terminal_id"),
        F.when(event_id % 17 == 0, -F.col("value")).otherwise(F.col("value")).alias("tx_amount"),
        (F.unix_timestamp(ts) - F.unix_timestamp(F.lit(EPOCH).cast("timestamp")))
        .cast("int")
        .alias("tx_time_seconds"),
        F.datediff(ts, F.lit(EPOCH)).alias("tx_time_days"),
        F.when(event_id % 19 != 0, error.cast("int")).alias(LABEL),
        F.when(error, (event_id % 3 + 1).cast("int")).otherwise(0).alias("tx_fraud_scenario"),
        F.to_date(ts).alias(DAY),
    )


def clean_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(transactions(spark, sf_dir))


def once_per_session(build: Callable[[SparkSession, str], object]):
    """Build a stored input once per application and table folder."""
    built: dict[tuple[str, str], object] = {}

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        at = (spark.sparkContext.applicationId, sf_dir)
        if at not in built:
            built[at] = build(spark, sf_dir)
        return built[at]

    return get


@once_per_session
def landing(spark: SparkSession, sf_dir: str) -> str:
    """The transactions as daily comma files below the shared folder."""
    path = scratch_path(spark, "landing")
    write_csv(transactions(spark, sf_dir).hint("rebalance", DAY), path, (DAY,))
    return path


@once_per_session
def cleaned(spark: SparkSession, sf_dir: str) -> cycle.Store:
    """History and ledger after one catch-up run over the whole landing area."""
    store = cycle.Store(scratch_path(spark, "store"))
    cycle.clean_cycle(
        spark, landing(spark, sf_dir), store, START, SCAN_DAYS, SCAN_DAYS, run_id=RUN
    )
    return store


@once_per_session
def trained(spark: SparkSession, sf_dir: str) -> tuple[cycle.Store, cycle.Trained]:
    store = cleaned(spark, sf_dir)
    return store, cycle.train_cycle(spark, store, split="hash", model_name="fraud_model")


def raw_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*RAW.names, DAY)


# Scans, discovery and the watermark


@query("scan_typed_csv")
def scan_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(read_raw(spark, landing(spark, sf_dir)))


@query("rejected_cells")
def rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of badly written daily files that the typed scan reads as null."""
    i = F.col(KEY)
    bad = {
        "tx_datetime": F.when(i % 11 == 0, "no time"),
        "terminal_id": F.when(i % 23 == 0, "1.5"),
        "tx_amount": F.when(i % 7 == 0, 'n/a, "free"'),
        LABEL: F.when(i % 29 == 0, "yes"),
    }
    rows = transactions(spark, sf_dir)
    texts = [F.coalesce(bad.get(c, F.lit(None)), F.col(c).cast("string")).alias(c) for c in RAW.names]
    path = scratch_path(spark, "badly_written")
    write_csv(rows.select(*texts, DAY).hint("rebalance", DAY), path, (DAY,))
    return cells_not_read(spark, path).drop(SOURCE_FILE)


@query("csv_round_trip")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(transactions(spark, sf_dir).select(*RAW.names), path)
    return spark.read.schema(RAW).option("header", True).csv(path)


@once_per_session
def weekday_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing area with gaps: the daily files of a feed that sends none at weekends."""
    path = scratch_path(spark, "weekday_landing")
    sent = transactions(spark, sf_dir).where(F.weekday(DAY) < 5)
    write_csv(sent.hint("rebalance", DAY), path, (DAY,))
    return path


def weekday_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of the landing area with gaps."""
    return list_days(spark, weekday_landing(spark, sf_dir))


@query("source_exists")
def source_exists_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar(spark, START, CALENDAR_DAYS)
    return source_exists(days, weekday_listing(spark, sf_dir))


@query("next_source_files")
def next_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_days(weekday_listing(spark, sf_dir), WATERMARK).drop("paths", "n_bytes")


@query("parse_watermark")
def parse_watermark_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    padded = fn.day_name(day)
    text = by_priority(
        F.concat(padded, F.lit("\n")),
        F.concat(F.lit("  "), padded, F.lit(".txt\t")),
        F.date_format(day, "y-M-d"),
        F.lit(" \r\n"),
        F.lit(None).cast("string"),
    )
    return orders.select("o_orderkey", parse_watermark(text, START).alias("watermark"))


def by_priority(*values: Column) -> Column:
    """One of five values, by the digit the order's priority starts with."""
    first, *others = [(F.col("o_orderpriority").startswith(str(i)), v) for i, v in enumerate(values, 1)]
    chosen = F.when(*first)
    for test, value in others:
        chosen = chosen.when(test, value)
    return chosen


@query("advance_watermark")
def advance_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = cleaned(spark, sf_dir).ledger(spark)
    totals = ledger.agg(
        F.count("*").alias("n_days"),
        F.sum("n_raw").alias("n_raw"),
        F.sum("n_clean").alias("n_clean"),
    )
    return totals.select(
        F.lit(START).alias("watermark_before"),
        ledger_watermark(ledger, START).scalar().alias("watermark_after"),
        "n_days",
        "n_raw",
        "n_clean",
    )


@query("ledger_rows")
def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).ledger(spark).drop("ingest_ts")


# Cleaning


@query("clean_transactions")
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_tx(spark, sf_dir)


@query("lineage_columns")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir).withColumn(SOURCE_KEY, fn.source_key(F.col(DAY)))
    return with_lineage(rows, RUN).select(KEY, SOURCE_KEY, RUN_ID)


@query("clean_counts_per_day")
def clean_counts_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_counts(transactions(spark, sf_dir))


@query("clean_summary")
def clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_counts(transactions(spark, sf_dir), by=None)


@once_per_session
def streamed(spark: SparkSession, sf_dir: str) -> str:
    """History after a stream over the whole landing area."""
    history = scratch_path(spark, "streamed")
    stream = start_stream(
        spark, landing(spark, sf_dir), history, scratch_path(spark, "cursor"), files_per_trigger=10
    )
    stream.awaitTermination()
    return history


@query("stream_ingest")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(read_history(spark, streamed(spark, sf_dir)))


@query("stream_training_window")
def stream_training_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(training_set(spark, streamed(spark, sf_dir), LAST_N))


@once_per_session
def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing area whose days come as four kinds of folder, some as two at once."""
    root = scratch_path(spark, "mixed")
    form = F.when(F.day(DAY) % 4 == 3, F.col(KEY) % 2).otherwise(F.day(DAY) % 4)
    rows = transactions(spark, sf_dir).withColumn("form", form).hint("rebalance", DAY)
    write_csv(rows, f"{root}/parts", ("form", DAY))
    # What arrives under a plain name is moved there: `D`, `D.txt`, else `src_date=D`.
    for path, _ in glob(spark, f"{root}/parts/form=*/{DAY}=*"):
        name, kind = path.rsplit("/", 1)[-1], path.rsplit("/", 2)[-2]
        day = name.removeprefix(f"{DAY}=")
        rename(spark, path, f"{root}/landing/{ {'form=0': day, 'form=2': f'{day}.txt'}.get(kind, name) }")
    return f"{root}/landing"


@query("clean_mixed_landing")
def clean_mixed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger counts of every day, whatever its layout."""
    store = cycle.Store(scratch_path(spark, "mixed_store"))
    cycle.clean_cycle(spark, mixed_landing(spark, sf_dir), store, START, SCAN_DAYS, SCAN_DAYS, run_id=RUN)
    return store.ledger(spark).select(DAY, "n_raw", "n_clean", "n_labelled")


@once_per_session
def streamed_commits(spark: SparkSession, sf_dir: str) -> CommittedStore:
    """A committed store after a stream over days in every layout, a commit for each batch."""
    store = CommittedStore(scratch_path(spark, "streamed_store"))
    area, cursor = mixed_landing(spark, sf_dir), scratch_path(spark, "mixed_cursor")
    start_stream(spark, area, store, cursor, files_per_trigger=10).awaitTermination()
    return store


@query("stream_mixed_landing")
def stream_mixed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = streamed_commits(spark, sf_dir)
    return raw_columns(store.rows(spark, version=None))


@query("compacted_days")
def compacted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, labelled rows and folders of each streamed day after compaction, and whether it has at most four files."""
    store = streamed_commits(spark, sf_dir)
    compact_days(spark, store)
    files = [(path.split("/")[-3].removeprefix(f"{DAY}="), path.rsplit("/", 1)[0]) for path, _, _ in files_at(spark, f"{store.history}/{DAY}=*/*/*.parquet")]
    found = spark.createDataFrame(files, f"{DAY} STRING, path STRING").withColumn(DAY, F.col(DAY).cast("date"))
    named = store.commits.read(spark).select(DAY, F.explode("folders").alias("folder"))
    in_use = found.join(named, DAY).where(F.endswith("path", F.col("folder")))
    n_files = in_use.groupBy(DAY).agg(F.count_distinct("folder").alias("n_folders"), (F.count("*") <= 4).alias("files_fit"))
    rows = store.rows(spark).groupBy(DAY).agg(F.count("*").alias("n_rows"), F.count(LABEL).alias("n_labelled"))
    return rows.join(n_files, DAY)


# Commits of several runs, late and changed days


@once_per_session
def committed(spark: SparkSession, sf_dir: str) -> CommittedStore:
    """Cycles of twelve days each; a run that has seen nothing of them tries to commit the first days again."""
    store = CommittedStore(scratch_path(spark, "committed"))
    area = landing(spark, sf_dir)
    while cycle.clean_cycle(spark, area, store, START, 12, SCAN_DAYS, run_id=RUN).counts:
        pass
    first = store.ledger(spark).orderBy(DAY).limit(12).collect()
    store.record(spark, [tuple(r) for r in first], "late", 0, spark.createDataFrame([], f"{DAY} date, path string, n_bytes bigint, modified bigint"))
    return store


@query("ledger_commits")
def ledger_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and rows that each commit entered."""
    entered = committed(spark, sf_dir).commits.changes(spark)
    return entered.groupBy("version").agg(
        F.count("*").alias("n_days"), F.min(DAY).alias("first_day"), F.sum("n_raw").alias("n_raw"), F.sum("n_clean").alias("n_clean")
    )


@query("committed_history")
def committed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(committed(spark, sf_dir).rows(spark))


def arrival(day: Column, key: Column) -> Column:
    """0 for what is there when the first cycle runs; every fourth day comes later, and every fifth in two parts."""
    return F.when(F.day(day) % 4 == 0, 1).when((F.day(day) % 5 == 1) & (key % 3 == 0), 1).otherwise(0)


@once_per_session
def redelivered(spark: SparkSession, sf_dir: str) -> tuple[str, CommittedStore]:
    """A landing area to which late days and further files of passed days came after its days were cleaned."""
    root = scratch_path(spark, "redelivered")
    rows = transactions(spark, sf_dir).withColumn("arrival", arrival(F.col(DAY), F.col(KEY)))
    for part in (0, 1):
        write_csv(rows.where(F.col("arrival") == part).drop("arrival").hint("rebalance", DAY), f"{root}/part{part}", (DAY,))
    area, store = f"{root}/part0", CommittedStore(f"{root}/store")
    cycle.clean_cycle(spark, area, store, START, SCAN_DAYS, SCAN_DAYS, run_id=RUN)
    for path, _ in glob(spark, f"{root}/part1/{DAY}=*"):
        day = path.rsplit("=", 1)[-1]
        rename(spark, path, f"{area}/{day}")  # a plain folder beside what is there
    return area, store


@query("changed_source_days")
def changed_source_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    area, store = redelivered(spark, sf_dir)
    # Read as of the first commit, so that a reconciled store tells the same.
    listed = source_files(spark, area)
    found = changed_days(listed, store.commits.read(spark, 1), START)
    return found.select(DAY, "source_key", "status")


@query("reconciled_ledger")
def reconciled_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger counts after a cycle that cleans late and changed days again."""
    area, store = redelivered(spark, sf_dir)
    cycle.clean_cycle(spark, area, store, START, SCAN_DAYS, SCAN_DAYS, run_id=RUN, reconcile=True)
    return store.ledger(spark).select(DAY, "n_raw", "n_clean", "n_labelled")


# History and the training window


@query("write_day_partitions")
def write_day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "days")
    write_days(clean_tx(spark, sf_dir), path)
    return raw_columns(read_history(spark, path))


@query("write_days_four_files")
def write_days_four_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "days")
    write_days(clean_tx(spark, sf_dir), path, spread=4)
    return raw_columns(read_history(spark, path))


@query("scan_history")
def scan_whole_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(scan_history(spark, cleaned(spark, sf_dir).history))


@query("preview")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(read_history(spark, cleaned(spark, sf_dir).history)).orderBy(KEY).limit(20)


@query("latest_n_partitions")
def latest_n_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_days(cleaned(spark, sf_dir).ledger(spark), LAST_N)


@query("date_name_filter")
def date_name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    padded = fn.day_name(day)
    name = by_priority(
        padded,
        F.date_format(day, "yyyyMMdd"),
        F.date_format(day, "y-M-d"),
        F.concat(F.date_format(day, "yyyy"), F.lit("-xx-"), F.date_format(day, "dd")),
        F.concat(padded, F.lit(".txt")),
    )
    names = table(spark, sf_dir, "orders").select(name.alias("name"))
    return names.where(fn.is_day_name(F.col("name"))).groupBy("name").agg(F.count("*").alias("n"))


@query("training_window")
def training_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = cleaned(spark, sf_dir)
    return raw_columns(training_set(spark, store.history, LAST_N, store.ledger(spark)))


@query("labelled_rows")
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(clean_tx(spark, sf_dir))


@query("labelled_rows_count")
def labelled_rows_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(clean_tx(spark, sf_dir)).agg(F.count("*").alias("n_rows"))


@query("training_rows_per_cycle")
def training_rows_per_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = cleaned(spark, sf_dir).ledger(spark)
    return cycle.training_growth(ledger, LAST_N).select(DAY, "train_rows")


# Dates, keys and ids


@query("date_parse_format")
def date_parse_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    text = F.date_format(day, "y-M-d")
    mixed = by_priority(fn.day_name(day), text, F.lit("2019-02-30"), F.lit("none"), text)
    parsed = fn.parse_day(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parsed.alias("parsed"),
        fn.try_parse_day(mixed).alias("tolerant"),
        fn.day_name(F.date_add(parsed, 1)).alias("next_name"),
    )


@query("object_key_compose")
def object_key_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    root = (
        F.when(F.col("event_type") == "view", F.lit("store/clean/history"))
        .when(F.col("event_type") == "click", F.lit("store/clean/history/"))
        .otherwise(F.lit("store/clean/history///"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.source_key(day).alias("source_key"),
        fn.join_path(root, F.lit("by_file"), fn.day_name(day)).alias("day_path"),
        fn.join_path(root, F.lit("/_watermark/last_date.txt")).alias("watermark_path"),
        fn.strip_suffix(fn.source_key(day)).alias("day_name"),
    )


@query("run_id_format")
def run_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.run_id("clean", ts).alias("clean_run"),
        fn.run_id("fraud_rf", ts).alias("train_run"),
    )


@query("split_uri")
def split_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.split_uri(F.col("url"), ("http", "https"), strict=False)
    return table(spark, sf_dir, "pages").select("page_id", parts.alias("p")).select("page_id", "p.*")


# Features and splits


def feature_names(rows: DataFrame) -> list[str]:
    return features.feature_columns(rows)


@query("numeric_feature_columns")
def numeric_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir)
    names = feature_names(rows)
    counted = rows.agg(*(F.count(c).alias(c) for c in names))
    return counted.unpivot([], names, "feature", "n_values")


@query("assemble_features")
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir)
    assembled = features.assembler(feature_names(rows)).transform(rows)
    return features.vector_long(assembled, KEY, features.RAW_VECTOR)


@query("scaler_stats")
def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir)
    stats = features.scaler_stats(rows, feature_names(rows))
    return stats.select(
        "idx", "feature", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


@query("scaler_stats_window")
def scaler_stats_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the last five days up to each day, merged from the moments kept with the ledger."""
    store = cleaned(spark, sf_dir)
    windows.update_moments(spark, store)
    stats = windows.window_stats(spark, store, LAST_N)
    return stats.select(
        "window_end", "feature", "n", F.round("mean", 4).alias("mean"), F.round("std", 3).alias("std")
    )


@query("standardize")
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir)
    scaled = features.standardize(rows, feature_names(rows))
    long = features.vector_long(scaled, KEY, features.VECTOR)
    return long.withColumn("value", F.round("value", 4))


@query("random_split")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = splits.random_split(clean_tx(spark, sf_dir))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("random_split_rows")
def random_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts together, which must be the split rows: none lost, none twice."""
    train, test = splits.random_split(clean_tx(spark, sf_dir))
    return train.unionByName(test)


@query("hash_split")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(splits.in_train(F.col(KEY)), "train").otherwise("test")
    return clean_tx(spark, sf_dir).select(KEY, part.alias("part"))


@query("hash_split_null_keys")
def hash_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts of a split whose keys are partly null: no row is lost."""
    key = F.when(F.col(KEY) % 5 != 0, F.col(KEY))
    rows = clean_tx(spark, sf_dir).select(key.alias("key"), KEY)
    train, test = splits.hash_split(rows, "key")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("random_split_shares")
def random_split_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both parts, ids in both, and whether the first has 80 % of them within five standard deviations."""
    parts = random_split(spark, sf_dir)
    n_parts = parts.groupBy(KEY).agg(F.count_distinct("part").alias("n_parts"))
    both = n_parts.where("n_parts > 1").agg(F.count("*").alias("n")).scalar()
    n_rows, n_train = F.count("*"), F.count_if(F.col("part") == "train")
    fits = F.abs(n_train - 0.8 * n_rows) <= 5 * F.sqrt(0.8 * 0.2 * n_rows)
    found = parts.agg(n_rows.alias("n_rows"), fits.alias("share_fits"))
    return found.select("n_rows", both.alias("n_in_both"), "share_fits")


@query("kfold_assign")
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.with_fold(clean_tx(spark, sf_dir), KEY).select(KEY, "fold")


@query("share_split")
def share_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share that is no tenth, drawn row by row from the hash of the key."""
    train, test = splits.share_split(clean_tx(spark, sf_dir).repartition(5), 0.8375, KEY)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select(KEY, "part")


@query("exact_split")
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact sample and the rest of rows whose key tells them apart."""
    train, test = splits.exact_split(transactions(spark, sf_dir), KEY)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select(*RAW.names, DAY, "part")


@query("exact_split_any_keys")
def exact_split_any_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both parts, and those lost, where most keys are null and the others repeat."""
    key = F.when(F.col(KEY) % 10 == 0, F.col("customer_id") % 7)
    rows = transactions(spark, sf_dir).select(KEY, key.alias("key"))
    train, test = splits.exact_split(rows, "key")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    lost = rows.join(both.select(KEY), KEY, "left_anti").agg(F.count("*").alias("n")).scalar()
    return both.groupBy("part").agg(F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_ids")).withColumn("n_lost", lost)


@query("exact_sample")
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_columns(splits.exact_sample(transactions(spark, sf_dir), KEY))


@query("holdout_anti_join")
def holdout_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir)
    return raw_columns(splits.holdout(rows, splits.exact_sample(rows, KEY), KEY))


@query("shuffle_rows")
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shuffled_position(transactions(spark, sf_dir), KEY).select(KEY, "position")


# Metrics


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label; their length is the score."""
    return (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents"), "doc_id")
        .select(
            F.col("quality").alias("label"),
            (F.col("n_chars") > 500).cast("int").alias("prediction"),
            F.col("n_chars").cast("double").alias("score"),
        )
    )


def judged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled transactions; the amount is the score."""
    return labelled(clean_tx(spark, sf_dir)).select(
        F.col(LABEL).alias("label"),
        (F.col("tx_amount") > 100).cast("int").alias("prediction"),
        F.col("tx_amount").alias("score"),
    )


@query("confusion_matrix")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(judged_transactions(spark, sf_dir), "label", "prediction")


@query("metric_accuracy")
def metric_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.accuracy(judged_documents(spark, sf_dir), "label", "prediction")
    return found.select(F.round("accuracy", 6).alias("accuracy"))


@query("metric_f1")
def metric_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.f1(judged_documents(spark, sf_dir), "label", "prediction")
    return found.select(F.round("f1", 6).alias("f1"))


@query("metric_auc")
def metric_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.auc(judged_documents(spark, sf_dir), "label", "score")
    return found.select(F.round("auc", 6).alias("auc"))


@once_per_session
def daily_score_counts(spark: SparkSession, sf_dir: str) -> str:
    """Score counts of each day, stored by day."""
    judged = labelled(clean_tx(spark, sf_dir))
    path = scratch_path(spark, "score_counts")
    write_days(metrics.score_counts(judged, LABEL, "tx_amount", (DAY,)), path)
    return path


@query("auc_per_window")
def auc_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact AUC of the last five days up to each day, merged from stored score counts."""
    counts = spark.read.parquet(daily_score_counts(spark, sf_dir))
    merged = moments.auc_window(counts, counts.select(DAY), LAST_N)
    return metrics.auc_of(merged, ("window_end",)).select("window_end", F.round("auc", 6).alias("auc"))


@query("eval_metrics")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = model.evaluate_exact(judged_transactions(spark, sf_dir), "label", "prediction", "score")
    return found.select(*(F.round(m, 6).alias(m) for m in model.METRICS))


@query("label_rate")
def label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_rate(labelled(clean_tx(spark, sf_dir)), LABEL)


def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value of each event type in each of three folds."""
    folded = splits.with_fold(table(spark, sf_dir, "events"), "event_id")
    return folded.groupBy("event_type", "fold").agg(F.avg("value").alias("metric"))


@query("cv_mean_metric")
def cv_mean_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = metrics.cv_means(fold_metrics(spark, sf_dir), "event_type", "metric")
    return means.withColumn("mean_metric", F.round("mean_metric", 6))


@query("cv_best_params")
def cv_best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = metrics.cv_means(fold_metrics(spark, sf_dir), "event_type", "metric")
    best = metrics.cv_best(means, "event_type")
    return best.withColumn("mean_metric", F.round("mean_metric", 6))


# Runs, versions and promotion


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event type and day; no AUC is logged on Sundays."""
    day = F.to_date("ts")
    value = F.col("value")
    measured = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model_name"), day.alias("day")).agg(
        F.round(F.avg(value) / 500, 4).alias("auc"),
        F.round(F.avg((value > 50).cast("double")), 4).alias("accuracy"),
        F.round(F.avg((value > 100).cast("double")), 4).alias("f1"),
    )
    run_ts = F.col("day").cast("timestamp")
    return measured.select(
        "model_name",
        F.concat(fn.run_id("fraud_rf", run_ts), F.lit("_"), F.col("model_name")).alias("run_id"),
        run_ts.alias("run_ts"),
        F.when(F.weekday("day") != 6, F.col("auc")).alias("auc"),
        "accuracy",
        "f1",
    )


@once_per_session
def run_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The metrics of the daily runs and their versions, as stored tables."""
    runs = daily_runs(spark, sf_dir)
    metrics_path, versions_path = scratch_path(spark, "metrics"), scratch_path(spark, "versions")
    # Every metric is logged twice; the later value is the one that counts.
    logged = metrics_long(runs, list(model.METRICS)).withColumn("log_ts", F.lit(EPOCH).cast("timestamp"))
    again = F.lit(EPOCH + dt.timedelta(days=1)).cast("timestamp")
    append_table(logged.withColumn("value", 1 - F.col("value")), metrics_path)
    append_table(logged.withColumn("log_ts", again), metrics_path)
    append_table(runs.select("model_name", "run_id", "run_ts"), versions_path)
    return metrics_path, versions_path


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, run_tables(spark, sf_dir)[0], RUN_METRICS)


def daily_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, run_tables(spark, sf_dir)[1], MODEL_VERSIONS)
    return registry.model_versions(stored).select("model_name", "version", "run_id")


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = daily_versions(spark, sf_dir)
    return registry.champion_history(registry.with_metric(versions, daily_metrics(spark, sf_dir)))


@query("log_metrics_long")
def log_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.last_logged(daily_metrics(spark, sf_dir))


@query("model_versions")
def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_versions(spark, sf_dir)


@query("champion_history")
def champion_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_history(spark, sf_dir)


@once_per_session
def streamed_promotions(spark: SparkSession, sf_dir: str) -> str:
    """Decisions on the daily versions, which arrive a few days at a time; the stream is restarted in between."""
    root = scratch_path(spark, "arriving")
    runs = daily_runs(spark, sf_dir).withColumn("metric", F.col("auc")).select("model_name", "run_id", "run_ts", "metric")
    week = F.weekofyear("run_ts")
    weeks = [r[0] for r in runs.select(week.alias("week")).distinct().orderBy("week").collect()]
    for number in weeks:  # one row for each model and day
        runs.where(week == number).coalesce(1).write.mode("append").parquet(f"{root}/versions")
        if number in (weeks[len(weeks) // 2], weeks[-1]):
            arriving = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/versions")
            start_promotions(arriving, f"{root}/history", f"{root}/cursor").awaitTermination()
    return f"{root}/history"


@query("stream_promotion")
def stream_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(streamed_promotions(spark, sf_dir))


@query("current_champion")
def current_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.current(daily_history(spark, sf_dir)).select("model_name", "version", "run_id")


@query("current_challenger")
def current_challenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = registry.current(daily_history(spark, sf_dir), "challenger")
    return newest.select("model_name", "version", "run_id")


@query("champion_lookup")
def champion_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    champions = registry.current(daily_history(spark, sf_dir))
    return registry.champion_metric(champions, daily_metrics(spark, sf_dir), "f1")


# Synthesis


@query("union_classes")
def union_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_tx(spark, sf_dir).select(KEY, "tx_amount", LABEL)
    return synthesis.union_classes(rows.where(F.col(LABEL) == 0), rows.where(F.col(LABEL) == 1))


@query("synth_transactions")
def synth_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    size = events.agg(F.count("*").alias("n")).scalar()
    rows = synthesis.synthesize(events.select(F.col("event_id").alias("id")), size)
    doubles = [c for c, t in rows.dtypes if t == "double"]
    return rows.withColumns({c: F.round(c, 4) for c in doubles})


# The model. Scenario numbers are a feature and give the label away, so its results are known


@query("rf_grid_search")
def rf_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, run = trained(spark, sf_dir)
    found = model.grid_results(spark, run.search)
    return found.select("grid_id", "num_trees", "max_depth", F.round("mean_auc", 2).alias("mean_auc"))


@query("rf_grid_search_by_day")
def rf_grid_search_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid search whose folds are whole days: days and rows of each fold, and the best mean AUC."""
    rows = training_set(spark, cleaned(spark, sf_dir).history)
    fold = model.day_fold(F.col(DAY))
    names = feature_names(rows.drop(DAY))
    searched = model.grid_search(rows, names, num_trees=(5,), max_depth=(3, 5), fold=fold)
    best = F.lit(round(max(searched.avgMetrics), 2))
    counted = rows.groupBy(fold.alias("fold")).agg(F.count_distinct(DAY).alias("n_days"), F.count("*").alias("n_rows"))
    return counted.withColumn("best_auc", best)


@query("empty_guards")
def empty_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run raises without days, without labelled rows and without features, and on how many rows."""
    rows = clean_tx(spark, sf_dir).withColumn(SOURCE_KEY, fn.source_key(F.col(DAY)))
    cases = {
        "no_days": rows.where(F.col("tx_amount") <= 0),
        "no_labels": rows.withColumn(LABEL, F.lit(None).cast("int")),
        "no_features": rows.select(LABEL, DAY, SOURCE_KEY),
    }
    found = []
    for name, kept in cases.items():
        store = cycle.Store(scratch_path(spark, name))
        write_days(kept, store.history)
        try:
            cycle.train_cycle(spark, store, LAST_N)
        except ValueError as error:
            found.append((name, kept.count(), str(error).split(" under ")[0]))
    return spark.createDataFrame(found, "guard STRING, n_rows BIGINT, raised STRING")


@query("rf_predict")
def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, run = trained(spark, sf_dir)
    rows = training_set(spark, store.history, None, store.ledger(spark))
    _, test = splits.hash_split(rows, KEY)
    predicted = model.load_model(store.model(run.run_id)).transform(test)
    return predicted.select(KEY, F.col(LABEL).cast("double").alias("label"), "prediction")


@query("rf_run_log")
def rf_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, run = trained(spark, sf_dir)
    logged = registry.last_logged(store.run_metrics(spark)).withColumn("value", F.col("value").cast("string"))
    every = store.run_params(spark).unionByName(logged).where(F.col("run_id") == run.run_id)
    return every.select("key", "value")


@query("rf_promotion")
def rf_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = trained(spark, sf_dir)
    return cycle.promotions(spark, store).select("model_name", "version", "alias")
