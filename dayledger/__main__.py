"""Commands for spark-submit: clean, train, cycle, stream, compact and demo.

Settings of the cluster, storage credentials included, come with the session.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from pathlib import Path

if not __package__:  # started by its path: the package's folder is not on the module path
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession

from dayledger.operators import synthesis
from dayledger.plans import committed, cycle, demo, model
from dayledger.schema import RAW, wide
from dayledger.streaming import stream_ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dayledger", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    for sub in (command("clean", "landing", "store"), command("cycle", "landing", "store")):
        sub.add_argument("--start-date", type=dt.date.fromisoformat, default=cycle.START)
        whole = sub.prog.endswith("cycle")
        sub.add_argument("--take-n", type=int, default=1 if whole else cycle.TAKE_N)
        sub.add_argument("--max-scan-days", type=int, default=365 if whole else cycle.MAX_SCAN_DAYS)
        sub.add_argument("--drop-nan", action="store_true", help="drop rows with a NaN amount")
        sub.add_argument("--wide-ids", action="store_true", help="read ids as 64-bit integers")
        sub.add_argument("--reconcile", action="store_true", help="clean late and changed days again; needs --committed")
        if whole:
            training_options(sub)
            sub.set_defaults(last_n=5, model_name="fraud_model")
        committed_option(sub)
    training = command("train", "store")
    training_options(training)
    committed_option(training)
    streaming = command("stream", "landing", "history", "checkpoint")
    streaming.add_argument("--files-per-trigger", type=int, default=cycle.TAKE_N)
    streaming.add_argument("--quarantine", help="folder for rows of files that name no day")
    committed_option(streaming)
    compact = command("compact", "store")
    compact.add_argument("--max-files", type=int, default=committed.MAX_FILES)
    demo_data = command("demo", "path")
    demo_data.add_argument("--rows", type=int, default=synthesis.ROWS)
    demo_data.add_argument("--fraud-rate", type=float, default=synthesis.FRAUD_RATE)
    demo_data.add_argument("--seed", type=int, default=synthesis.SEED)
    return top


def committed_option(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("--committed", action="store_true", help="the store is one that several runs may write to")


def training_options(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("--last-n", type=int, help="train on the latest N days only")
    sub.add_argument("--model-name", help="register the run as a version of this model")
    sub.add_argument("--promote-metric", choices=model.METRICS, default="auc")
    sub.add_argument("--split", choices=("random", "hash"), default="random")
    sub.add_argument("--exclude", nargs="*", default=[], help="numeric columns that are no features")
    sub.add_argument("--output", help="also save the model here")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    kind = committed.CommittedStore if getattr(args, "committed", False) else cycle.Store
    if args.command in ("clean", "cycle"):
        done = cycle.clean_cycle(
            spark,
            args.landing,
            kind(args.store),
            args.start_date,
            args.take_n,
            args.max_scan_days,
            drop_nan=args.drop_nan,
            schema=wide(RAW) if args.wide_ids else RAW,
            reconcile=args.reconcile,
        )
        print(f"{done.status}: {done.n_raw:,} -> {done.n_clean:,} rows, watermark {done.watermark}")
    if args.command in ("train", "cycle"):
        trained = cycle.train_cycle(
            spark,
            kind(args.store),
            args.last_n,
            args.model_name,
            args.promote_metric,
            tuple(args.exclude),
            split=args.split,
            output=args.output,
        )
        print(f"{trained.run_id}: {trained.metrics} {trained.params} {trained.alias or ''}")
    if args.command == "stream":
        history = kind(args.history) if args.committed else args.history
        stream_ingest(
            spark, args.landing, history, args.checkpoint, args.files_per_trigger, quarantine=args.quarantine
        ).awaitTermination()
    if args.command == "compact":
        days = committed.compact_days(spark, committed.CommittedStore(args.store), args.max_files)
        print(f"{len(days)} days compacted")
    if args.command == "demo":
        made = demo.write_demo_data(spark, args.path, args.rows, args.fraud_rate, args.seed)
        print(f"{made['n_rows']} rows, {made['n_fraud']} fraudulent ({made['fraud_pct']:.2f}%)")


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"dayledger-{args.command}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
