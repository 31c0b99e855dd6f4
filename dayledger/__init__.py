"""Daily transaction cleaning, model retraining and promotion as Spark jobs."""

from dayledger.operators.cleaning import clean, clean_counts
from dayledger.operators.features import feature_columns
from dayledger.operators.registry import champion_history
from dayledger.operators.synthesis import synth_transactions
from dayledger.plans.committed import CommittedStore, compact_days, drop_unreferenced
from dayledger.plans.cycle import Store, clean_cycle, register, run_cycle, train_cycle
from dayledger.plans.model import build_pipeline, evaluate, grid_search
from dayledger.sinks import write_csv, write_days
from dayledger.sources import list_days, next_days, read_history, read_raw, scan_history, training_set
from dayledger.streaming import stream_ingest

__all__ = [
    "CommittedStore", "Store", "build_pipeline", "champion_history", "clean", "clean_counts", "clean_cycle",
    "compact_days", "drop_unreferenced", "evaluate", "feature_columns", "grid_search", "list_days", "next_days", "read_history",
    "read_raw", "register", "run_cycle", "scan_history", "stream_ingest", "synth_transactions",
    "train_cycle", "training_set", "write_csv", "write_days",
]
