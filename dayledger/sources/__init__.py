from dayledger.sources.history import (
    folder_days,
    labelled,
    latest_days,
    latest_entries,
    read_history,
    scan_history,
    training_set,
)
from dayledger.sources.landing import (
    calendar,
    changed_days,
    list_days,
    next_days,
    read_raw,
    source_exists,
    source_files,
    stream_raw,
)
from dayledger.sources.watermark import ledger_watermark, parse_watermark, read_watermark

__all__ = [
    "calendar", "changed_days", "folder_days", "labelled", "latest_days", "latest_entries", "ledger_watermark",
    "list_days", "next_days", "parse_watermark", "read_history", "read_raw", "read_watermark",
    "scan_history", "source_exists", "source_files", "stream_raw", "training_set",
]
