from dayledger.sinks.days import drop_days, write_days
from dayledger.sinks.files import write_csv
from dayledger.sinks.tables import append_table, metrics_long, read_table

__all__ = [
    "append_table", "drop_days", "metrics_long", "read_table", "write_csv", "write_days",
]
