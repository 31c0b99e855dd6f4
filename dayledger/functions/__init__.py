from dayledger.functions.days import day_name, is_day_name, parse_day, run_id, try_parse_day
from dayledger.functions.keys import day_of_file, join_path, source_key, split_uri, strip_blanks, strip_suffix
from dayledger.functions.hashing import hash31, uniform

__all__ = [
    "day_name", "day_of_file", "hash31", "is_day_name", "join_path", "parse_day", "run_id",
    "source_key", "split_uri", "strip_blanks", "strip_suffix", "try_parse_day", "uniform",
]
