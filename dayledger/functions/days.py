"""Column expressions for day names, dates and run ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Formats of day names and run ids. Parsing takes unpadded months
# and days (2019-8-1); rendering always pads.
DAY_PARSE = "yyyy-M-d"
RUN_STAMP = "yyyyMMdd_HHmmss"


def parse_day(text: Column) -> Column:
    """Strict: a text that is no date fails the query (ANSI mode)."""
    return F.to_date(text, DAY_PARSE)


def try_parse_day(text: Column) -> Column:
    """Tolerant: a text that is no date becomes null."""
    return F.try_to_date(text, DAY_PARSE)


def day_name(day: Column) -> Column:
    """`yyyy-MM-dd`, which is how Spark writes a date as text."""
    return day.cast("date").cast("string")


def is_day_name(name: Column) -> Column:
    """Shape test only: ten characters with dashes at the fifth and eighth."""
    return (
        (F.length(name) == 10)
        & (F.substring(name, 5, 1) == "-")
        & (F.substring(name, 8, 1) == "-")
    )


def run_id(prefix: str, ts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(ts, RUN_STAMP))
