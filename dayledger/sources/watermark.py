"""The watermark: the last day that was ingested."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayledger.functions import parse_day, strip_blanks, strip_suffix
from dayledger.schema import DAY
from dayledger.sources.filesystem import path_missing


def parse_watermark(text: Column, start: dt.date | None = None) -> Column:
    """Date in a watermark text: `2019-08-22`, with blanks or `.txt` around it.

    An empty or null text has no date and falls back to `start`. Any other text
    that is no date fails.
    """
    name = strip_suffix(strip_blanks(text))
    day = parse_day(F.nullif(name, F.lit("")))
    return F.coalesce(day, F.lit(start).cast("date"))


def read_watermark(spark: SparkSession, path: str, start: dt.date) -> dt.date:
    """Watermark kept as a one-line text file; a missing file gives `start`."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return start
    found = text.select(parse_watermark(F.col("value"), start).alias(DAY)).first()
    return found[DAY] if found else start


def ledger_watermark(ledger: DataFrame, start: dt.date) -> DataFrame:
    """One row: the latest ledger day, or `start` while the ledger is empty."""
    return ledger.agg(F.coalesce(F.max(DAY), F.lit(start)).alias(DAY))
