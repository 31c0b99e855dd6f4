"""Schemas and column names shared by every module."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StringType, StructField, StructType

LABEL = "tx_fraud"
DAY = "src_date"
SOURCE_KEY = "_source_key"
SOURCE_FILE = "_source_file"
RUN_ID = "_ingest_run_id"
INGEST_TS = "_ingest_ts"
BATCH = "batch_id"


def table(**columns: str) -> StructType:
    schema = StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name)
    return schema


# The layout of one daily transaction file. Columns bind by
# position, all are nullable, and the first name is spelled as the files have it.
RAW = table(
    tranaction_id="integer",
    tx_datetime="timestamp",
    customer_id="integer",
    terminal_id="integer",
    tx_amount="double",
    tx_time_seconds="integer",
    tx_time_days="integer",
    tx_fraud="integer",
    tx_fraud_scenario="integer",
)

LEDGER = table(
    src_date="date",
    source_key="string",
    run_id="string",
    n_raw="long",
    n_clean="long",
    n_labelled="long",
    ingest_ts="timestamp",
)

# The run whose folder below a day holds its rows, in a committed history.
RUN = "run"
# One row for each day of a committed history: its ledger row, the commit it came with, the folders
# that hold its rows, the landing files that were read, and the last batch of each stream.
MANIFEST = table(
    src_date="date", source_key="string", run_id="string", n_raw="long", n_clean="long", n_labelled="long",
    ingest_ts="timestamp", version="long",
).add("folders", ArrayType(StringType())).add(
    "sources", ArrayType(table(path="string", n_bytes="long", modified="long"))
).add("streams", MapType(StringType(), LongType()))

# Moments of a day's features, with the ledger row they belong to.
MOMENTS = table(
    src_date="date", idx="integer", feature="string", n="long", mean="double", m2="double", run_id="string", ingest_ts="timestamp"
)
RUN_PARAMS = table(run_id="string", key="string", value="string")
RUN_METRICS = table(run_id="string", key="string", value="double", log_ts="timestamp")
# A version has no stored number: it is its place in the order of time, see registry.model_versions.
MODEL_VERSIONS = table(model_name="string", run_id="string", run_ts="timestamp")


def wide(schema: StructType) -> StructType:
    """The schema with 64-bit integers wherever it has 32-bit ones."""
    fields = [
        StructField(f.name, LongType() if f.dataType == IntegerType() else f.dataType, f.nullable)
        for f in schema.fields
    ]
    return StructType(fields)
