"""Cells of the daily files that the typed scan reads as null although they hold text."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dayledger.schema import DAY, RAW, SOURCE_FILE
from dayledger.sources.landing import by_layout, with_source

LINE = "_line"
EXTRA = "_extra"


def rejected_cells(spark: SparkSession, paths: str | list[str], schema: StructType = RAW, base: str | None = None) -> DataFrame:
    """(src_date, row, column, text, _source_file), a row for each cell that did not parse.

    The reader itself tells which lines are malformed, so a cell is rejected here exactly when the
    scan has a null for it; only those lines are cut into texts a second time. `row` is the text of
    the first cell. The first cell beyond the last column, which the scan drops, is in the column
    `_extra`; cells missing at the end of a line have no text and are not listed.
    """
    lined = StructType([*schema.fields, StructField(LINE, StringType())])
    reader = spark.read.schema(lined).option("header", True).option("columnNameOfCorruptRecord", LINE)
    if base:
        reader = reader.option("basePath", base)
    file = F.col("_metadata.file_path").alias(SOURCE_FILE)
    scans = [with_source(reader.csv(group), schema, F.col(LINE), file) for group in by_layout(spark, paths)]
    rows = functools.reduce(DataFrame.unionByName, scans).where(F.col(LINE).isNotNull())
    texts = ", ".join(f"`{name}` STRING" for name in [*schema.names, EXTRA])
    cut = rows.withColumn("_texts", F.from_csv(F.col(LINE), F.lit(texts)))
    text = lambda name: F.col(f"_texts.`{name}`")
    cell = lambda name: F.struct(F.lit(name).alias("column"), text(name).alias("text"))
    found = [F.when(text(name).isNotNull() & F.col(name).isNull(), cell(name)) for name in schema.names]
    found.append(F.when(text(EXTRA).isNotNull(), cell(EXTRA)))
    cells = F.explode(F.array_compact(F.array(*found)))
    listed = cut.select(DAY, text(schema.names[0]).alias("row"), SOURCE_FILE, cells.alias("cell"))
    return listed.select(DAY, "row", "cell.column", "cell.text", SOURCE_FILE)
