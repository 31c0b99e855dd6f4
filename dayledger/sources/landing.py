"""The landing area: which daily files exist, which come next, and reading them."""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dayledger.functions import day_of_file, source_key
from dayledger.functions.keys import SOURCE_SUFFIX
from dayledger.schema import DAY, RAW, SOURCE_FILE, SOURCE_KEY
from dayledger.sources.filesystem import files_at, glob

DAY_NAME = re.compile(rf"(?:{DAY}=)?(\d{{4}}-\d\d-\d\d)(?:{re.escape(SOURCE_SUFFIX)})?")
ANY_DAY = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"


def day_glob(root: str, days: Iterable[dt.date] | None = None) -> str:
    """One pattern for the files or folders of the given days, or of every day."""
    names = ANY_DAY if days is None else "{" + ",".join(f"{d:%Y-%m-%d}" for d in days) + "}"
    return f"{root.rstrip('/')}/{{{DAY}=,}}{names}{{{SOURCE_SUFFIX},}}"


def list_days(spark: SparkSession, root: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """One row per existing day: date, key, every path it has, and the bytes of those that are files.

    A day may lie there as a file and as a folder at once, in at most four forms. Contents are
    not read, so an empty file exists. Only a missing path means "nothing there"; any other
    failure is raised.
    """
    entries = []
    for path, n_bytes in glob(spark, day_glob(root, days)):
        name = path.rsplit("/", 1)[-1].removeprefix(f"{DAY}=").removesuffix(SOURCE_SUFFIX)
        entries.append((name, path, n_bytes))
    listed = spark.createDataFrame(entries, "name STRING, path STRING, n_bytes BIGINT")
    # A name like 2019-13-99 has the shape of a day but is none.
    return (
        listed.withColumn(DAY, F.col("name").try_cast("date"))
        .where(F.col(DAY).isNotNull())
        .groupBy(DAY)
        .agg(F.array_sort(F.collect_list("path")).alias("paths"), F.sum("n_bytes").alias("n_bytes"))
        .select(DAY, source_key(F.col(DAY)).alias("source_key"), "paths", "n_bytes")
    )


def source_files(spark: SparkSession, root: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """One row for each file of a day, in whatever layout: date, path, length and time of change."""
    pattern = day_glob(root, days)
    entries = []
    for path, n_bytes, modified in files_at(spark, pattern) + files_at(spark, f"{pattern}/*"):
        # The file names its day, or its folder does.
        named = [m[1] for m in map(DAY_NAME.fullmatch, reversed(path.split("/")[-2:])) if m]
        entries.append((named[0], path, n_bytes, modified))
    listed = spark.createDataFrame(entries, "name STRING, path STRING, n_bytes BIGINT, modified BIGINT")
    dated = listed.withColumn(DAY, F.col("name").try_cast("date"))
    return dated.where(F.col(DAY).isNotNull()).select(DAY, "path", "n_bytes", "modified")


def changed_days(listed: DataFrame, manifest: DataFrame, after: dt.date | None = None) -> DataFrame:
    """Days up to the last committed one with files that were not read as they are now.

    `late` days are not in the manifest, `changed` ones are. A file that is gone since it was read
    makes no change: landing areas are tidied up.
    """
    known = manifest.select(DAY, F.inline("sources"))
    new = listed.join(known, [DAY, "path", "n_bytes", "modified"], "left_anti")
    last = manifest.agg(F.max(DAY)).scalar()
    fits = (F.col(DAY) <= last) & (F.lit(True) if after is None else F.col(DAY) > F.lit(after))
    found = new.where(fits).groupBy(DAY).agg(F.count("*").alias("n_changed"))
    committed = manifest.select(DAY, F.lit(True).alias("there"))
    status = F.when(F.col("there"), "changed").otherwise("late")
    return found.join(committed, DAY, "left").select(DAY, source_key(F.col(DAY)).alias("source_key"), status.alias("status"), "n_changed")


def calendar(spark: SparkSession, after: dt.date | Column, n_days: int) -> DataFrame:
    """The `n_days` calendar days that follow `after`, which itself is excluded."""
    start = after if isinstance(after, Column) else F.lit(after)
    return spark.range(1, n_days + 1).select(
        F.date_add(start, F.col("id").cast("int")).alias(DAY)
    )


def source_exists(days: DataFrame, listing: DataFrame) -> DataFrame:
    """Each day of the calendar with a flag telling whether its file exists."""
    present = listing.select(DAY, F.lit(True).alias("present"))
    return days.join(present, DAY, "left").select(
        DAY,
        source_key(F.col(DAY)).alias("source_key"),
        F.coalesce("present", F.lit(False)).alias("file_exists"),
    )


def next_days(
    listing: DataFrame,
    watermark: dt.date | Column,
    take_n: int = 3,
    max_scan_days: int = 30,
) -> DataFrame:
    """The first `take_n` existing days after the watermark.

    `max_scan_days` counts calendar days, so days past the cap are not found even
    when nothing nearer exists.
    """
    days = calendar(listing.sparkSession, watermark, max_scan_days)
    # The calendar holds max_scan_days rows, whatever the size of the data.
    return (
        listing.join(F.broadcast(days), DAY, "left_semi")
        .select(DAY, "source_key", "paths", "n_bytes")
        .orderBy(DAY)
        .limit(take_n)
    )


def read_raw(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType = RAW,
    base: str | None = None,
) -> DataFrame:
    """Typed scan of daily comma files, plus the day and key their path names.

    The header line is consumed but its names are ignored: columns bind by position. A cell
    that does not parse is null, a short row is padded with nulls and extra cells are
    dropped. Pass a schema with BIGINT ids where int overflows, and the landing root as
    `base` when the paths are single days below it.
    """
    reader = spark.read.schema(schema).option("header", True)
    if base:
        reader = reader.option("basePath", base)
    # Partition discovery drops every plain file that lies next to a partition folder, so each
    # layout is a scan of its own.
    scans = [with_source(reader.csv(group), schema) for group in by_layout(spark, paths)]
    return functools.reduce(DataFrame.unionByName, scans)


def by_layout(spark: SparkSession, paths: str | list[str]) -> list[str | list[str]]:
    """The paths in groups of one layout: `src_date=` folders, and the rest."""
    if isinstance(paths, str):
        root = paths.rstrip("/")
        if any(c in root for c in "*?[{"):
            found = [path for path, _ in glob(spark, root)]
        else:
            folders, plain = glob(spark, f"{root}/{DAY}=*"), glob(spark, f"{root}/{ANY_DAY}*")
            # A scan of the root takes its files only; what has no length may be a folder.
            whole = not folders and all(n_bytes for _, n_bytes in plain)
            found = [] if whole else [path for path, _ in folders + plain]
        if not found:
            return [paths]
        paths = found
    folder = lambda path: path.rstrip("/").rsplit("/", 1)[-1].startswith(f"{DAY}=")
    groups = [[p for p in paths if folder(p)], [p for p in paths if not folder(p)]]
    return [group for group in groups if group]


def require_files(rows: DataFrame, sizes: dict[str, int]) -> None:
    """Raise when a listed path with bytes gives no file to the scan of rows."""
    read: set[str] = set()
    for file in rows.inputFiles():
        name = file.rstrip("/").split(":", 1)[-1].lstrip("/")
        read |= {name, name.rsplit("/", 1)[0]}
    for path, n_bytes in sizes.items():
        if n_bytes and path.rstrip("/").split(":", 1)[-1].lstrip("/") not in read:
            raise ValueError(f"{path} has {n_bytes} bytes but is not read")


def stream_raw(
    spark: SparkSession, root: str, files_per_trigger: int, schema: StructType = RAW
) -> DataFrame:
    """The same scan as a stream that meets each file once, whatever layout it arrives in.

    Partition discovery takes one layout for the whole area: plain files next to `src_date=`
    folders are dropped and plain folders stop the query. So there is none, and the day of each
    row comes from its path. Rows of a file that names no day have a null day; the column
    `_source_file` tells which file that is.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(root)
    )
    return with_source(rows, schema, F.col("_metadata.file_path").alias(SOURCE_FILE))


def with_source(rows: DataFrame, schema: StructType, *more: Column) -> DataFrame:
    """Day and key: free in `src_date=` folders, where the day is a partition value."""
    name = F.col("_metadata.file_name")
    if DAY in rows.columns:
        day, key = F.col(DAY).cast("date"), source_key(F.col(DAY))
    else:
        day = day_of_file(F.col("_metadata.file_path"), name)
        key = F.when(F.endswith(name, F.lit(SOURCE_SUFFIX)), name).otherwise(source_key(day))
    return rows.select(*schema.names, day.alias(DAY), key.alias(SOURCE_KEY), *more)
