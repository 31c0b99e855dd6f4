"""Column expressions for object keys, paths and URIs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dayledger.functions.days import day_name

SOURCE_SUFFIX = ".txt"
BLANKS = " \t\r\n\f\x0b"
OBJECT_SCHEMES = ("s3a", "s3")

URI_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)/*([^?#]*)"


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def strip_suffix(text: Column, suffix: str = SOURCE_SUFFIX) -> Column:
    return F.when(
        F.endswith(text, F.lit(suffix)), F.substring(text, F.lit(1), F.length(text) - len(suffix))
    ).otherwise(text)


def source_key(day: Column) -> Column:
    """Object key of the file of one day."""
    return F.concat(day_name(day), F.lit(SOURCE_SUFFIX))


def join_path(root: Column, *parts: Column) -> Column:
    """Root without its trailing slashes, then the parts without leading ones."""
    heads = F.regexp_replace(root, "/+$", "")
    tails = [F.regexp_replace(p, "^/+", "") for p in parts]
    return F.concat_ws("/", heads, *tails)


def day_of_file(path: Column, name: Column) -> Column:
    """Day that a file, given by its path and name, belongs to, or null.

    The file names it (`2019-08-23.txt`), or its folder does: `2019-08-23/part-0.parquet`,
    `src_date=2019-08-23/part-0.csv`, `2019-08-23.txt/part-0.csv`. Evaluated for every row
    of a scan: the long path is only looked at when the short name is no day. A name with
    anything more, like `2019-08-23_backup.txt`, is no day.
    """
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    value = F.substring_index(folder, "=", -1)
    whole = lambda text: (F.length(text) == 10) | ((F.length(text) == 10 + len(SOURCE_SUFFIX)) & F.endswith(text, F.lit(SOURCE_SUFFIX)))
    return F.coalesce(*(F.when(whole(text), F.substring(text, 1, 10).try_cast("date")) for text in (name, value)))


def split_uri(uri: Column, schemes: tuple[str, ...] = OBJECT_SCHEMES, strict: bool = True) -> Column:
    """Struct of bucket and key. Another scheme fails, or is null if not strict."""
    scheme = F.lower(F.regexp_extract(uri, URI_PARTS, 1))
    parts = F.struct(
        F.regexp_extract(uri, URI_PARTS, 2).alias("bucket"),
        F.regexp_extract(uri, URI_PARTS, 3).alias("key"),
    )
    if not strict:
        return F.when(scheme.isin(*schemes), parts)
    wanted = " or ".join(f"{s}://" for s in schemes)
    failure = F.raise_error(F.concat(F.lit(f"expected {wanted}, got: "), uri))
    # raise_error is of void type; the cast gives both branches one type.
    return F.when(scheme.isin(*schemes), parts).otherwise(
        failure.cast("struct<bucket:string,key:string>")
    )
