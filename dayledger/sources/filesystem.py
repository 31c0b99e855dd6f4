"""Names of files and folders, through the Hadoop file system the session is set up for.

A Spark scan leaves out empty files, and lists every part file of a folder to see that the
folder is there. Asking the file system gives one entry per day instead.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, with the session's own settings."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(conf)


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and length (zero for a folder) of what the pattern matches; nothing there is an empty list."""
    at, files = hadoop_path(spark, pattern)
    return [(s.getPath().toString(), s.getLen() if s.isFile() else 0) for s in files.globStatus(at) or []]


def files_at(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change (milliseconds) of every visible file the pattern matches."""
    at, files = hadoop_path(spark, pattern)
    found = [s for s in files.globStatus(at) or [] if s.isFile() and s.getPath().getName()[0] not in "._"]
    return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found]


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file there whole, unless one is there: then nothing changes and the result is false.

    The text is written under a hidden name and renamed without overwriting, which is one step on
    a file system that can rename, so no reader sees half of it and of two writers one wins.
    """
    at, files = hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(at).toUri(), conf)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(at), options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            raise
        return False
    return True


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder, making the folders above its new place."""
    at, files = hadoop_path(spark, path)
    target, _ = hadoop_path(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(at, target):
        raise OSError(f"{path} cannot become {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    at, files = hadoop_path(spark, path)
    files.delete(at, True)
