"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", memory: str = "12g", name: str = "dayledger") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a temp folder only for a local master."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return local_scratch(spark.sparkContext.applicationId)


@functools.cache
def local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"dayledger-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def sibling_session(spark: SparkSession) -> SparkSession:
    """Another session of the same application with the same settings.

    Observing a metric leaves state in a session that Spark 4.1 cannot serialise, and a
    random forest fitted there drags its session into every task. Observed writes run in
    a sibling, so cleaning and training can share one application.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of this application import the package.

    Nothing is sent where PYTHONPATH already names the package's folder.
    """
    package = Path(__file__).resolve().parent
    if str(package.parent) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        _ship(spark, spark.sparkContext.applicationId, package)


@functools.lru_cache(maxsize=1)
def _package_zip(package: Path) -> str:
    target = os.path.join(tempfile.mkdtemp(prefix="dayledger-package-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    return target


_shipped: set[str] = set()


def _ship(spark: SparkSession, application: str, package: Path) -> None:
    if application not in _shipped:
        spark.sparkContext.addPyFile(_package_zip(package))
        _shipped.add(application)
