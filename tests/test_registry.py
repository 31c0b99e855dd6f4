from __future__ import annotations

import datetime as dt
import random

import pytest

from dayledger.operators import registry
from dayledger.schema import RUN_METRICS
from dayledger.sinks import metrics_long


def fold(metrics):
    """The decision taken one version at a time."""
    champion, aliases = None, []
    for number, metric in enumerate(metrics, 1):
        promote = champion is None or metric is None or champion[1] is None or metric > champion[1]
        aliases.append("champion" if promote else "challenger")
        if promote:
            champion = (number, metric)
    return aliases, champion[0]


def test_window_equals_fold(spark):
    rnd = random.Random(11)
    histories = {
        f"m{i}": [None if rnd.random() < 0.15 else rnd.randrange(6) / 10 for _ in range(rnd.randint(1, 12))]
        for i in range(300)
    }
    rows = [(m, v, value) for m, values in histories.items() for v, value in enumerate(values, 1)]
    versions = spark.createDataFrame(rows, "model_name STRING, version INT, metric DOUBLE").repartition(4)
    history = registry.champion_history(versions)
    got = {(r["model_name"], r["version"]): r["alias"] for r in history.collect()}
    champions = {r["model_name"]: r["version"] for r in registry.current(history).collect()}
    for name, values in histories.items():
        aliases, champion = fold(values)
        assert [got[name, v] for v in range(1, len(values) + 1)] == aliases
        assert champions[name] == champion


def test_versions_restart_per_model_and_follow_time(spark):
    runs = spark.createDataFrame(
        [("a", "r2", 2), ("a", "r1", 1), ("b", "r3", 3), ("a", "r0", 2)],
        "model_name STRING, run_id STRING, run_ts INT",
    )
    got = {(r["run_id"], r["version"]) for r in registry.model_versions(runs).collect()}
    assert got == {("r1", 1), ("r0", 2), ("r2", 3), ("r3", 1)}


def test_a_version_without_the_metric_stays(spark):
    versions = spark.createDataFrame([("m", 1, "r1"), ("m", 2, "r2")], "model_name STRING, version INT, run_id STRING")
    metrics = spark.createDataFrame([("r1", "auc", 0.5, None), ("r2", "f1", 0.9, None)], RUN_METRICS)
    got = {r["run_id"]: r["metric"] for r in registry.with_metric(versions, metrics).collect()}
    assert got == {"r1": 0.5, "r2": None}
    by_f1 = registry.champion_history(registry.with_metric(versions, metrics, "f1"))
    assert {r["alias"] for r in by_f1.collect()} == {"champion"}


def test_the_last_value_of_a_repeated_metric_counts(spark):
    versions = spark.createDataFrame([("m", 1, "r1")], "model_name STRING, version INT, run_id STRING")
    noon, one = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 13)
    rows = [("r1", "auc", 0.9, noon), ("r1", "auc", 0.7, one), ("r1", "auc", 0.95, None)]
    metrics = spark.createDataFrame(rows, RUN_METRICS)
    assert [r["metric"] for r in registry.with_metric(versions, metrics).collect()] == [0.7]
    found = registry.champion_metric(versions, metrics)
    assert [(r["version"], r["value"]) for r in found.collect()] == [(1, 0.7)]


def test_nan_metric_is_refused(spark):
    wide = spark.createDataFrame([("r", float("nan"), 0.1)], "run_id STRING, auc DOUBLE, f1 DOUBLE")
    with pytest.raises(Exception, match="NaN metric: auc"):
        metrics_long(wide, ["auc", "f1"]).collect()


def test_null_metric_is_not_logged(spark):
    wide = spark.createDataFrame([("r", None, 0.1)], "run_id STRING, auc DOUBLE, f1 DOUBLE")
    assert [tuple(r) for r in metrics_long(wide, ["auc", "f1"]).collect()] == [("r", "f1", 0.1)]
