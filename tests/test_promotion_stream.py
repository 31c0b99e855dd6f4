from __future__ import annotations

import datetime as dt
import random

import pytest

from dayledger.operators import registry
from dayledger.streaming import stream_promotions

SCHEMA = "model_name STRING, run_id STRING, run_ts TIMESTAMP, metric DOUBLE"


def arrivals(seed):
    dice = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    rows = [(f"m{dice.randrange(3)}", f"r{i:03d}", day + dt.timedelta(hours=i // 2), None if dice.random() < 0.15 else dice.randrange(8) / 8) for i in range(60)]
    return rows


@pytest.mark.parametrize("seed, sizes", [(1, [60]), (2, [1, 19, 20, 20]), (3, [30, 29, 1])])
def test_decisions_equal_the_batch_history_for_any_split(spark, tmp_path, seed, sizes):
    rows = arrivals(seed)
    source, history, cursor = (str(tmp_path / name) for name in ("source", "history", "cursor"))
    at = 0
    for number, size in enumerate(sizes):
        spark.createDataFrame(rows[at : at + size], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        at += size
        if number % 2 == 0 or at == 60:  # every second arrival waits for the next start
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
            stream_promotions(stream, history, cursor).awaitTermination()
    versions = registry.model_versions(spark.createDataFrame(rows, SCHEMA))
    names = ["model_name", "version", "run_id", "metric", "best", "alias"]
    want = registry.champion_history(versions).select(*names).collect()
    got = spark.read.parquet(history).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
