"""Champion or challenger, decided as versions arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dayledger.session import ship_package

DECIDED = "model_name string, version int, run_id string, metric double, best double, alias string"
#: Versions so far, and the champion's metric: null before there is one and after a version without a metric.
CHAMPION = "versions int, best double"


def promote(key: tuple[str], arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Number and judge the versions of one model that arrived together, in order of their time."""
    number, best = state.get if state.exists else (0, None)
    versions = pd.concat(arrived).sort_values(["run_ts", "run_id"], kind="stable")
    decided = []
    for run_id, metric in zip(versions["run_id"], versions["metric"], strict=True):
        metric = None if pd.isna(metric) else float(metric)
        best = None if metric is None else best
        number += 1
        promoted = metric is None or best is None or metric > best
        decided.append((key[0], number, run_id, metric, best, "champion" if promoted else "challenger"))
        best = metric if promoted else best
    state.update((number, best))
    yield pd.DataFrame(decided, columns=["model_name", "version", "run_id", "metric", "best", "alias"])


def promotions(versions: DataFrame) -> DataFrame:
    """The decisions over a stream of (model_name, run_id, run_ts, metric), one row per version.

    The rule is that of `registry.champion_history`, which this equals however the versions are
    split into micro-batches, as long as those of a model arrive in order; one that comes later
    than its successors is numbered when it comes. The state is two numbers per model.
    """
    grouped = versions.select("model_name", "run_id", "run_ts", "metric").groupBy("model_name")
    return grouped.applyInPandasWithState(promote, DECIDED, CHAMPION, "append", GroupStateTimeout.NoTimeout)


def stream_promotions(versions: DataFrame, history: str, checkpoint: str) -> StreamingQuery:
    """Append the decisions on all versions not yet seen to the Parquet table `history`, then stop."""
    ship_package(versions.sparkSession)
    writer = promotions(versions).writeStream.format("parquet").outputMode("append")
    return writer.option("path", history).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
