"""Model versions and the champion / challenger decision over their history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def model_versions(runs: DataFrame) -> DataFrame:
    """Number the runs of each model 1, 2, 3 ... in order of their time."""
    order = Window.partitionBy("model_name").orderBy("run_ts", "run_id")
    return runs.withColumn("version", F.row_number().over(order))


def last_logged(metrics: DataFrame) -> DataFrame:
    """(run_id, key, value): the value logged last, as a run may log a key again.

    Values of one instant, or without a time, are ordered by size, so the choice is the same
    in every run.
    """
    order = F.struct(F.coalesce("log_ts", F.timestamp_seconds(F.lit(0))), "value")
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", order).alias("value"))


def with_metric(versions: DataFrame, metrics: DataFrame, key: str = "auc") -> DataFrame:
    """Each version with the metric its run logged last, null if it logged none."""
    chosen = last_logged(metrics.where(F.col("key") == key)).select("run_id", F.col("value").alias("metric"))
    return versions.join(chosen, "run_id", "left")


def champion_history(versions: DataFrame) -> DataFrame:
    """Whether each version became champion when it was registered.

    A version is promoted when it beats the champion of its time strictly, when there is
    none, or when either has no metric. A version without a metric is always promoted and
    the next one always beats it, so the history restarts there: within such a segment
    the champion's metric is the running maximum. One row per version of a model, so
    these windows are as long as a model's history and do not grow with its data.
    """
    so_far = Window.partitionBy("model_name").orderBy("version")
    earlier = (
        Window.partitionBy("model_name", "segment")
        .orderBy("version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    promoted = F.col("metric").isNull() | F.col("best").isNull() | (F.col("metric") > F.col("best"))
    return (
        versions.withColumn("segment", F.count_if(F.col("metric").isNull()).over(so_far))
        .withColumn("best", F.max("metric").over(earlier))
        .withColumn("alias", F.when(promoted, "champion").otherwise("challenger"))
        .drop("segment")
    )


def current(history: DataFrame, alias: str = "champion") -> DataFrame:
    """The newest version that got the alias, one per model."""
    newest = Window.partitionBy("model_name").orderBy(F.desc("version"))
    return (
        history.where(F.col("alias") == alias)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def champion_metric(champions: DataFrame, metrics: DataFrame, key: str = "auc") -> DataFrame:
    """The metric each current champion logged last in its own run."""
    logged = last_logged(metrics.where(F.col("key") == key))
    return champions.join(logged, "run_id").select("model_name", "version", "run_id", "key", "value")
