"""Classification metrics as aggregations over (label, prediction or score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayledger.operators.positions import rows_before


def confusion(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    return rows.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def accuracy(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    return accuracy_of(confusion(rows, label, prediction))


def accuracy_of(counts: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.agg((right / F.sum("n")).alias("accuracy"))


def f1(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    return f1_of(confusion(rows, label, prediction))


def f1_of(counts: DataFrame) -> DataFrame:
    """F1 of each label, weighted by how often the label occurs.

    Each cell counts towards the support of its label and the size of its predicted
    class, so one grouping by class gives all three counts.
    """
    none = F.lit(0).cast("bigint")

    def entry(side: str, support: Column, predicted: Column) -> Column:
        return F.struct(
            F.col(side).alias("class"), support.alias("support"), predicted.alias("predicted")
        )

    both = F.array(entry("label", F.col("n"), none), entry("prediction", none, F.col("n")))
    cells = counts.select(
        F.explode(both).alias("c"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    # A hit appears in both entries of its cell; half of the sum is the count, and
    # F1 = 2 * hits / (support + predicted) needs the doubled count anyway.
    per_class = cells.groupBy("c.class").agg(
        F.sum("c.support").alias("support"),
        F.sum("c.predicted").alias("predicted"),
        F.sum("hit").alias("twice_hits"),
    )
    score = F.col("twice_hits") / (F.col("support") + F.col("predicted"))
    return per_class.agg((F.sum(score * F.col("support")) / F.sum("support")).alias("f1"))


def auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve; ties count half, a single class gives 0.

    Equal scores are counted together first. The distinct scores are then cut into ranges,
    and the running count of negatives is taken within a range plus the total of the ranges
    below, so no task sorts all scores and a score shared by many rows is one row.
    """
    return auc_of(score_counts(rows, label, score))


def score_counts(rows: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, score, pos, neg): what the AUC of any union of such rows can be found from.

    Counts of several days are merged by adding them up for each score.
    """
    scored = rows.select(
        *by, F.col(score).cast("double").alias("score"), (F.col(label) > 0.5).alias("positive")
    )
    return scored.groupBy(*by, "score").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )


def auc_of(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The AUC of score counts, one for each group; scores must be distinct within a group."""
    ranges = counts.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    below = Window.partitionBy(*by, "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    # Pairs are counted twice over, so a tie is one; decimals keep the sums exact.
    won = 2 * F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg")
    per_range = (
        ranges.withColumn("won", whole(won))
        .groupBy(*by, "range")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum((whole("pos") * F.col("won")).cast("decimal(38,0)")).alias("won"),
        )
    )
    with_lower = per_range.withColumn("lower", rows_before("range", "neg", by))
    total = with_lower.groupBy(*by).agg(
        F.sum(F.col("won") + 2 * whole("pos") * whole("lower")).cast("double").alias("won"),
        (2.0 * F.sum("pos") * F.sum("neg")).alias("pairs"),
    )
    found = F.when(F.col("pairs") > 0, F.col("won") / F.col("pairs")).otherwise(F.lit(0.0))
    return total.select(*by, found.alias("auc"))


def whole(count: str | Column) -> Column:
    column = F.col(count) if isinstance(count, str) else count
    return column.cast("decimal(18,0)")


def label_rate(rows: DataFrame, label: str) -> DataFrame:
    """Rows, positives and the percentage of positives to two places."""
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("n_fraud"),
        F.round(F.avg(F.col(label).cast("double")) * 100, 2).alias("fraud_pct"),
    )


def cv_means(folds: DataFrame, point: str, metric: str) -> DataFrame:
    """Mean metric of each grid point over its folds."""
    return folds.groupBy(point).agg(F.avg(metric).alias("mean_metric"), F.count("*").alias("n_folds"))


def cv_best(means: DataFrame, point: str) -> DataFrame:
    """The grid point with the highest mean; the first one on a tie."""
    return means.orderBy(F.desc("mean_metric"), F.asc(point)).limit(1)
