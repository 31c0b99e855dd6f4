"""The model: pipeline, grid search, evaluation, and reading the chosen parameters."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayledger.functions.hashing import hash31
from dayledger.operators import metrics
from dayledger.operators.features import VECTOR, assembler, scaler
from dayledger.schema import LABEL

# The search grid and its settings.
NUM_TREES = (20, 50)
MAX_DEPTH = (5, 10)
FOLDS = 3
PARALLELISM = 4
SEED = 42
METRICS = ("auc", "accuracy", "f1")


def forest(seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=LABEL, featuresCol=VECTOR, seed=seed)


def build_pipeline(columns: list[str], handle_invalid: str = "error", seed: int = SEED) -> Pipeline:
    """Assemble, standardise, random forest. A null or NaN feature fails by default."""
    return Pipeline(stages=[assembler(columns, handle_invalid), scaler(), forest(seed)])


def grid_search(
    train: DataFrame,
    columns: list[str],
    num_trees: Sequence[int] = NUM_TREES,
    max_depth: Sequence[int] = MAX_DEPTH,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    handle_invalid: str = "error",
    seed: int = SEED,
    fold: Column | None = None,
) -> CrossValidatorModel:
    """Cross-validated search on AUC, then a refit of the best point on all of `train`.

    Folds are random, or those of `fold`, a column of numbers from 0 to `folds` - 1, as `day_fold`
    gives them. What comes before the forest does not depend on the grid, so it is fitted once
    for each fold and its vectors are kept for all grid points. Folds follow one another, so the
    vectors of one are kept at a time; its forests grow side by side, at most `parallelism` of
    them and no more than the executors can keep the rows of. The first point wins a tie.
    """
    spark = train.sparkSession
    prepare = Pipeline(stages=[assembler(columns, handle_invalid), scaler()])
    classifier = forest(seed)
    grid = (
        ParamGridBuilder()
        .addGrid(classifier.numTrees, list(num_trees))
        .addGrid(classifier.maxDepth, list(max_depth))
        .build()
    )
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    dealt = F.floor(F.rand(seed) * folds) if fold is None else fold
    # Kept, as random numbers would differ if other partitions were read a second time.
    folded = train.withColumn("_fold", dealt.cast("int")).persist()

    def vectors(stages: PipelineModel, rows: DataFrame) -> DataFrame:
        return stages.transform(rows).select(LABEL, VECTOR).persist()

    def fold_scores(k: int) -> list[float]:
        rest, own = folded.where(F.col("_fold") != k), folded.where(F.col("_fold") == k)
        stages = prepare.fit(rest)
        learn, judge = vectors(stages, rest), vectors(stages, own)

        def score(point: dict) -> float:
            with room.hold(rows * bagged_bytes(len(columns), point[classifier.numTrees])):
                grown = classifier.copy(point).fit(learn)
            return evaluator.evaluate(grown.transform(judge))

        try:
            rows = learn.count()
            room = Room(free_storage(spark))
            with ThreadPoolExecutor(parallelism) as pool:
                return list(pool.map(inheritable_thread_target(spark)(score), grid))
        finally:
            learn.unpersist(blocking=True)
            judge.unpersist(blocking=True)

    try:
        scores = np.array([fold_scores(k) for k in range(folds)])
    finally:
        folded.unpersist()
    means = scores.mean(axis=0)
    best = classifier.copy(grid[int(np.argmax(means))])
    stages = prepare.fit(train)
    model = PipelineModel([*stages.stages, best.fit(stages.transform(train))])
    searched = CrossValidatorModel(model, means.tolist(), stdMetrics=scores.std(axis=0).tolist())
    estimator = build_pipeline(columns, handle_invalid, seed)
    return searched._set(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=seed)


def bagged_bytes(features: int, trees: int) -> int:
    """Heap of one row while a forest grows: its bins, how often each tree drew it, and the objects that hold them."""
    return 112 + 4 * (features + trees)


def free_storage(spark: SparkSession) -> int:
    """Bytes the executors can still keep. The driver is listed among them and keeps no rows, so the largest entry is left out."""
    listed = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator()
    free = []
    while listed.hasNext():
        free.append(listed.next()._2())
    return sum(sorted(free)[: max(1, len(free) - 1)])


class Room:
    """Lets forests grow side by side while their rows stay in memory; one may always grow.

    Rows that do not stay there are read from disk again for every level of the trees.
    """

    def __init__(self, free: int):
        self.free = free
        self.held = 0
        self.changed = threading.Condition()

    @contextmanager
    def hold(self, size: int) -> Iterator[None]:
        with self.changed:
            self.changed.wait_for(lambda: not self.held or self.held + size <= self.free)
            self.held += size
        try:
            yield
        finally:
            with self.changed:
                self.held -= size
                self.changed.notify_all()


def day_fold(day: Column, folds: int = FOLDS, seed: int = SEED) -> Column:
    """Fold of a row by its day, so that no day is learnt from and judged at once.

    Days are dealt by a hash of their number; a row without a day is in the first fold.
    """
    number = F.datediff(day, F.lit("1970-01-01").cast("date"))
    return F.coalesce(hash31(number, seed=seed) % folds, F.lit(0)).cast("int")


def grid_results(spark: SparkSession, searched: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters and its mean and spread over the folds."""
    rows = []
    for i, point in enumerate(searched.getEstimatorParamMaps()):
        chosen = {param.name: int(value) for param, value in point.items()}
        rows.append(
            (i, chosen["numTrees"], chosen["maxDepth"],
             float(searched.avgMetrics[i]), float(searched.stdMetrics[i]))
        )
    return spark.createDataFrame(
        rows, "grid_id INT, num_trees INT, max_depth INT, mean_auc DOUBLE, std_auc DOUBLE"
    )


def scored(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Label, prediction and the score of class 1, without the vectors."""
    return predictions.select(
        F.col(label).cast("double").alias("label"),
        "prediction",
        vector_to_array("rawPrediction")[1].alias("score"),
    )


def evaluate(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Exact AUC, accuracy and weighted F1 of a model's predictions."""
    rows = scored(predictions, label).persist()
    try:
        return evaluate_exact(rows, "label", "prediction", "score").first().asDict()
    finally:
        rows.unpersist()


def evaluate_exact(rows: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """One row of exact AUC, accuracy and weighted F1, for any label/score columns."""
    counts = metrics.confusion(rows, label, prediction)
    return rows.sparkSession.range(1).select(
        metrics.auc(rows, label, score).scalar().alias("auc"),
        metrics.accuracy_of(counts).scalar().alias("accuracy"),
        metrics.f1_of(counts).scalar().alias("f1"),
    )


def best_params(model: PipelineModel) -> dict[str, int]:
    chosen = model.stages[-1]
    return {"maxDepth": chosen.getMaxDepth(), "numTrees": chosen.getNumTrees}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
