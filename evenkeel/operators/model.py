"""Training and applying the scoring pipeline with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from evenkeel.config import (
    KEY,
    LABEL,
    LOGISTIC_C,
    LOGISTIC_MAX_ITER,
    PREDICTION,
    SPLIT_SEED,
    TEST_PERCENT,
)
from evenkeel.functions.expressions import class_probability, confidence, hash_percent

_FILLED = "_filled_"
_INTERNAL = ("_raw_features", "_features", "_margin", "_probability")


def split(
    df: DataFrame, key: str = KEY, test_percent: int = TEST_PERCENT, seed: int = SPLIT_SEED
) -> DataFrame:
    """Adds ``split``: a client is always on the same side, however rows lie."""
    test = hash_percent(F.col(f"`{key}`"), seed=seed) < test_percent
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def _fill(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {
            f"{_FILLED}{c}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
            for c in features
        }
    )


def regularization(n_rows: int, c: float = LOGISTIC_C) -> float:
    """Spark's regParam for an inverse strength ``c`` over population-scaled columns.

    A summed loss weighed by c against half the squared weights is, divided by
    c * n, a mean loss with 1 / (c * n). Spark scales by the sample deviation, so
    its weights are larger by sqrt(n / (n - 1)); the penalty shrinks by the square.
    """
    return (1.0 / (c * n_rows)) * ((n_rows - 1) / n_rows)


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    c: float = LOGISTIC_C,
    max_iter: int = LOGISTIC_MAX_ITER,
) -> PipelineModel:
    """Standardize and fit a ridge-penalized logistic regression.

    Missing values count as 0. The narrow frame of features and label is kept
    while the optimizer passes over it, so joins above it run once.
    """
    inputs = [f"{_FILLED}{f}" for f in features]
    narrow = _fill(df, features).select(*inputs, F.col(f"`{label}`").cast("double").alias("_label"))
    narrow = narrow.where(F.col("_label").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows = narrow.count()
        if n_rows == 0:
            raise ValueError("no labelled rows to train on")
        stages = [
            VectorAssembler(inputCols=inputs, outputCol="_raw_features", handleInvalid="keep"),
            StandardScaler(
                inputCol="_raw_features", outputCol="_features", withMean=True, withStd=True
            ),
            LogisticRegression(
                featuresCol="_features",
                labelCol="_label",
                predictionCol=PREDICTION,
                probabilityCol="_probability",
                rawPredictionCol="_margin",
                regParam=regularization(n_rows, c),
                elasticNetParam=0.0,
                maxIter=max_iter,
                standardization=False,
            ),
        ]
        return Pipeline(stages=stages).fit(narrow)
    finally:
        narrow.unpersist()


def feature_names(model: PipelineModel) -> list[str]:
    return [c[len(_FILLED):] for c in model.stages[0].getInputCols()]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction``, ``probability`` (of class 1) and ``confidence``.

    All other columns, the label among them, pass through untouched, so a scored
    batch needs no join back to its labels.
    """
    filled = _fill(df, feature_names(model))
    out = model.transform(filled)
    internal = {*_INTERNAL, *model.stages[0].getInputCols(), PREDICTION}
    kept = [c for c in out.columns if c not in internal]
    return out.select(
        *kept,
        F.col(PREDICTION).cast("int").alias(PREDICTION),
        class_probability(F.col("_probability")).alias("probability"),
        confidence(F.col("_probability")).alias("confidence"),
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
