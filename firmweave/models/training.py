"""Train/test split, logistic regression and scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.models.metrics import evaluate
from firmweave.operators.features import LABEL

#: Splits compare 32 bits of the id with the ratio.
_SPAN = 1 << 32


def split_random(df: DataFrame, train_ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's random split. Which row falls where depends on how the frame is partitioned."""
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train, test


def split_point(key: Column) -> Column:
    """0 .. 2^32 - 1 from the first eight digits of a hex id."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def split_stable(
    df: DataFrame, train_ratio: float = 0.8, key: str = "corporate_id"
) -> tuple[DataFrame, DataFrame]:
    """Split by the row's own id: the same rows on every run, and no sort or shuffle."""
    in_train = split_point(F.col(key)) < round(_SPAN * train_ratio)
    return df.filter(in_train), df.filter(~in_train)


def train_logistic_regression(
    train: DataFrame,
    test: DataFrame | None = None,
    max_iter: int = 100,
    reg_param: float = 0.01,
    label: str = LABEL,
) -> tuple[LogisticRegressionModel, DataFrame | None, dict[str, float]]:
    """Fit, and on a test frame also score and evaluate.

    The fit keeps its own blocks of the training rows, spilling to disk, so ``train`` is not
    cached here as well.
    """
    if not train.head(1):
        raise ValueError("the training set has no rows")
    model = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg_param
    ).fit(train)
    if math.isinf(model.intercept):
        raise ValueError(f"the training set has a single value of {label}")
    if test is None:
        return model, None, {}
    predictions = model.transform(test)
    scored = predictions.select(label, "prediction", positive_probability().alias("score"))
    row = evaluate(scored, label=label).first()
    return model, predictions, {k: v for k, v in row.asDict().items() if v is not None}


def positive_probability(column: str = "probability") -> Column:
    """Probability of the positive class out of a probability vector."""
    return F.get(vector_to_array(F.col(column)), F.lit(1))


def linear_probability(
    features: Sequence[str], coefficients: Sequence[float], intercept: float
) -> Column:
    """The model's probability as a plain expression: the sigmoid of the weighted sum."""
    margin = F.lit(intercept)
    for name, weight in zip(features, coefficients, strict=True):
        margin = margin + F.col(name) * F.lit(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def coefficient_table(model: LogisticRegressionModel, features: Sequence[str]) -> DataFrame:
    """(term, weight) rows of a fitted model."""
    rows = [("intercept", float(model.intercept))]
    rows += [(name, float(w)) for name, w in zip(features, model.coefficients.toArray(), strict=True)]
    return SparkSession.active().createDataFrame(rows, "term string, weight double")
