"""Features, label and training frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.functions.numbers import (
    high_profit,
    margin_normalized,
    revenue_log,
    supplier_customer_ratio,
)

DOUBLES = ("revenue", "profit", "profit_margin")
INTEGERS = ("num_suppliers", "num_customers", "num_activity_places")
REQUIRED = ("revenue", "profit", "num_suppliers")
LABEL = "high_profit"
DEFAULT_FEATURES = ("revenue", "num_suppliers", "profit_margin_normalized")


def select_features(df: DataFrame) -> DataFrame:
    """The typed inputs; text that is no number, and NaN, become NULL."""

    def double(name: str) -> Column:
        value = F.col(name).try_cast("double")
        return F.when(~F.isnan(value), value).alias(name)

    return df.select(
        "corporate_id",
        "corporate_name",
        *[double(c) for c in DOUBLES],
        *[F.col(c).try_cast("int").alias(c) for c in INTEGERS],
        "revenue_category",
    )


def _all_present(columns: Sequence[str]) -> Column:
    """A plain conjunction, which unlike ``dropna`` Spark pushes into the scan."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def filter_required(df: DataFrame) -> DataFrame:
    return df.filter(_all_present(REQUIRED))


def label_high_profit(df: DataFrame, profit_threshold: float = 100.0) -> DataFrame:
    return df.withColumn(LABEL, high_profit(F.col("profit"), profit_threshold))


def engineer_features(df: DataFrame, profit_threshold: float = 100.0) -> DataFrame:
    """Typed inputs with the label and the derived features; rows lacking a required input dropped."""
    # The first filter is on the stored columns, so that the scan can apply it; the second
    # catches what the typed projection turned into NULL.
    typed = filter_required(select_features(filter_required(df)))
    labelled = label_high_profit(typed, profit_threshold)
    return labelled.withColumns(
        {
            "revenue_log": revenue_log(F.col("revenue")),
            "profit_margin_normalized": margin_normalized(F.col("profit_margin")),
            "supplier_customer_ratio": supplier_customer_ratio(F.col("num_suppliers"), F.col("num_customers")),
        }
    )


def filter_features(df: DataFrame, feature_columns: Sequence[str] = DEFAULT_FEATURES) -> DataFrame:
    """Id, label and features of the rows that have them all."""
    kept = df.select("corporate_id", LABEL, *feature_columns)
    return kept.filter(_all_present((LABEL, *feature_columns)))


def assemble(df: DataFrame, feature_columns: Sequence[str] = DEFAULT_FEATURES) -> DataFrame:
    """Add the feature vector; rows with a NULL or NaN feature are dropped."""
    assembler = VectorAssembler(inputCols=list(feature_columns), outputCol="features", handleInvalid="skip")
    return assembler.transform(df)


def prepare_features(df: DataFrame, feature_columns: Sequence[str] = DEFAULT_FEATURES) -> DataFrame:
    return assemble(filter_features(df, feature_columns), feature_columns)
