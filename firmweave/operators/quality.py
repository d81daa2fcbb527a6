"""Row counts, null counts and the quality report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.operators.resolve import key_overlap, summarize_overlap


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named frame: (stage, rows)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _long(row: DataFrame, key: str, value: str) -> DataFrame:
    """A one-row frame of numbers turned into one row per column."""
    pairs = [F.struct(F.lit(c).alias(key), F.col(c).cast("bigint").alias(value)) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def _null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column in one pass: (column_name, nulls)."""
    return _long(df.agg(*_null_counts(df)), "column_name", "nulls")


def label_balance(df: DataFrame, label: str = "high_profit") -> DataFrame:
    """Positives, rows and percent positive; the percent of an empty frame is NULL."""
    positives, total = F.count_if(F.col(label) == 1.0), F.count(F.lit(1))
    return df.agg(
        positives.alias("positives"),
        total.alias("total"),
        F.try_divide(positives * F.lit(100.0), total).alias("percent"),
    )


def quality_report(s1: DataFrame, s2: DataFrame, registry: DataFrame) -> DataFrame:
    """Counts, match diagnostics and null counts as (stage, metric, value).

    Two passes in all: the key overlap gives the source counts as well as the diagnostics, and
    one aggregate over the registry gives its rows and nulls.
    """
    match = _long(summarize_overlap(key_overlap(s1, s2)), "metric", "value")
    stage_of = F.when(F.col("metric") == "s1_rows", "source1").when(F.col("metric") == "s2_rows", "source2")
    metric_of = F.when(F.col("metric").endswith("_rows"), "rows").otherwise(F.col("metric"))
    sources = match.select(
        F.coalesce(stage_of, F.lit("resolve")).alias("stage"), metric_of.alias("metric"), "value"
    )
    nulls = [c.alias(f"nulls_{name}") for c, name in zip(_null_counts(registry), registry.columns, strict=True)]
    table = _long(registry.agg(F.count(F.lit(1)).alias("rows"), *nulls), "metric", "value")
    return sources.unionByName(table.select(F.lit("registry").alias("stage"), "metric", "value"))
