"""Column layouts shared by the readers, the operators and the tables."""

from __future__ import annotations

from pyspark.sql import types as T

LIST = T.ArrayType(T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Supply-chain source, as Parquet and JSON hold it. CSV holds lists as "a; b" text.
SOURCE1 = _struct(
    ("corporate_name_S1", T.StringType()),
    ("address", T.StringType()),
    ("activity_places", LIST),
    ("top_suppliers", LIST),
)

# Financial source.
SOURCE2 = _struct(
    ("corporate_name_S2", T.StringType()),
    ("main_customers", LIST),
    ("revenue", T.DoubleType()),
    ("profit", T.DoubleType()),
)

REGISTRY = _struct(
    ("corporate_id", T.StringType()),
    ("corporate_name", T.StringType()),
    ("address", T.StringType()),
    ("activity_places", T.StringType()),
    ("top_suppliers", T.StringType()),
    ("main_customers", T.StringType()),
    ("revenue", T.DoubleType()),
    ("profit", T.DoubleType()),
    ("profit_margin", T.DoubleType()),
    ("revenue_category", T.StringType()),
    ("num_activity_places", T.IntegerType()),
    ("num_suppliers", T.IntegerType()),
    ("num_customers", T.IntegerType()),
    ("processed_date", T.StringType()),
    ("source", T.StringType()),
)

# One row per experiment and one per registered model run (see models/tracking.py).
EXPERIMENTS = _struct(
    ("experiment_id", T.StringType()),
    ("name", T.StringType()),
    ("created_at", T.TimestampType()),
)

RUNS = _struct(
    ("run_id", T.StringType()),
    ("experiment_id", T.StringType()),
    ("run_name", T.StringType()),
    ("model_name", T.StringType()),
    ("model_version", T.IntegerType()),
    ("version_label", T.StringType()),
    ("model_type", T.StringType()),
    ("feature_columns", LIST),
    ("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ("tags", T.MapType(T.StringType(), T.StringType())),
    ("created_at", T.TimestampType()),
    ("model_path", T.StringType()),
)


def text_lists(schema: T.StructType) -> T.StructType:
    """The same layout with every list column held as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType, True)
            for f in schema
        ]
    )


def text_numbers(schema: T.StructType) -> T.StructType:
    """The same layout with doubles left as text, for the tolerant number parse to read."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DoubleType) else f.dataType, True)
            for f in schema
        ]
    )
