"""Parquet, CSV and JSON writes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.lists import SEPARATOR
from firmweave.storage import join_uri

REGISTRY_NAME = "corporate_registry"
FORMATS = ("parquet", "csv", "json")


def prepare_for_export(df: DataFrame) -> DataFrame:
    """Each list column as text, items joined by a semicolon; other columns as they are."""
    return df.withColumns(
        {
            f.name: F.array_join(F.col(f.name).cast("array<string>"), SEPARATOR, "None")
            for f in df.schema
            if isinstance(f.dataType, T.ArrayType)
        }
    )


def write_dataset(df: DataFrame, uri: str, file_format: str = "parquet") -> str:
    """Write a frame as Parquet, CSV or JSON Lines and return the URI.

    CSV keeps outer white space and lists as joined text; JSON keeps lists as arrays.
    """
    fmt = file_format.lower()
    if fmt == "parquet":
        df.write.parquet(uri, compression="snappy")
    elif fmt == "csv":
        prepare_for_export(df).write.csv(
            uri, header=True, quote='"', escape='"', encoding="UTF-8",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    elif fmt == "json":
        df.write.json(uri, encoding="UTF-8", ignoreNullFields=False)
    else:
        raise ValueError(f"no writer for format {file_format!r}, only for {FORMATS}")
    return uri


def timestamp_text(when: datetime | None = None) -> str:
    return (when or datetime.now()).strftime("%Y%m%d_%H%M%S")


def load_dataset(
    df: DataFrame,
    output_uri: str,
    name: str,
    output_format: str = "parquet",
    timestamp: str | None = None,
) -> str:
    """Write a frame below ``output_uri`` under a time-stamped name; CSV and JSON get flat lists."""
    uri = join_uri(output_uri, f"{name}_{timestamp or timestamp_text()}.{output_format}")
    flat = prepare_for_export(df) if output_format.lower() in ("csv", "json") else df
    return write_dataset(flat, uri, output_format)


def load_registry(
    df: DataFrame, output_uri: str, output_format: str = "parquet", timestamp: str | None = None
) -> str:
    return load_dataset(df, output_uri, REGISTRY_NAME, output_format, timestamp)
