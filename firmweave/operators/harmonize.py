"""Projection of resolved entities onto the fixed registry layout."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.lists import list_count, list_join
from firmweave.functions.numbers import NO_BUCKET, fill_zero, load_date
from firmweave.functions.text import null_tokens
from firmweave.schemas import REGISTRY

SOURCE_LABEL = "harmonized"

# Registry list column and the column of its item count.
LIST_COUNTS = {
    "activity_places": "num_activity_places",
    "top_suppliers": "num_suppliers",
    "main_customers": "num_customers",
}


def _column(df: DataFrame, name: str, default: Any) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Registry scalars with their defaults: S2's name for a missing one, 0.0 for numbers, 'Unknown'."""
    name = F.coalesce(_column(df, "corporate_name_S1", ""), _column(df, "corporate_name_S2", ""))
    return df.withColumns(
        {
            "corporate_name": name.cast("string"),
            "address": F.coalesce(_column(df, "address", "").cast("string"), F.lit("")),
            "revenue": fill_zero(_column(df, "revenue", 0.0)),
            "profit": fill_zero(_column(df, "profit", 0.0)),
            "profit_margin": fill_zero(_column(df, "profit_margin", 0.0)),
            "revenue_category": F.coalesce(
                _column(df, "revenue_category", NO_BUCKET).cast("string"), F.lit(NO_BUCKET)
            ),
        }
    )


#: Columns that ``prepared`` adds, by what they stand for.
_PREPARED = "_registry_{}"


def prepared(df: DataFrame) -> DataFrame:
    """One side with the registry's texts and counts of its rows, for ``harmonize`` to find: made once per row, not once per pair of rows."""
    added = {_PREPARED.format(name): _list_text(df, name) for name in LIST_COUNTS if f"{name}_clean" in df.columns}
    counts = {
        _PREPARED.format(count): list_count(F.col(_PREPARED.format(name))).cast(T.IntegerType())
        for name, count in LIST_COUNTS.items() if _PREPARED.format(name) in added
    }
    for name in ("corporate_name_S1", "corporate_name_S2"):
        if name in df.columns:
            added[_PREPARED.format(name)] = null_tokens(F.col(name).cast("string"))
    if "address" in df.columns:
        added[_PREPARED.format("address")] = null_tokens(F.col("address").cast("string"))
    return df.withColumns(added).withColumns(counts)


def _name(df: DataFrame) -> Column | None:
    """The registry name out of the prepared ones, S2's where S1 has none; nothing if they are not there."""
    names = [(n, _PREPARED.format(n)) for n in ("corporate_name_S1", "corporate_name_S2")]
    if not all({n, p} <= set(df.columns) for n, p in names):
        return None
    (raw, first), (_, second) = names
    return F.when(F.col(raw).isNull(), F.col(second)).otherwise(F.col(first))


def _list_text(df: DataFrame, name: str) -> Column:
    if _PREPARED.format(name) in df.columns:
        return F.col(_PREPARED.format(name))
    cleaned = f"{name}_clean"
    if cleaned not in df.columns:
        return F.lit(None).cast("string")
    return list_join(F.col(cleaned), df.schema[cleaned].dataType)


def harmonize(df: DataFrame, processed_date: str | None = None) -> DataFrame:
    """The registry: one row per resolved pair, in the column order of the layout. What ``prepared`` made of the sides is taken as it is."""
    filled = fill_defaults(df)
    scrubbed = {c: null_tokens(F.col(c)) for c in ("corporate_name", "address", "revenue_category")}
    name, address = _name(df), _PREPARED.format("address")
    if name is not None:
        scrubbed["corporate_name"] = name
    if {"address", address} <= set(df.columns):
        scrubbed["address"] = F.col(address)
    texts = {name: _list_text(df, name) for name in LIST_COUNTS}
    counts = {
        count: F.col(_PREPARED.format(count)) if _PREPARED.format(count) in df.columns else list_count(F.col(name)).cast(T.IntegerType())
        for name, count in LIST_COUNTS.items()
    }
    return (
        filled.withColumns(scrubbed | texts)
        .withColumns(counts | {"processed_date": load_date(processed_date), "source": F.lit(SOURCE_LABEL)})
        .select(*REGISTRY.fieldNames())
    )
