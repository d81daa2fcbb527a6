"""Cleaning of the two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmweave.functions.lists import clean_customers, clean_list
from firmweave.functions.numbers import profit_margin, revenue_category, to_number
from firmweave.functions.text import address_clean, name_clean

SOURCE1_LISTS = ("activity_places", "top_suppliers")
CUSTOMERS = "main_customers"


def clean_source1(df: DataFrame) -> DataFrame:
    """Supply-chain rows with cleaned lists, name and address beside the raw columns."""
    cleaned = {
        f"{c}_clean": clean_list(F.col(c), df.schema[c].dataType) for c in SOURCE1_LISTS if c in df.columns
    }
    cleaned["corporate_name_clean"] = name_clean(F.col("corporate_name_S1"))
    cleaned["address_clean"] = address_clean(F.col("address"))
    return df.withColumns(cleaned)


def clean_source2(df: DataFrame) -> DataFrame:
    """Financial rows with a cleaned list and name, parsed money, margin and revenue bucket."""
    cleaned = {"corporate_name_clean": name_clean(F.col("corporate_name_S2"))}
    if CUSTOMERS in df.columns:
        cleaned[f"{CUSTOMERS}_clean"] = clean_customers(F.col(CUSTOMERS), df.schema[CUSTOMERS].dataType)
    for money in ("revenue", "profit"):
        cleaned[money] = to_number(F.col(money), df.schema[money].dataType)
    return df.withColumns(cleaned).withColumns(
        {
            "profit_margin": profit_margin(F.col("revenue"), F.col("profit")),
            "revenue_category": revenue_category(F.col("revenue")),
        }
    )
