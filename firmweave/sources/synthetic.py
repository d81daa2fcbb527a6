"""Synthetic input of any size.

Every value is a function of (row id, field, seed), so the rows do not depend on how the ids
are partitioned and a lost task regenerates exactly what it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.sinks.files import write_dataset
from firmweave.storage import join_uri

# The vocabularies of the list columns.
SUPPLIERS = (
    "Global Materials Inc", "Tech Components Ltd", "Raw Materials Co",
    "Industrial Supplies Corp", "Manufacturing Partners LLC",
    "Supply Chain Solutions", "Material Sourcing Group", "Component Distributors",
    "Industrial Goods Co", "Supply Network International",
)
CUSTOMERS = (
    "Retail Giants Corp", "Consumer Products Inc", "Market Leaders Ltd",
    "Distribution Networks", "Retail Partners Group", "Sales Corporation",
    "Commercial Buyers LLC", "Business Customers Co", "Trade Partners Inc",
    "Market Solutions Ltd",
)
ACTIVITIES = (
    "Manufacturing", "Distribution", "Warehousing", "Logistics",
    "Procurement", "Quality Control", "Shipping", "Inventory Management",
    "Supply Chain Operations", "Material Handling",
)

# Parts of made-up company names and addresses.
FAMILIES = ("Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir", "Hazel", "Juniper", "Larch", "Maple")
KINDS = ("Group", "Inc", "Ltd", "LLC", "PLC", "and Sons")
STREETS = ("Canal", "Church", "Harbor", "Hill", "Market", "Mill", "River", "Station")
TOWNS = ("Ashford", "Brookfield", "Clayton", "Dunmore", "Easton", "Fairview")

FILES = {"source1": "source1_supply_chain", "source2": "source2_financial"}
OUTPUT_FORMATS = {"json": ("json",), "csv": ("csv",), "parquet": ("parquet",), "both": ("json", "csv", "parquet")}


def _digest(row_id: Column, field: str, seed: int) -> Column:
    return F.sha2(F.concat_ws("|", row_id.cast("string"), F.lit(field), F.lit(str(seed))), 256)


def _digits(digest: Column, start: int, length: int) -> Column:
    """Some hex digits of a digest as a number."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def _pick(words: tuple[str, ...], draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (draw % len(words) + 1).cast("int"))


def _sample(words: tuple[str, ...], row_id: Column, field: str, seed: int, low: int, high: int) -> Column:
    """``low`` to ``high`` different words: the words ordered by six digest digits each, then cut."""
    if len(words) > 10:
        raise ValueError(f"a digest orders ten words, not {len(words)}")
    digest = _digest(row_id, field, seed)
    keyed = F.array(
        *[
            F.struct(F.substring(digest, 1 + 6 * i, 6).alias("k"), F.lit(word).alias("word"))
            for i, word in enumerate(words)
        ]
    )
    size = low + _digits(digest, 61, 4) % (high - low + 1)
    return F.slice(F.array_sort(keyed)["word"], F.lit(1), size.cast("int"))


def _company_name(key: Column, seed: int) -> Column:
    digest = _digest(key, "name", seed)
    return F.concat_ws(
        " ", _pick(FAMILIES, _digits(digest, 1, 4)), key, _pick(KINDS, _digits(digest, 5, 4))
    )


def source1_rows(ids: DataFrame, id_column: str = "id", seed: int = 42) -> DataFrame:
    """One supply-chain row per id."""
    i = F.col(id_column)
    place = _digest(i, "address", seed)
    return ids.select(
        _company_name(i.cast("string"), seed).alias("corporate_name_S1"),
        F.concat(
            (_digits(place, 1, 4) % 999 + 1).cast("string"), F.lit(" "),
            _pick(STREETS, _digits(place, 5, 4)), F.lit(" Street, "),
            _pick(TOWNS, _digits(place, 9, 4)), F.lit(" "),
            F.lpad((_digits(place, 13, 6) % 100000).cast("string"), 5, "0"),
        ).alias("address"),
        _sample(ACTIVITIES, i, "activities", seed, 2, 5).alias("activity_places"),
        _sample(SUPPLIERS, i, "suppliers", seed, 3, 8).alias("top_suppliers"),
    )


def source2_rows(ids: DataFrame, id_column: str = "id", seed: int = 42, match_rate: float = 0.8) -> DataFrame:
    """One financial row per id; a ``match_rate`` share bears the name of the source-1 row of that id.

    Money is drawn in whole cents and the margin in millionths, so no value needs rounding twice.
    """
    i = F.col(id_column)
    draw = _digest(i, "money", seed)
    matched = _digits(draw, 1, 6) < round((1 << 24) * match_rate)
    name_key = F.when(matched, i.cast("string")).otherwise(F.concat(F.lit("x"), i.cast("string")))
    revenue_cents = F.lit(1000) + _digits(draw, 7, 10) % 499001
    margin = F.lit(50000) + _digits(draw, 17, 10) % 150001
    profit_cents = F.floor((revenue_cents * margin + 500000) / 1000000)
    return ids.select(
        _company_name(name_key, seed).alias("corporate_name_S2"),
        _sample(CUSTOMERS, i, "customers", seed, 2, 6).alias("main_customers"),
        (revenue_cents / 100).alias("revenue"),
        (profit_cents / 100).alias("profit"),
    )


def _ids(spark: SparkSession, num_rows: int) -> DataFrame:
    if num_rows <= 0:
        raise ValueError(f"cannot generate {num_rows} rows")
    return spark.range(num_rows)


def generate_source1(spark: SparkSession, num_rows: int, seed: int = 42) -> DataFrame:
    return source1_rows(_ids(spark, num_rows), seed=seed)


def generate_source2(spark: SparkSession, num_rows: int, seed: int = 42, match_rate: float = 0.8) -> DataFrame:
    return source2_rows(_ids(spark, num_rows), seed=seed, match_rate=match_rate)


def generate_and_save(
    spark: SparkSession,
    num_rows: int,
    output_uri: str,
    output_format: str = "parquet",
    seed: int = 42,
    match_rate: float = 0.8,
    skip: tuple[str, ...] = (),
    ids: DataFrame | None = None,
) -> dict[str, str]:
    """Write both sources, each in one format or (``both``) in all, straight to where they belong.

    A row per ``id`` of ``ids``, or per number below ``num_rows``.
    Returns the URI of each dataset by ``<source>_<format>``.
    """
    if output_format not in OUTPUT_FORMATS:
        raise ValueError(f"no writer for format {output_format!r}")
    keys = _ids(spark, num_rows) if ids is None else ids
    frames = {
        "source1": source1_rows(keys, seed=seed),
        "source2": source2_rows(keys, seed=seed, match_rate=match_rate),
    }
    written = {}
    for source, df in frames.items():
        if source in skip:
            continue
        for fmt in OUTPUT_FORMATS[output_format]:
            uri = join_uri(output_uri, f"{FILES[source]}.{fmt}")
            written[f"{source}_{fmt}"] = write_dataset(df, uri, fmt)
    return written
