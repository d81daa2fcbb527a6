"""List-valued columns: clean-up, tokenising, joining and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.text import NULL_TOKENS, UNICODE, WS, is_missing_text, strip

SEPARATOR = "; "

# A piece between semicolons that holds something besides white space.
_FILLED_PIECE = f"{UNICODE}[^;{WS}][^;]*"


def _empty() -> Column:
    return F.array().cast("array<string>")


def _filled(items: Column) -> Column:
    """Stripped items without the blank ones."""
    return F.array_remove(F.transform(items, strip), "")


def list_clean_array(c: Column) -> Column:
    """Strip each item, keeping blank ones; a NULL item becomes the text ``None``."""
    return F.coalesce(F.transform(c, lambda x: F.coalesce(strip(x.cast("string")), F.lit("None"))), _empty())


def list_clean_delim(c: Column) -> Column:
    """Split on semicolons, strip, drop blank pieces."""
    return F.coalesce(_filled(F.split(c, ";")), _empty())


def list_clean_scalar(c: Column, strip_item: bool = False) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), _empty()).otherwise(F.array(strip(text) if strip_item else text))


def _is_bracketed(s: Column) -> Column:
    return s.startswith("[") & s.endswith("]") & (s.contains("'") | s.contains('"'))


def _quoted_tokens(s: Column) -> Column:
    """Texts in single quotes, or if there are none, in double quotes."""
    return F.when(
        s.rlike("'[^']+'"), F.regexp_extract_all(s, F.lit("'([^']+)'"), F.lit(1))
    ).otherwise(F.regexp_extract_all(s, F.lit('"([^"]+)"'), F.lit(1)))


def customers_array(c: Column) -> Column:
    """Strip items, drop blank and NULL ones, expand an item that is itself a quoted list."""

    def expand(s: Column) -> Column:
        return F.when(_is_bracketed(s), _quoted_tokens(s)).otherwise(F.array(s))

    stripped = F.transform(F.array_compact(c), lambda x: strip(x.cast("string")))
    return F.coalesce(_filled(F.flatten(F.transform(stripped, expand))), _empty())


def customers_string(c: Column) -> Column:
    """Tokens of a free-form customer text.

    A bracketed quoted list gives its quoted texts. Other text is split on ``; , |``, failing
    that on runs of white space, failing that on single spaces.
    """
    s = strip(c)
    flat = F.replace(s, F.lit("\n"), F.lit(" "))
    pieces = (
        F.when(_is_bracketed(s), _quoted_tokens(s))
        .when(flat.rlike("[;,|]"), F.split(flat, "[;,|]"))
        .when(flat.rlike(f"{UNICODE}[{WS}]{{2}}"), F.split(flat, f"{UNICODE}[{WS}]{{2,}}"))
        .otherwise(F.split(flat, " "))
    )
    return F.coalesce(_filled(pieces), _empty())


def clean_list(c: Column, dtype: T.DataType) -> Column:
    """Cleaned list of a supply-chain column; the column's type picks the rule."""
    if isinstance(dtype, T.ArrayType):
        return list_clean_array(c)
    if isinstance(dtype, T.StringType):
        return list_clean_delim(c)
    return list_clean_scalar(c)


def clean_customers(c: Column, dtype: T.DataType) -> Column:
    """Cleaned list of the customers column; the column's type picks the rule."""
    if isinstance(dtype, T.ArrayType):
        return customers_array(c)
    if isinstance(dtype, T.StringType):
        return customers_string(c)
    return list_clean_scalar(c, strip_item=True)


def list_join(c: Column, dtype: T.DataType) -> Column:
    """Registry text of a list column, NULL when nothing is left of it."""
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: strip(x.cast("string"))), lambda s: ~is_missing_text(s))
        return F.nullif(F.array_join(kept, SEPARATOR), F.lit(""))
    s = strip(c.cast("string"))
    return (
        F.when(is_missing_text(s), F.lit(None).cast("string"))
        .when(_is_bracketed(s), F.nullif(F.array_join(_filled(_quoted_tokens(s)), SEPARATOR), F.lit("")))
        .otherwise(s)
    )


def list_count(c: Column) -> Column:
    """Number of filled pieces in a registry list text; 0 for a null token in any letter case."""
    missing = F.lower(strip(c)).isin(*NULL_TOKENS)
    return F.when(c.isNull() | missing, F.lit(0)).otherwise(F.regexp_count(c, F.lit(_FILLED_PIECE)))


def list_count_unstripped(c: Column) -> Column:
    """As :func:`list_count`, but text of white space alone, without a semicolon, counts as one item."""
    return (
        F.when(c.isNull() | is_missing_text(c), F.lit(0))
        .when(c.contains(";"), F.regexp_count(c, F.lit(_FILLED_PIECE)))
        .otherwise(F.lit(1))
    )


def parse_list_column(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_count``, the number of items in a list text."""
    return df.withColumn(f"{column}_count", list_count_unstripped(F.col(column)))
