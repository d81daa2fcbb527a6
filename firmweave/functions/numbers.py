"""Number parsing, ratios, buckets and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal or scientific notation. The guard comes before the cast, which on its own
# would also take "1d", "nan" and hexadecimal forms.
NUMBER = r"^[ \t-\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t-\r]*$"
INFINITY = r"(?i)^[+-]?inf(inity)?$"

# Upper bounds of the revenue buckets.
REVENUE_BUCKETS = ((100, "Small"), (1000, "Medium"), (5000, "Large"))
TOP_BUCKET = "Enterprise"
NO_BUCKET = "Unknown"


def _or_zero(c: Column) -> Column:
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double of a number or number text; 0.0 for anything that is not one."""
    if not isinstance(dtype, T.StringType):
        return _or_zero(c.cast("double"))
    # A finite text too large for a double is a bad number, not infinity.
    number = F.btrim(c, F.lit(" \t\n\x0b\x0c\r")).try_cast("double")
    finite = F.when(~number.isin(float("inf"), float("-inf")), number)
    infinite = F.when(c.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.coalesce(
        F.when(c.rlike(NUMBER), finite).when(c.rlike(INFINITY), infinite),
        F.lit(0.0),
    )


def fill_zero(c: Column) -> Column:
    """0.0 for NULL and NaN."""
    return _or_zero(c.try_cast("double"))


def profit_margin(revenue: Column, profit: Column) -> Column:
    """Profit in percent of revenue; 0.0 where revenue is missing or not positive."""
    known = revenue.isNotNull() & profit.isNotNull() & ~F.isnan(revenue) & ~F.isnan(profit)
    return F.when(known & (revenue > 0), profit / revenue * 100).otherwise(F.lit(0.0))


def revenue_category(revenue: Column) -> Column:
    bucket = F.when(revenue.isNull() | F.isnan(revenue), F.lit(NO_BUCKET))
    for bound, name in REVENUE_BUCKETS:
        bucket = bucket.when(revenue < bound, F.lit(name))
    return bucket.otherwise(F.lit(TOP_BUCKET))


def revenue_log(revenue: Column) -> Column:
    """Natural log of revenue + 1; NULL at or below -1."""
    return F.ln(revenue + 1.0)


def margin_normalized(margin: Column) -> Column:
    return F.coalesce(margin / 100.0, F.lit(0.0))


def supplier_customer_ratio(suppliers: Column, customers: Column) -> Column:
    return F.when(customers > 0, suppliers / customers).otherwise(F.lit(0.0))


def high_profit(profit: Column, threshold: float = 100.0) -> Column:
    return F.when(profit >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def load_date(value: str | None = None) -> Column:
    """The given ``yyyy-MM-dd`` date, else today's."""
    return F.lit(value) if value else F.date_format(F.current_date(), "yyyy-MM-dd")
