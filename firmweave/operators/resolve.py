"""Entity resolution: an equi-join on the normalised name, and how well it matched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.functions.text import corporate_id, match_key

NAME_KEY = "name_key"
ADDRESS_KEY = "address_key"


def with_keys(df: DataFrame, address: bool) -> DataFrame:
    keys = {NAME_KEY: match_key(F.col("corporate_name_clean"))}
    if address:
        keys[ADDRESS_KEY] = match_key(F.col("address_clean"))
    return df.withColumns(keys)


def _suffixed(df: DataFrame, clashing: set[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in df.columns if c in clashing})


#: Rows of one side from which a key counts as hot in a job.
HOT_ROWS = 1_000_000
#: Hot keys of a side at most, and keys that the sketch keeps count of: any key with more than its rows / HOT_TRACKED is among them.
HOT_KEYS = 1_000
HOT_TRACKED = 10_000
#: Parts of either side that a job cuts the blank key into, without counting it: it is the one key known to be hot on both.
BLANK_PARTS = 16

_ROW, _COLUMN, _ID = "_grid_row", "_grid_column", "_pair_id"


def heavy_keys(df: DataFrame, hot_rows: int) -> DataFrame:
    """(name key, n): at most HOT_KEYS keys that hold about ``hot_rows`` rows or more, by a mergeable sketch in one pass over the keys."""
    top = df.agg(F.expr(f"approx_top_k({NAME_KEY}, {HOT_KEYS}, {HOT_TRACKED})").alias("top")).select(F.explode("top").alias("t"))
    return top.select(F.col("t.item").alias(NAME_KEY), F.col("t.count").alias("n")).where(F.col("n") >= hot_rows)


def gridded(left: DataFrame, right: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a row and a column of a grid to join on beside the name key.

    A key that is hot on either side is cut into parts of about ``hot_rows`` rows there. Its rows on the left have the grid row of
    their part and are repeated for each grid column, those on the right have the column of theirs and are repeated for each row, so
    each pair meets in one cell and no cell has more than about ``hot_rows`` rows of a side. Other keys have one cell. Both sides ask the same
    sketches, so a count that is somewhat off changes the size of cells and no pair.
    """
    sides = [heavy_keys(df, hot_rows).select(NAME_KEY, F.ceil(F.col("n") / hot_rows).cast("int").alias(name)) for df, name in ((left, "_rows"), (right, "_columns"))]
    hot = F.broadcast(sides[0].join(sides[1], NAME_KEY, "full_outer"))  # a row per hot key, 2 * HOT_KEYS at most
    rows, columns = (F.coalesce(F.col(c), F.lit(1)) for c in ("_rows", "_columns"))

    met = [df.join(hot, NAME_KEY, "left") for df in (left, right)]
    cells = _cut(met[0], left.columns, _ROW, rows, _COLUMN, columns), _cut(met[1], right.columns, _COLUMN, columns, _ROW, rows)
    return cells[0].drop("_rows", "_columns"), cells[1].drop("_rows", "_columns")


def _cut(df: DataFrame, columns: list[str], own: str, parts: Column, other: str, repeats: Column) -> DataFrame:
    """Each row in the part of its own that its columns say, once for each part of the other side."""
    part = F.when(parts > 1, F.pmod(F.xxhash64(*columns), parts)).otherwise(F.lit(0)).cast("int")
    return df.withColumns({own: part, other: F.explode(F.sequence(F.lit(0), repeats - 1))})


def blank_gridded(left: DataFrame, right: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """As ``gridded``, but the blank key alone is cut, into ``parts`` on either side, and no key is counted."""
    count = F.when(F.col(NAME_KEY) == "", F.lit(parts)).otherwise(F.lit(1))
    return _cut(left, left.columns, _ROW, count, _COLUMN, count), _cut(right, right.columns, _COLUMN, count, _ROW, count)


def blank_rows(df: DataFrame) -> DataFrame:
    """The cleaned rows whose name leaves an empty match key."""
    return df.filter(match_key(F.col("corporate_name_clean")) == "")


def resolve_entities(
    s1: DataFrame, s2: DataFrame, drop_blank_keys: bool = False, hot_rows: int | None = None, blank_parts: int = 0
) -> DataFrame:
    """Every pair of cleaned rows with the same name key, and its id.

    Rows without a name share the blank key and pair with each other, which is what the match
    rule says; ``drop_blank_keys`` leaves them out (``blank_rows`` gives them). Keys that hold ``hot_rows`` rows or
    more on either side are cut into a grid of parts (None: no key is, and the keys are not counted); else the join strategy is the planner's: it
    broadcasts a side whose size is under its threshold, else sorts and merges, and adaptive execution splits large partitions.
    The pairs of the blank key grow with the square of its rows, which the size of a partition does not show: ``blank_parts`` cuts each side of it
    into so many parts. With ``hot_rows`` it is counted and cut as the others are.
    """
    left, right = with_keys(s1, address=True), with_keys(s2, address=False)
    if drop_blank_keys:
        left, right = left.filter(F.col(NAME_KEY) != ""), right.filter(F.col(NAME_KEY) != "")
    clashing = (set(left.columns) & set(right.columns)) - {NAME_KEY}
    left, right, on = _suffixed(left, clashing, "s1"), _suffixed(right, clashing, "s2"), [NAME_KEY]
    # The id hangs on the left row alone: one per row, however many pairs it has.
    left = left.withColumn(_ID, corporate_id(F.col(NAME_KEY), F.col(ADDRESS_KEY)))
    if hot_rows:
        left, right, on = *gridded(left, right, hot_rows), [NAME_KEY, _ROW, _COLUMN]
    elif blank_parts and not drop_blank_keys:
        left, right, on = *blank_gridded(left, right, blank_parts), [NAME_KEY, _ROW, _COLUMN]
    joined = left.join(right, on, "inner").drop(_ROW, _COLUMN)
    return joined.withColumn("corporate_id", F.col(_ID)).drop(_ID)


def _key_counts(df: DataFrame, raw_name: str, side: str) -> DataFrame:
    key = match_key(F.col("corporate_name_clean")).alias(NAME_KEY)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"rows_{side}"), F.count(raw_name).alias(f"named_{side}")
    )


def key_overlap(s1: DataFrame, s2: DataFrame) -> DataFrame:
    """Rows, and rows with a raw name, of each side per name key.

    Counting before joining leaves one row per key and side, so a key that holds many rows
    costs no more than any other and no pair of rows is ever formed.
    """
    return _key_counts(s1, "corporate_name_S1", "s1").join(
        _key_counts(s2, "corporate_name_S2", "s2"), NAME_KEY, "full_outer"
    )


def match_diagnostics(s1: DataFrame, s2: DataFrame) -> DataFrame:
    """One row: how a full outer join on the name key falls into matched, one-sided and unnamed rows."""
    return summarize_overlap(key_overlap(s1, s2))


def summarize_overlap(overlap: DataFrame) -> DataFrame:
    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(19,0)")

    n1, n2, named1, named2 = count("rows_s1"), count("rows_s2"), count("named_s1"), count("named_s2")
    unnamed1, unnamed2 = n1 - named1, n2 - named2
    both = (n1 > 0) & (n2 > 0)

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias(name)

    return overlap.agg(
        # A key held by one side only makes one row of the outer join per row it has.
        total(F.when(both, named1 * named2).otherwise(F.lit(0)), "matched"),
        total(F.when(both, named1 * unnamed2).otherwise(named1), "s1_only"),
        total(F.when(both, unnamed1 * named2).otherwise(named2), "s2_only"),
        total(F.when(both, unnamed1 * unnamed2).otherwise(unnamed1 + unnamed2), "neither"),
        F.coalesce(F.sum("rows_s1"), F.lit(0)).alias("s1_rows"),
        F.coalesce(F.sum("rows_s2"), F.lit(0)).alias("s2_rows"),
    )
