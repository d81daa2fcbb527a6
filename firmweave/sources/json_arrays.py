"""Large files of one top-level JSON array, read by many tasks.

Spark's text scan cuts a file at every closing brace, wherever its splits begin. Whether a piece begins inside a string, and how
deep in brackets, follows from all pieces before it: each split is summed up for both cases, a prefix over the splits (a row each) tells the
case of every split, and windows within a split that of every piece. A record ends where a brace brings the depth back to that of
the array. Nearly every record is one piece; those of several, with braces in strings or objects in objects, are put together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.storage import stage

CUT = "}"
_SPLIT = ["file", "block"]


def _outside(piece: Column, inside: bool) -> Column:
    """What of a piece without escapes stands outside strings, if it begins inside one or not."""
    if inside:
        piece = F.regexp_replace(piece, r'^[^"]*("|$)', "")
    return F.regexp_replace(piece, r'"[^"]*("|$)', "")


def _depth(outside: Column) -> Column:
    return F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", ""))


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (its split), id (order in it), piece, odd (quotes, 0 or 1), and the change of depth with the brace after it: d0 if
    the piece begins outside strings, d1 if inside."""
    text = spark.read.text(paths, lineSep=CUT).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("piece")
    )
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    quotes = F.length(plain) - F.length(F.regexp_replace(plain, '"', ""))
    odd = (quotes % 2).cast("int")
    # The brace counts if what is before it leaves no string open.
    d0 = _depth(_outside(plain, False)) - F.when(odd == 0, 1).otherwise(0)
    d1 = _depth(_outside(plain, True)) - F.when(odd == 1, 1).otherwise(0)
    return text.withColumns({"odd": odd, "d0": d0, "d1": d1})


def _before(value: Column, order: Window) -> Column:
    return F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _in_split(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with opens (they begin a record or what is around records), ends (a record ends at their brace), and ended (records before, in the split)."""
    order = Window.partitionBy(*_SPLIT).orderBy("id")
    rows = pieces.join(states, _SPLIT)
    rows = rows.withColumn("inside", (F.col("state") + _before(F.col("odd"), order)) % 2)
    rows = rows.withColumn("change", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    rows = rows.withColumn("depth", F.col("deep") + _before(F.col("change"), order))
    after = F.col("depth") + F.col("change")
    ends = (after == 1) & ((F.col("inside") + F.col("odd")) % 2 == 0)
    rows = rows.withColumns({"opens": (F.col("depth") <= 1) & (F.col("inside") == 0), "ends": ends, "after": after})
    return rows.withColumn("ended", _before(F.col("ends").cast("long"), order))


def read_json_array(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The records of files of one top-level array each. A ``ValueError`` if a file is not one whole array; a record that does not fit
    the schema stops the read. What is read is written once as Parquet, so that pieces keep their order."""
    pieces = stage(_pieces(spark, paths), "json-pieces")
    order = Window.partitionBy(*_SPLIT).orderBy("id")
    marks = pieces.select(*_SPLIT, "id", "odd", "d0", "d1").withColumn("turned", _before(F.col("odd"), order) % 2)
    sums = {
        name: F.sum(F.when(F.col("turned") == start, F.col("d0")).otherwise(F.col("d1"))).alias(name) for name, start in (("outer", 0), ("inner", 1))
    }
    splits = marks.groupBy(*_SPLIT).agg((F.sum("odd") % 2).alias("odd"), *sums.values())
    by_block = Window.partitionBy("file").orderBy("block")
    splits = splits.withColumn("state", _before(F.col("odd"), by_block) % 2)
    splits = splits.withColumn("change", F.when(F.col("state") == 0, F.col("outer")).otherwise(F.col("inner")))
    states = stage(splits.withColumn("deep", _before(F.col("change"), by_block)), "json-splits")  # a row per split
    # The text after the last record counts a brace that is not there, so a whole array ends at -1.
    whole = states.groupBy("file").agg(F.sum("odd").alias("odd"), F.sum("change").alias("change"))
    broken = whole.where("odd % 2 <> 0 or change <> -1").select("file").limit(5).collect()
    if broken:
        raise ValueError(f"not one whole JSON array: {[r.file for r in broken]}")
    states = states.select(*_SPLIT, "state", "deep")
    ends = _in_split(pieces.select(*_SPLIT, "id", "odd", "d0", "d1"), states).groupBy(*_SPLIT).agg(F.sum(F.col("ends").cast("long")).alias("ends"))
    firsts = stage(ends.withColumn("first", _before(F.col("ends"), by_block)).select(*_SPLIT, "first"), "json-firsts")
    rows = _in_split(pieces, states).join(firsts, _SPLIT).withColumn("record", F.col("first") + F.col("ended"))
    # A record after another one begins with a comma; one that does not is made unreadable.
    comma = F.col("piece").rlike(r"^\s*,")
    text = F.when(F.col("depth") == 0, F.regexp_replace("piece", r"^[\s\x{feff}]*\[", "")).when(~F.col("opens") | (F.col("after") < 0), F.col("piece"))
    text = text.when(comma, F.regexp_replace("piece", r"^\s*,", "")).otherwise(F.concat(F.lit("!"), "piece"))
    rows = stage(rows.select("file", "block", "id", "record", "opens", "ends", "after", text.alias("text")), "json-records")
    single = rows.where("opens and ends").select("text")
    parts = rows.where("not (opens and ends) and after >= 0").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "id", "text"))).alias("parts"))  # one record's
    several = parts.select(F.array_join(F.transform("parts", lambda p: p["text"]), CUT).alias("text"))
    # Between the last brace of the array and its end nothing but the bracket may stand.
    rest = rows.where("after < 0").select(F.col("text").alias("text")).where(~F.col("text").rlike(r"^\s*\]\s*$"))
    found = reduce(DataFrame.unionAll, (single, several)).select(F.concat("text", F.lit(CUT)).alias("text")).unionAll(rest)
    record = F.from_json(F.trim(F.translate("text", "\n\r\t", "   ")), schema, {"mode": "FAILFAST"})
    return found.select(record.alias("r")).select("r.*")
