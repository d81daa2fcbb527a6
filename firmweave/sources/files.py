"""Parquet, CSV and JSON scans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.schemas import SOURCE1, SOURCE2, text_lists, text_numbers
from firmweave.sources.json_arrays import CUT, read_json_array
from firmweave.storage import file_size

FORMATS = ("parquet", "csv", "json")
JSON_LAYOUTS = ("auto", "lines", "array")
#: Files that Spark cannot split.
COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")

# CSV cells that mean a missing value.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def resolve_format(uri: str, file_format: str = "auto") -> str:
    """Explicit format, or by suffix, Parquet where the suffix says nothing."""
    if file_format == "auto":
        path = uri.rstrip("/")
        return next((f for f in FORMATS if path.endswith(f".{f}")), "parquet")
    if file_format.lower() not in FORMATS:
        raise ValueError(f"no reader for format {file_format!r}, only for {FORMATS}")
    return file_format.lower()


def read_parquet(spark: SparkSession, uri: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan Parquet. The files state their own types unless a schema is given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(uri)


def read_csv(spark: SparkSession, uri: str, multiline: bool = False) -> DataFrame:
    """Scan CSV by header name, every column as text; the cleaning step parses numbers and lists.

    ``multiline`` allows line breaks inside quoted values. It keeps a file from being split
    across tasks, so it is off unless the data needs it.
    """
    df = spark.read.csv(
        uri, header=True, quote='"', escape='"', multiLine=multiline, encoding="UTF-8", mode="FAILFAST"
    )
    return df.select(*[F.when(~F.col(f"`{c}`").isin(*CSV_MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns])


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a file that Spark reads as one split."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def json_array_files(spark: SparkSession, uri: str) -> tuple[list[str], list[str]]:
    """The files of a dataset that hold JSON Lines, and those that hold one top-level array.

    Each file is judged by its own first character that is not blank; a file without one is of the first kind. The
    file names, which the driver lists for any scan, come back to it, and nothing of their content does.
    """
    # Cut at braces, a row is no longer than a record, also where a file is one line.
    lines = spark.read.text(uri, lineSep=CUT).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # The first split of a file is read in order by one task, so its first row is the file's first.
    mark = F.regexp_extract("value", r"[^\s\x{feff}]", 0)
    first = lines.filter(F.col("file_block_start") == 0).withColumn("mark", mark).filter("mark <> ''").groupBy("file_path")
    kinds = first.agg((F.first("mark") == "[").alias("array")).collect()
    jvm = spark._jvm

    def path(text: str) -> str:
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(text)).toString()

    return [path(r.file_path) for r in kinds if not r.array], [path(r.file_path) for r in kinds if r.array]


def read_json(spark: SparkSession, uri: str, schema: T.StructType, layout: str = "auto") -> DataFrame:
    """Scan JSON Lines, which Spark splits across tasks, or files of one top-level array.

    ``layout`` is lines, array, or auto: then every file is looked at, and the two kinds are read apart and united. An array
    in a file that Spark would cut into several splits is read by several tasks, a smaller one by one. A value that does not
    fit the schema, or a file of the other layout, stops the read rather than turning into NULL.
    """
    if layout not in JSON_LAYOUTS:
        raise ValueError(f"JSON layout must be one of {JSON_LAYOUTS}, not {layout}")
    if layout == "lines":
        return spark.read.json(uri, schema=schema, mode="FAILFAST")
    lines, arrays = json_array_files(spark, uri)
    if layout == "array":
        lines, arrays = [], [*lines, *arrays]
    sizes = {p: file_size(spark, p) for p in arrays}
    large = [p for p in arrays if sizes[p] > split_bytes(spark) and not p.endswith(COMPRESSED)]
    small = [p for p in arrays if p not in set(large)]
    read = [spark.read.json(p, schema=schema, multiLine=m, mode="FAILFAST") for p, m in ((lines, False), (small, True)) if p]
    if large:
        read.append(read_json_array(spark, large, schema))
    return reduce(DataFrame.unionAll, read) if read else spark.createDataFrame([], schema)


@dataclass(frozen=True)
class ReadOptions:
    """How a source is read: its format, and what its CSV or JSON files may hold."""

    file_format: str = "auto"
    multiline: bool = False
    json_layout: str = "auto"
    lists_as_text: bool = False


def read_source(spark: SparkSession, uri: str, schema: T.StructType, options: ReadOptions = ReadOptions()) -> DataFrame:
    """Scan a dataset in whichever format it has. ``schema`` types the JSON fields.

    With ``lists_as_text`` the list columns of JSON are text, as CSV has them and as this engine's own JSON export
    writes them, and the cleaning step applies its text rule.
    """
    resolved = resolve_format(uri, options.file_format)
    if resolved == "csv":
        return read_csv(spark, uri, options.multiline)
    if resolved == "json":
        layout = text_numbers(text_lists(schema) if options.lists_as_text else schema)
        return read_json(spark, uri, layout, options.json_layout)
    return read_parquet(spark, uri)


def extract_source1(spark: SparkSession, uri: str, options: ReadOptions = ReadOptions()) -> DataFrame:
    """Supply-chain dataset."""
    return read_source(spark, uri, SOURCE1, options)


def extract_source2(spark: SparkSession, uri: str, options: ReadOptions = ReadOptions()) -> DataFrame:
    """Financial dataset."""
    return read_source(spark, uri, SOURCE2, options)
