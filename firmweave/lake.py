"""Lake tables: scan, append, keyed upsert, compaction and the fallback write.

With a catalog name the table belongs to that Spark catalog (Iceberg, for one) and Spark's own
table API does the work. Without one a table is a folder of Parquet files and a commit list (see ``commits``):
a write first puts its files in a folder of its own and then commits them, so readers see all of it or nothing, a failed
write leaves no row, and of two writers the later one takes the earlier one's commit into account. A write that brings a batch
token adds nothing if that batch is in the table already.

An upsert needs the rows of an id together. It lays a table out in hash buckets of the id, a folder each, and from then on reads
and writes only the buckets that have incoming ids; the files of the others stay as they are.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave import commits
from firmweave.commits import DataFile, Layout, Version
from firmweave.functions.numbers import load_date
from firmweave.functions.text import match_key
from firmweave.sinks.files import load_dataset
from firmweave.storage import child_names, delete, file_sizes, join_uri

KEY = "corporate_id"
NEWEST_BY = ("processed_date",)
#: Which of two equally new rows wins: the one with more revenue, then profit.
TIES = ("revenue", "profit")
FALLBACK_FOLDER = "iceberg_fallback"

#: Versions that stay readable after an upsert: the current one and the one that readers may still be on.
VERSIONS_KEPT = 2
#: Hash buckets of the id in a table that its first upsert lays out. A bucket should fit a few tasks: give more for a large table.
BUCKETS = 64
#: Compaction leaves files of about so many bytes, and leaves alone those of half as many.
FILE_BYTES = 256 << 20
#: How often a write is tried while others commit before it.
ATTEMPTS = 50

_DATA, _WRITE, _BUCKET = "data", "_write", "_bucket"


def split_table_name(name: str) -> tuple[str, str]:
    """Database and table, split at the first dot; database ``default`` where there is none."""
    database, dot, table = name.partition(".")
    return (database, table) if dot else ("default", name)


@dataclass(frozen=True)
class LakeTable:
    """A table by name, below a root folder or in a catalog."""

    name: str
    root: str = ""
    catalog: str = ""

    @property
    def identifier(self) -> str:
        database, table = split_table_name(self.name)
        return ".".join(f"`{part}`" for part in (self.catalog, database, *table.split(".")))

    @property
    def uri(self) -> str:
        if not self.root:
            raise ValueError(f"table {self.name} has neither a catalog nor a root folder")
        return join_uri(self.root, *split_table_name(self.name))

    @property
    def short_name(self) -> str:
        return split_table_name(self.name)[1]


def table_version(spark: SparkSession, table: LakeTable) -> Version | None:
    """The newest committed version of a folder table, nothing if there is none."""
    return commits.current(spark, table.uri)


def _refuse_other_layout(rows: DataFrame, partition_key: str, stored: Layout, table: LakeTable) -> None:
    """Rows that the table's readers would not see whole must not be written to it."""
    has = {f.name: f.dataType for f in rows.schema}
    wants = {f.name: f.dataType for f in stored.schema}
    if has != wants or partition_key != stored.partition_key:
        odd = sorted(n for n in has.keys() | wants.keys() if has.get(n) != wants.get(n))
        raise ValueError(
            f"table {table.name} is partitioned by {stored.partition_key or 'nothing'} and the rows by {partition_key or 'nothing'}; "
            f"columns that differ: {odd or 'none'}"
        )


def table_exists(spark: SparkSession, table: LakeTable) -> bool:
    if table.catalog:
        return spark.catalog.tableExists(table.identifier)
    return table_version(spark, table) is not None


def _read_files(spark: SparkSession, table: LakeTable, layout: Layout, files: Sequence[DataFile]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], layout.schema)
    reader = spark.read.schema(layout.schema).option("basePath", join_uri(table.uri, _DATA))
    return reader.parquet(*[join_uri(table.uri, f.path) for f in files]).select(*layout.schema.names)


def read_table(spark: SparkSession, table: LakeTable) -> DataFrame:
    """Full-table scan of the newest version; filters and column choice made on it reach the files."""
    if table.catalog:
        return spark.table(table.identifier)
    version = table_version(spark, table)
    if version is None:
        raise FileNotFoundError(f"table {table.name} has no commit under {table.uri}")
    return _read_files(spark, table, version.layout, list(version.files.values()))


def _table_form(df: DataFrame, partition_key: str) -> DataFrame:
    """Lists as JSON text, and today's date for a partition column the rows lack."""
    lists = {f.name: F.to_json(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    if partition_key and partition_key not in df.columns:
        lists[partition_key] = load_date()
    return df.withColumns(lists) if lists else df


def _layout_of(df: DataFrame, partition_key: str, buckets: int) -> Layout:
    taken = {_WRITE, _BUCKET} & set(df.columns)
    if taken:
        raise ValueError(f"a table cannot have columns named {sorted(taken)}")
    return Layout(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema]), partition_key, buckets)


def bucket_of(key: str, buckets: int) -> Column:
    """The hash bucket of an id; the same in every session and version."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class _Write:
    """The files of one write, in a folder of their own until a commit names them."""

    def __init__(self, df: DataFrame, table: LakeTable, layout: Layout, key: str, files: int = 0) -> None:
        """``files``: about so many, each of the same size; else as Spark's partitions are, those of a bucket together."""
        self.spark, self.layout = df.sparkSession, layout
        self.uri = join_uri(table.uri, _DATA, f"{_WRITE}={uuid.uuid4().hex}")
        rows, folders = df.select(*layout.schema.names), []
        if layout.buckets:
            rows, folders = rows.withColumn(_BUCKET, bucket_of(key, layout.buckets)), [_BUCKET]
            rows = rows.hint("rebalance", F.col(_BUCKET))  # small buckets share a task, a large one is split
        elif files:
            rows = rows.repartition(files)
        if layout.partition_key:
            folders.append(layout.partition_key)
        try:
            (rows.write.partitionBy(*folders) if folders else rows.write).parquet(self.uri)
        except BaseException:
            self.discard()
            raise
        self.files = []
        for name, size in file_sizes(self.spark, self.uri, ".parquet").items():
            bucket = int(name.split("/")[0].removeprefix(f"{_BUCKET}=")) if layout.buckets else None
            self.files.append(DataFile(join_uri(_DATA, self.uri.rsplit("/", 1)[1], name), size, bucket))

    def discard(self) -> None:
        delete(self.spark, self.uri)


def append_table(df: DataFrame, table: LakeTable, partition_key: str = "", batch: str = "", key: str = KEY) -> bool:
    """Add the rows to the table, creating a folder table that does not exist yet; False if ``batch`` is in it already.

    A ``ValueError`` and no write if the rows differ from the table in columns, types or partition column. ``batch`` names the
    rows, for a job that may be run again (a scheduler's run, for one); without it every call adds rows. If other writers commit first,
    the files are committed after theirs; they are written again only if the table has got other buckets meanwhile."""
    spark = df.sparkSession
    rows = _table_form(df, partition_key)
    if table.catalog:
        if batch:
            raise ValueError("batch tokens are kept by folder tables only")
        rows.writeTo(table.identifier).append()
        return True
    written = None
    try:
        for _ in range(ATTEMPTS):
            version = table_version(spark, table)
            if version is None:
                layout = _layout_of(rows, partition_key, 0)
            else:
                layout = version.layout
                if batch and batch in version.batches:
                    return False
                _refuse_other_layout(rows, partition_key, layout, table)
            if written is None or written.layout.buckets != layout.buckets:
                if written is not None:
                    written.discard()
                written = _Write(rows, table, layout, key)
            if commits.commit(spark, table.uri, version, layout, written.files, batch=batch):
                written = None
                return True
        raise RuntimeError(f"table {table.name}: other writers were first {ATTEMPTS} times")
    finally:
        if written is not None:
            written.discard()


def newest_per_key(df: DataFrame, key: str | Sequence[str] = KEY, newest_by: tuple[str, ...] = NEWEST_BY) -> DataFrame:
    """One row per key: the newest, ties settled by the other columns.

    The rank limit is also applied before the shuffle, so each task sends on one row per key
    however many rows a key has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in newest_by] + rest
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _identity(df: DataFrame, key: str) -> dict[str, Column]:
    """What makes two rows the same company: the id, and what it is a short hash of where the rows have it."""
    parts = {"_key": F.col(key)}
    if key == KEY and {"corporate_name", "address"} <= set(df.columns):
        parts |= {"_name": match_key(F.col("corporate_name")), "_address": match_key(F.col("address"))}
    return parts


def merge_condition(columns: Sequence[str], target: str, key: str = KEY) -> Column:
    """Whether a stored row (of ``target``) and one of the batch (alias ``s``) are the same company: as ``upsert_table`` tells them."""
    same = F.col(f"{target}.`{key}`") == F.col(f"s.`{key}`")
    if key == KEY and {"corporate_name", "address"} <= set(columns):
        for name in ("corporate_name", "address"):
            same = same & (match_key(F.col(f"{target}.`{name}`")) == match_key(F.col(f"s.`{name}`")))
    return same


def upsert_table(
    df: DataFrame,
    table: LakeTable,
    key: str = KEY,
    newest_by: tuple[str, ...] = NEWEST_BY,
    partition_key: str | None = None,
    batch: str = "",
    buckets: int = BUCKETS,
) -> bool:
    """Bring rows and table together and keep the newest row of each company, one row each; False if ``batch`` is in the table already.

    Newest is by ``newest_by``, so a late batch with older rows changes nothing. Where that ties, a row of the batch
    goes before a stored one, then the higher ``revenue``, then the higher ``profit`` where there are such columns,
    then the other columns in falling order. Rows whose key is NULL are refused. An existing table keeps
    its partition column and its buckets; the first upsert of a table without buckets lays all of it out in ``buckets`` of them, later ones
    read and write the buckets that have incoming keys. If another writer commits first, the merge is made again on its version.
    ``df`` is read more than once, so give a frame that is cheap to read again, such as a written dataset.
    """
    spark = df.sparkSession
    version = None if table.catalog else table_version(spark, table)
    if partition_key is None:
        partition_key = version.layout.partition_key if version else ""
    rows = _table_form(df, partition_key)
    if not rows.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key} cannot be upserted")
    ties = tuple(c for c in TIES if c in rows.columns)
    identity = _identity(rows, key)
    if table.catalog:
        if batch:
            raise ValueError("batch tokens are kept by folder tables only")
        target = f"`{table.short_name.split('.')[-1]}`"
        newest = " AND ".join(f"coalesce(s.`{c}` >= {target}.`{c}`, true)" for c in newest_by)
        latest = newest_per_key(rows.withColumns(identity), list(identity), (*newest_by, *ties)).drop(*identity)
        (
            latest.alias("s")
            .mergeInto(table.identifier, merge_condition(rows.columns, target, key))
            .whenMatched(F.expr(newest)).updateAll()
            .whenNotMatched().insertAll()
            .merge()
        )
        return True
    for _ in range(ATTEMPTS):
        version = table_version(spark, table)
        both, old = rows.withColumn("_batch", F.lit(1)), []
        if version is None:
            layout = _layout_of(rows, partition_key, buckets)
        else:
            layout = version.layout
            if batch and batch in version.batches:
                return False
            _refuse_other_layout(rows, partition_key, layout, table)
            old = list(version.files.values())
            if layout.buckets:
                met = rows.select(bucket_of(key, layout.buckets).alias("b")).distinct().collect()  # a number per bucket at most
                touched = {r.b for r in met}
                old = [f for f in old if f.bucket in touched]
            else:
                layout = Layout(layout.schema, layout.partition_key, buckets)
            both = both.unionByName(_read_files(spark, table, layout, old).withColumn("_batch", F.lit(0)))
        merged = newest_per_key(both.withColumns(identity), list(identity), (*newest_by, "_batch", *ties))
        written = _Write(merged, table, layout, key)
        try:
            done = commits.commit(spark, table.uri, version, layout, written.files, [f.path for f in old], batch)
        except BaseException:
            written.discard()
            raise
        if done:
            commits.expire(spark, table.uri, VERSIONS_KEPT)
            return True
        written.discard()
    raise RuntimeError(f"table {table.name}: other writers were first {ATTEMPTS} times")


def compact_table(spark: SparkSession, table: LakeTable, file_bytes: int = FILE_BYTES, key: str = KEY) -> int:
    """Rewrite files of less than half of ``file_bytes`` into files of about that size, those of a bucket together; the number of files
    that were rewritten. Readers see the same rows before and after; if another writer commits first, the rest is looked at anew.

    The sizes are those in the commit list. A bucket, or a table without buckets, that has a single small file is left alone."""
    if table.catalog:
        raise ValueError("a catalog compacts its own tables")
    for _ in range(ATTEMPTS):
        version = table_version(spark, table)
        if version is None:
            return 0
        groups: dict[int | None, list[DataFile]] = {}
        for f in version.files.values():
            if f.size < file_bytes / 2:
                groups.setdefault(f.bucket, []).append(f)
        small = [f for group in groups.values() if len(group) > 1 for f in group]
        if not small:
            return 0
        count = max(1, -(-sum(f.size for f in small) // file_bytes))
        written = _Write(_read_files(spark, table, version.layout, small), table, version.layout, key, count)
        try:
            done = commits.commit(spark, table.uri, version, version.layout, written.files, [f.path for f in small])
        except BaseException:
            written.discard()
            raise
        if done:
            commits.expire(spark, table.uri, VERSIONS_KEPT)
            return len(small)
        written.discard()
    raise RuntimeError(f"table {table.name}: other writers were first {ATTEMPTS} times")


def remove_uncommitted(spark: SparkSession, table: LakeTable) -> list[str]:
    """Remove the folders of writes that no kept version names, as killed jobs leave them. No write may be going on meanwhile."""
    version = table_version(spark, table)
    named = set()
    if version:
        paths = [*version.files, *(p for n, ps in version.dropped.items() if n > version.number - VERSIONS_KEPT + 1 for p in ps)]
        named = {p.split("/")[1] for p in paths}
    gone = [n for n in child_names(spark, join_uri(table.uri, _DATA)) if n not in named]
    for name in gone:
        delete(spark, join_uri(table.uri, _DATA, name))
    return gone


def load_with_fallback(
    df: DataFrame,
    table: LakeTable,
    fallback_uri: str,
    mode: str = "append",
    partition_key: str = "",
    timestamp: str | None = None,
    batch: str = "",
    buckets: int = BUCKETS,
) -> str | None:
    """Append or upsert; if Spark cannot, log why, write the rows as Parquet and return that URI.

    A ``batch`` that is in the table already is not written again. Rows that do not fit the table (``ValueError``) are the caller's to mend and are not written elsewhere.
    """
    if mode not in ("append", "upsert"):
        raise ValueError(f"table mode must be append or upsert, not {mode}")
    try:
        if mode == "append":
            append_table(df, table, partition_key, batch)
        else:
            upsert_table(df, table, partition_key=partition_key or None, batch=batch, buckets=buckets)
    except (PySparkException, Py4JError) as error:
        logging.getLogger(__name__).warning("table %s not written, falling back to Parquet: %s", table.name, error)
        folder = join_uri(fallback_uri, FALLBACK_FOLDER)
        return load_dataset(df, folder, f"{table.short_name}_backup", timestamp=timestamp)
    return None
