"""Queries over the two sources and the registry: scans, cleaning, matching, reports, writes."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.catalog import duck, fixtures
from firmweave.catalog.fixtures import DATE, with_views
from firmweave.catalog.query import QuerySet
from firmweave.catalog.value_queries import shown
from firmweave.config import EtlConfig
from firmweave.lake import LakeTable, append_table, compact_table, load_with_fallback, read_table, upsert_table
from firmweave.operators.clean import clean_source1, clean_source2
from firmweave.operators.harmonize import fill_defaults, harmonize
from firmweave.operators.quality import null_profile, quality_report, stage_counts
from firmweave.operators.resolve import match_diagnostics, resolve_entities
from firmweave.plans.etl import EtlResult, build_registry, run_etl
from firmweave.schemas import REGISTRY, SOURCE1, SOURCE2
from firmweave.sinks.files import load_dataset, load_registry, prepare_for_export, write_dataset
from firmweave.sources import files
from firmweave.sources.json_arrays import read_json_array
from firmweave.storage import join_uri, scratch_dir, stage

QUERIES = QuerySet()

STAMP = "20260115_060000"
REGISTRY_COLUMNS = ", ".join(REGISTRY.fieldNames())
SQL_REGISTRY = with_views(f"SELECT {REGISTRY_COLUMNS} FROM registry", "registry")


def flat(df: DataFrame) -> DataFrame:
    """List columns as text."""
    lists = {f.name: shown(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns(lists) if lists else df


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the types of a layout."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


_SQL_SOURCE1 = with_views(
    f"SELECT corporate_name_S1, address, {duck.shown('activity_places')} AS activity_places, "
    f"{duck.shown('top_suppliers')} AS top_suppliers FROM src1", "src1",
)
_SQL_SOURCE2 = with_views(
    f"SELECT corporate_name_S2, {duck.shown('main_customers')} AS main_customers, revenue, profit FROM src2", "src2"
)


def source_files(spark: SparkSession, sf_dir: str) -> dict[str, tuple[str, DataFrame]]:
    """Both sources written as the input files of a job, by name with their scans."""
    base = scratch_dir(spark, "input")
    uris = {"source1": join_uri(base, EtlConfig.source1_uri), "source2": join_uri(base, EtlConfig.source2_uri)}
    write_dataset(fixtures.source1(spark, sf_dir), uris["source1"])
    write_dataset(fixtures.source2(spark, sf_dir), uris["source2"])
    return {
        "source1": (uris["source1"], files.extract_source1(spark, uris["source1"])),
        "source2": (uris["source2"], files.extract_source2(spark, uris["source2"])),
    }


def written_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as an ETL run leaves it, for what reads it more than once."""
    uri = load_registry(fixtures.registry(spark, sf_dir), scratch_dir(spark, "registry"), timestamp=STAMP)
    return files.read_parquet(spark, uri)


# --- scans -------------------------------------------------------------------------------------


@QUERIES.add("src_parquet", _SQL_SOURCE1)
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.source1(spark, sf_dir), scratch_dir(spark, "src_parquet"), "parquet")
    return flat(files.read_parquet(spark, uri, SOURCE1))


@QUERIES.add("src_csv", with_views(
    "SELECT corporate_name_S2, array_to_string(main_customers, '; ') AS main_customers, revenue, profit FROM src2",
    "src2"))
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.source2(spark, sf_dir), scratch_dir(spark, "src_csv"), "csv")
    money = {c: F.col(c).cast("double") for c in ("revenue", "profit")}
    return files.read_csv(spark, uri).withColumns(money)


@QUERIES.add("src_json", _SQL_SOURCE2)
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.source2(spark, sf_dir), scratch_dir(spark, "src_json"), "json")
    return flat(files.read_json(spark, uri, SOURCE2))


@QUERIES.add("src_json_array", _SQL_SOURCE2)
def src_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one top-level array, cut into records by the reader that several tasks share."""
    uri = scratch_dir(spark, "src_json_array")
    write_json_arrays(stage(fixtures.source2(spark, sf_dir), "derived2"), uri)
    return flat(read_json_array(spark, files.json_array_files(spark, uri)[1], SOURCE2))


@QUERIES.add("src_auto", _SQL_SOURCE1)
def src_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch_dir(spark, "src_auto") + ".json"
    write_dataset(fixtures.source1(spark, sf_dir), uri, "json")
    return flat(files.read_source(spark, uri, SOURCE1))


@QUERIES.add("extract_source1", _SQL_SOURCE1)
def extract_source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = join_uri(scratch_dir(spark, "extract"), EtlConfig.source1_uri)
    write_dataset(fixtures.source1(spark, sf_dir), uri)
    return flat(files.extract_source1(spark, uri))


@QUERIES.add("extract_source2", _SQL_SOURCE2)
def extract_source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = join_uri(scratch_dir(spark, "extract"), EtlConfig.source2_uri)
    write_dataset(fixtures.source2(spark, sf_dir), uri)
    return flat(files.extract_source2(spark, uri))


# --- cleaning and matching ---------------------------------------------------------------------


@QUERIES.add("clean_source1", with_views(
    f"SELECT corporate_name_S1, corporate_name_clean, address_clean, {duck.shown('activity_places_clean')} "
    f"AS activity_places_clean, {duck.shown('top_suppliers_clean')} AS top_suppliers_clean FROM clean1", "clean1"))
def query_clean_source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(
        clean_source1(fixtures.source1(spark, sf_dir)).drop("address", "activity_places", "top_suppliers")
    )


@QUERIES.add("clean_source1_text", with_views(
    f"SELECT corporate_name_S1, {duck.name_clean('corporate_name_S1')} AS corporate_name_clean, "
    f"{duck.squeeze('address')} AS address_clean, {duck.shown(duck.list_delim('activity_places'))} AS "
    f"activity_places_clean, {duck.shown(duck.list_delim('top_suppliers'))} AS top_suppliers_clean FROM src1_text",
    "src1_text"))
def query_clean_source1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(
        clean_source1(fixtures.source1_text(spark, sf_dir)).drop("address", "activity_places", "top_suppliers")
    )


@QUERIES.add("clean_source2", with_views(
    f"SELECT corporate_name_S2, corporate_name_clean, {duck.shown('main_customers_clean')} AS main_customers_clean, "
    "revenue, profit, profit_margin, revenue_category FROM clean2", "clean2"))
def query_clean_source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(clean_source2(fixtures.source2(spark, sf_dir)).drop("main_customers"))


@QUERIES.add("clean_source2_text", with_views(
    f"SELECT *, {duck.margin('revenue', 'profit')} AS profit_margin, {duck.category('revenue')} AS revenue_category "
    f"FROM (SELECT corporate_name_S2, {duck.name_clean('corporate_name_S2')} AS corporate_name_clean, "
    f"{duck.shown(duck.customers_string('main_customers'))} AS main_customers_clean, "
    f"{duck.to_number('revenue')} AS revenue, {duck.to_number('profit')} AS profit FROM src2_text)", "src2_text"))
def query_clean_source2_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(
        clean_source2(fixtures.source2_text(spark, sf_dir))
        .withColumn("main_customers_clean", F.coalesce(F.col("main_customers_clean"), F.array().cast("array<string>")))
        .drop("main_customers")
    )


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_entities(
        clean_source1(fixtures.source1(spark, sf_dir)), clean_source2(fixtures.source2(spark, sf_dir))
    )


@QUERIES.add("resolve_entities", with_views(
    f"SELECT corporate_id, name_key, address_key, corporate_name_S1, corporate_name_S2, corporate_name_clean_s1, "
    f"corporate_name_clean_s2, {duck.shown('activity_places_clean')} AS activity_places_clean, revenue, profit_margin "
    "FROM resolved", "resolved"))
def query_resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(
        _resolved(spark, sf_dir).select(
            "corporate_id", "name_key", "address_key", "corporate_name_S1", "corporate_name_S2",
            "corporate_name_clean_s1", "corporate_name_clean_s2", "activity_places_clean", "revenue", "profit_margin",
        )
    )


@QUERIES.add("harmonize", SQL_REGISTRY)
def query_harmonize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize(_resolved(spark, sf_dir), DATE)


_RESOLVED_COLUMNS = ("corporate_id", "name_key", "address_key", "corporate_name_S1", "corporate_name_S2", "revenue", "profit_margin")
_SQL_HARD_RESOLVED = f"SELECT {', '.join(_RESOLVED_COLUMNS)} FROM hard_resolved"


def _hard_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return clean_source1(fixtures.hard_source1(spark, sf_dir)), clean_source2(fixtures.hard_source2(spark, sf_dir))


@QUERIES.add("resolve_entities_blank_names", with_views(_SQL_HARD_RESOLVED, "hard_resolved"))
def resolve_entities_blank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, blank and repeated names on both sides; small parts, so that the hot blank key is cut."""
    return resolve_entities(*_hard_sources(spark, sf_dir), hot_rows=4).select(*_RESOLVED_COLUMNS)


@QUERIES.add("resolve_entities_named", with_views(f"{_SQL_HARD_RESOLVED} WHERE name_key <> ''", "hard_resolved"))
def resolve_entities_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_entities(*_hard_sources(spark, sf_dir), drop_blank_keys=True).select(*_RESOLVED_COLUMNS)


@QUERIES.add("harmonize_blank_names", with_views(f"SELECT {REGISTRY_COLUMNS} FROM hard_registry", "hard_registry"))
def harmonize_blank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_registry(fixtures.hard_source1(spark, sf_dir), fixtures.hard_source2(spark, sf_dir), DATE)


_FIRST = "substr(corporate_id, 1, 1)"


def _where_id(digits: str, value: Column) -> Column:
    """The value, or NULL where the id starts with one of the digits."""
    return F.when(~F.substring("corporate_id", 1, 1).isin(*digits), value)


@QUERIES.add("fill_defaults", with_views(
    f"""SELECT corporate_id, coalesce(CASE WHEN {_FIRST} NOT IN ('0', '1') THEN corporate_name_S1 END, corporate_name_S2)
          AS corporate_name, coalesce(CASE WHEN {_FIRST} <> '2' THEN address END, '') AS address,
          coalesce(CASE WHEN {_FIRST} <> '3' THEN revenue END, 0.0) AS revenue,
          CASE WHEN {_FIRST} = '4' THEN 0.0 ELSE profit END AS profit, profit_margin,
          coalesce(CASE WHEN {_FIRST} <> '5' THEN revenue_category END, 'Unknown') AS revenue_category FROM resolved""",
    "resolved"))
def query_fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = {
        "corporate_name_S1": _where_id("01", F.col("corporate_name_S1")),
        "address": _where_id("2", F.col("address")),
        "revenue": _where_id("3", F.col("revenue")),
        "profit": F.coalesce(_where_id("4", F.col("profit")), F.lit(float("nan"))),
        "revenue_category": _where_id("5", F.col("revenue_category")),
    }
    return fill_defaults(_resolved(spark, sf_dir).withColumns(gaps)).select(
        "corporate_id", "corporate_name", "address", "revenue", "profit", "profit_margin", "revenue_category"
    )


# --- reports -----------------------------------------------------------------------------------

_SQL_OVERLAP = """
overlap AS (SELECT coalesce(a.k, b.k) AS k, coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2 FROM
  (SELECT {key} AS k, count(*) AS n1 FROM clean1 GROUP BY 1) a FULL OUTER JOIN
  (SELECT {key} AS k, count(*) AS n2 FROM clean2 GROUP BY 1) b ON a.k = b.k)""".format(key=duck.key("corporate_name_clean"))
_SQL_MATCH = """SELECT CAST(sum(n1 * n2) AS BIGINT) AS matched,
  CAST(sum(CASE WHEN n2 = 0 THEN n1 ELSE 0 END) AS BIGINT) AS s1_only,
  CAST(sum(CASE WHEN n1 = 0 THEN n2 ELSE 0 END) AS BIGINT) AS s2_only, CAST(0 AS BIGINT) AS neither FROM overlap"""


def _with_overlap(select: str, *views: str) -> str:
    body = with_views("", "clean1", "clean2", *views).rstrip()
    return f"{body},{_SQL_OVERLAP}\n{select}"


@QUERIES.add("match_diagnostics", _with_overlap(_SQL_MATCH))
def query_match_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = match_diagnostics(
        clean_source1(fixtures.source1(spark, sf_dir)), clean_source2(fixtures.source2(spark, sf_dir))
    )
    return report.select(*[F.col(c).cast("bigint") for c in ("matched", "s1_only", "s2_only", "neither")])


@QUERIES.add("match_diagnostics_blank_names", with_views(
    """SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS matched,
      count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS s1_only, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS s2_only,
      count(*) FILTER (WHERE a IS NULL AND b IS NULL) AS neither FROM
      (SELECT corporate_name_S1 AS a, {key} AS k FROM hard_clean1) FULL OUTER JOIN
      (SELECT corporate_name_S2 AS b, {key} AS k FROM hard_clean2) USING (k)""".format(key=duck.key("corporate_name_clean")),
    "hard_clean1", "hard_clean2"))
def match_diagnostics_blank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = match_diagnostics(*_hard_sources(spark, sf_dir))
    return report.select(*[F.col(c).cast("bigint") for c in ("matched", "s1_only", "s2_only", "neither")])


_GAPS = {"address": "0", "main_customers": "1", "revenue_category": "23"}


def _with_gaps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: _where_id(digits, F.col(c)) for c, digits in _GAPS.items()})


def _sql_null_count(column: str) -> str:
    if column in _GAPS:
        digits = ", ".join(f"'{d}'" for d in _GAPS[column])
        return f"count(*) FILTER (WHERE {column} IS NULL OR {_FIRST} IN ({digits}))"
    return f"count(*) FILTER (WHERE {column} IS NULL)"


@QUERIES.add("null_profile", with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_sql_null_count(c)} AS nulls FROM registry" for c in REGISTRY.fieldNames()
    ), "registry"))
def query_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(_with_gaps(fixtures.registry(spark, sf_dir)))


@QUERIES.add("quality_report", _with_overlap(
    f"SELECT 'resolve' AS stage, unnest(['matched', 's1_only', 's2_only', 'neither']) AS metric, "
    f"unnest([matched, s1_only, s2_only, neither]) AS value FROM ({_SQL_MATCH}) "
    "UNION ALL SELECT 'source1', 'rows', count(*) FROM src1 UNION ALL SELECT 'source2', 'rows', count(*) FROM src2 "
    "UNION ALL SELECT 'registry', 'rows', count(*) FROM registry"
    + "".join(
        f" UNION ALL SELECT 'registry', 'nulls_{c}', {_sql_null_count(c)} FROM registry" for c in REGISTRY.fieldNames()
    ), "registry"))
def query_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    source1, source2 = (df for _, df in source_files(spark, sf_dir).values())
    return quality_report(
        clean_source1(source1), clean_source2(source2), _with_gaps(build_registry(source1, source2, DATE))
    )


# --- file writes -------------------------------------------------------------------------------


@QUERIES.add("sink_parquet", SQL_REGISTRY)
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.registry(spark, sf_dir), scratch_dir(spark, "sink_parquet"), "parquet")
    return files.read_parquet(spark, uri)


@QUERIES.add("sink_csv", SQL_REGISTRY)
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.registry(spark, sf_dir), scratch_dir(spark, "sink_csv"), "csv")
    return typed(files.read_csv(spark, uri), REGISTRY)


@QUERIES.add("sink_json", SQL_REGISTRY)
def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = write_dataset(fixtures.registry(spark, sf_dir), scratch_dir(spark, "sink_json"), "json")
    return files.read_json(spark, uri, REGISTRY)


@QUERIES.add("prepare_export", with_views(
    "SELECT corporate_name_S1, address, array_to_string(activity_places, '; ') AS activity_places, "
    "array_to_string(top_suppliers, '; ') AS top_suppliers FROM src1", "src1"))
def query_prepare_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_for_export(fixtures.source1(spark, sf_dir))


@QUERIES.add("load_dataset", with_views(
    "SELECT corporate_name_S2, array_to_string(main_customers_clean, '; ') AS main_customers_clean, "
    "corporate_name_clean, revenue, profit, profit_margin, revenue_category FROM clean2", "clean2"))
def query_load_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_source2(fixtures.source2(spark, sf_dir)).drop("main_customers")
    uri = load_dataset(cleaned, scratch_dir(spark, "load"), "source2_cleaned", "json", STAMP)
    return files.read_json(spark, uri, prepare_for_export(cleaned).schema)


@QUERIES.add("load_registry", SQL_REGISTRY)
def query_load_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = load_registry(fixtures.registry(spark, sf_dir), scratch_dir(spark, "load"), timestamp=STAMP)
    return files.read_source(spark, uri, REGISTRY)


# --- lake tables -------------------------------------------------------------------------------


def registry_table(spark: SparkSession, name: str = "corporate_db.corporate_registry") -> LakeTable:
    return LakeTable(name, scratch_dir(spark, "lake"))


@QUERIES.add("src_table", SQL_REGISTRY)
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = registry_table(spark)
    append_table(fixtures.registry(spark, sf_dir), lake)
    return read_table(spark, lake)


@QUERIES.add("table_append", with_views(
    f"SELECT {REGISTRY_COLUMNS} FROM registry UNION ALL SELECT {REGISTRY_COLUMNS} FROM registry", "registry"))
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = registry_table(spark)
    rows = written_registry(spark, sf_dir)
    append_table(rows, lake, "processed_date")
    append_table(rows, lake, "processed_date")
    return read_table(spark, lake).select(*REGISTRY.fieldNames())


def _table_updates(df: DataFrame) -> DataFrame:
    """Small firms grown threefold the day after, the same firms as of the day before, and new firms."""
    grown = df.filter("revenue_category = 'Small'").withColumns(
        {"revenue": F.col("revenue") * 3, "processed_date": F.lit("2026-01-16")}
    )
    older = grown.withColumns({"revenue": F.lit(0.0), "processed_date": F.lit("2026-01-14")})
    new = df.filter("revenue_category = 'Enterprise'").withColumn(
        "corporate_id", F.concat(F.lit("n"), F.col("corporate_id"))
    )
    return grown.unionByName(older).unionByName(new)


@QUERIES.add("table_upsert", with_views(
    """SELECT * REPLACE (CASE WHEN revenue_category = 'Small' THEN revenue * 3 ELSE revenue END AS revenue,
        CASE WHEN revenue_category = 'Small' THEN '2026-01-16' ELSE processed_date END AS processed_date) FROM registry
       UNION ALL SELECT * REPLACE ('n' || corporate_id AS corporate_id) FROM registry
       WHERE revenue_category = 'Enterprise'""", "registry"))
def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = registry_table(spark)
    append_table(fixtures.registry(spark, sf_dir), lake)
    updates = write_dataset(_table_updates(read_table(spark, lake)), scratch_dir(spark, "updates"))
    upsert_table(files.read_parquet(spark, updates), lake)
    return read_table(spark, lake)


def _late_updates(df: DataFrame) -> DataFrame:
    """Rows older than the table's, as new as they are, twice in one batch, and of another company under a stored id."""
    late = df.filter("revenue_category = 'Small'").withColumns({"revenue": F.lit(-1.0), "processed_date": F.lit("2026-01-01")})
    tied = df.filter("revenue_category = 'Medium'").withColumn("revenue", F.col("revenue") + 1)
    twice = df.filter("revenue_category = 'Large'").withColumn("processed_date", F.lit("2026-02-01"))
    clash = df.filter("revenue_category = 'Enterprise'").withColumn("corporate_name", F.concat("corporate_name", F.lit(" twin")))
    return late.unionByName(tied).unionByName(twice).unionByName(twice.withColumn("revenue", F.col("revenue") + 7)).unionByName(clash)


@QUERIES.add("table_upsert_late", with_views(
    """SELECT * REPLACE (CASE revenue_category WHEN 'Medium' THEN revenue + 1 WHEN 'Large' THEN revenue + 7 ELSE revenue END AS revenue,
        CASE revenue_category WHEN 'Large' THEN '2026-02-01' ELSE processed_date END AS processed_date) FROM registry
       UNION ALL SELECT * REPLACE (corporate_name || ' twin' AS corporate_name) FROM registry WHERE revenue_category = 'Enterprise'""",
    "registry"))
def table_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = registry_table(spark)
    append_table(fixtures.registry(spark, sf_dir), lake, "processed_date")
    updates = write_dataset(_late_updates(read_table(spark, lake)), scratch_dir(spark, "updates"))
    for _ in range(2):  # a batch that comes again changes nothing
        upsert_table(files.read_parquet(spark, updates), lake)
    return read_table(spark, lake).select(*REGISTRY.fieldNames())


@QUERIES.add("table_append_failed", SQL_REGISTRY)
def table_append_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append and an upsert that break off while some tasks have written already leave the table as it was."""
    lake = registry_table(spark)
    rows = written_registry(spark, sf_dir)
    append_table(rows, lake, "processed_date")
    broken = F.when(F.col("revenue_category") == "Enterprise", F.raise_error(F.lit("broken row"))).otherwise(F.col("source"))
    for write in (append_table, upsert_table):
        try:
            write(rows.withColumn("source", broken.cast("string")), lake, partition_key="processed_date")
        except (PySparkException, Py4JError):
            continue
        raise AssertionError("the write should have failed")
    return read_table(spark, lake).select(*REGISTRY.fieldNames())


@QUERIES.add("table_append_batches", with_views(
    f"""SELECT {REGISTRY_COLUMNS} FROM registry
        UNION ALL SELECT {REGISTRY_COLUMNS} FROM (SELECT * REPLACE ('2026-01-16' AS processed_date) FROM registry)""", "registry"))
def table_append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch three times and another twice: each counts once."""
    lake = registry_table(spark)
    rows = written_registry(spark, sf_dir)
    for day, times in (("2026-01-15", 3), ("2026-01-16", 2)):
        for _ in range(times):
            append_table(rows.withColumn("processed_date", F.lit(day)), lake, "processed_date", batch=f"run {day}")
    return read_table(spark, lake).select(*REGISTRY.fieldNames())


@QUERIES.add("table_upsert_some", with_views(
    """SELECT * REPLACE (CASE WHEN corporate_id LIKE '0a%' THEN revenue + 5 ELSE revenue END AS revenue,
        CASE WHEN corporate_id LIKE '0a%' THEN '2026-01-16' ELSE processed_date END AS processed_date) FROM registry""", "registry"))
def table_upsert_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few ids of a table in buckets: only their buckets are read and written."""
    lake = registry_table(spark)
    rows = written_registry(spark, sf_dir)
    upsert_table(rows, lake, buckets=32)
    some = rows.filter("corporate_id LIKE '0a%'").withColumns({"revenue": F.col("revenue") + 5, "processed_date": F.lit("2026-01-16")})
    upsert_table(some, lake)
    return read_table(spark, lake)


@QUERIES.add("table_compacted", SQL_REGISTRY)
def table_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen small appends, then their files rewritten as few."""
    lake = registry_table(spark)
    rows = written_registry(spark, sf_dir)
    for digit in "0123456789abcdef":
        append_table(rows.filter(F.col("corporate_id").startswith(digit)), lake)
    compact_table(spark, lake)
    return read_table(spark, lake)


@QUERIES.add("load_with_fallback", SQL_REGISTRY)
def query_load_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog is not there, so the rows end up in the fallback dataset."""
    missing = LakeTable("corporate_db.corporate_registry", catalog="catalog_that_is_not_configured")
    uri = load_with_fallback(
        fixtures.registry(spark, sf_dir), missing, scratch_dir(spark, "fallback"), timestamp=STAMP
    )
    return files.read_source(spark, uri, REGISTRY)


@QUERIES.add("table_ident", with_views(
    f"SELECT {REGISTRY_COLUMNS}, 'corporate_db' AS database_name, 'registry.v1' AS table_name FROM registry "
    f"UNION ALL SELECT {REGISTRY_COLUMNS}, 'default', 'registry' FROM registry", "registry"))
def table_ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    rows = written_registry(spark, sf_dir)
    for name in ("corporate_db.registry.v1", "registry"):
        append_table(rows, LakeTable(name, root))

    def stored(database: str, table: str) -> DataFrame:
        lake = LakeTable(f"{database}.{table}", root)
        return read_table(spark, lake).select(
            "*", F.lit(database).alias("database_name"), F.lit(table).alias("table_name")
        )

    return stored("corporate_db", "registry.v1").unionByName(stored("default", "registry"))


# --- the job -----------------------------------------------------------------------------------


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return {f"{name}_uri": uri for name, (uri, _) in source_files(spark, sf_dir).items()}


def _etl(spark: SparkSession, uris: dict[str, str], **settings) -> EtlResult:
    output = scratch_dir(spark, "processed")
    return run_etl(
        spark, EtlConfig(**uris, output_uri=output, processed_date=DATE, timestamp=STAMP, **settings)
    )


@QUERIES.add("etl_job", SQL_REGISTRY)
def etl_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    _etl(spark, _inputs(spark, sf_dir), table_enabled=True, table_root=root, table_mode="upsert")
    return read_table(spark, LakeTable(EtlConfig.table_name, root))


@QUERIES.add("etl_job_append", with_views(
    f"SELECT {REGISTRY_COLUMNS} FROM registry UNION ALL SELECT {REGISTRY_COLUMNS} FROM registry", "registry"))
def etl_job_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default mode, run twice over the same input files into a partitioned table."""
    root, uris = scratch_dir(spark, "lake"), _inputs(spark, sf_dir)
    for _ in range(2):
        _etl(spark, uris, table_enabled=True, table_root=root, partition_key="processed_date")
    return read_table(spark, LakeTable(EtlConfig.table_name, root)).select(*REGISTRY.fieldNames())


@QUERIES.add("etl_job_retried", with_views(f"SELECT {REGISTRY_COLUMNS} FROM registry", "registry"))
def etl_job_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default mode, run again under the same name as a scheduler does after a failure: its rows are there once."""
    root, uris = scratch_dir(spark, "lake"), _inputs(spark, sf_dir)
    for _ in range(2):
        _etl(spark, uris, table_enabled=True, table_root=root, batch="scheduled 2026-01-15")
    return read_table(spark, LakeTable(EtlConfig.table_name, root))


#: Rows of a file that holds one top-level JSON array, about.
ARRAY_ROWS = 20_000


def write_json_arrays(rows: DataFrame, uri: str, array_rows: int = ARRAY_ROWS) -> None:
    """Append the rows as text files of one top-level array each; their number grows with the rows, so a task's work does not.

    Rows are dealt out by all their columns, so those of one name part as well."""
    item = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    buckets = max(1, -(-rows.count() // array_rows))
    dealt = rows.select(F.pmod(F.xxhash64(item), F.lit(buckets)).alias("bucket"), item.alias("item"))
    array = dealt.groupBy("bucket").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("item"), ",\n"), F.lit("\n]")).alias("value"))
    array.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(uri)  # a file holds one array


@QUERIES.add("etl_job_json", SQL_REGISTRY)
def etl_job_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in both layouts in one folder on the way in, JSON out."""
    uris = {}
    for number, derived in ((1, fixtures.source1(spark, sf_dir)), (2, fixtures.source2(spark, sf_dir))):
        uris[f"source{number}_uri"] = uri = scratch_dir(spark, f"source{number}")
        rows = stage(derived, f"derived{number}")  # read three times below
        name = F.col(f"corporate_name_S{number}")
        rows.filter(F.crc32(name) % 2 == 0).write.json(uri, ignoreNullFields=False)
        # The other half as top-level arrays of ARRAY_ROWS rows or so: text files of their own in the same folder.
        write_json_arrays(rows.filter(F.crc32(name) % 2 == 1), uri)
    conf = EtlConfig(
        **uris, source1_format="json", source2_format="json", output_uri=scratch_dir(spark, "processed"), output_format="json",
        processed_date=DATE, timestamp=STAMP,
    )
    return files.read_json(spark, run_etl(spark, conf).registry_uri, REGISTRY, "lines")


@QUERIES.add("etl_report", _with_overlap(
    f"SELECT 'resolve' AS stage, unnest(['matched', 's1_only', 's2_only', 'neither']) AS metric, "
    f"unnest([matched, s1_only, s2_only, neither]) AS value FROM ({_SQL_MATCH}) "
    "UNION ALL SELECT 'source1', 'rows', count(*) FROM src1 UNION ALL SELECT 'source2', 'rows', count(*) FROM src2 "
    "UNION ALL SELECT 'registry', 'rows', count(*) FROM registry"
    + "".join(
        f" UNION ALL SELECT 'registry', 'nulls_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM registry" for c in REGISTRY.fieldNames()
    ), "registry"))
def etl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run, over the files that it read and wrote."""
    return _etl(spark, _inputs(spark, sf_dir)).report.withColumn("value", F.col("value").cast("bigint"))


@QUERIES.add("stage_counts", with_views(
    " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, count(*) AS rows FROM {view}"
        for stage, view in [("source1", "src1"), ("source2", "src2"), ("registry", "registry")]
    ), "registry"))
def query_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted over the files that the job read and wrote."""
    return _etl(spark, _inputs(spark, sf_dir)).counts


_SQL_CHECKPOINTS = (
    ("source1_cleaned", "clean1", ("corporate_name_clean", "address_clean", "activity_places_clean", "top_suppliers_clean")),
    ("source2_cleaned", "clean2", ("corporate_name_clean", "revenue_category", "main_customers_clean", None)),
    ("entities_resolved", "resolved", ("corporate_id", "name_key", "activity_places_clean", "main_customers_clean")),
)


@QUERIES.add("checkpoints", with_views(
    " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, "
        + ", ".join(
            f"{'NULL' if c is None else duck.shown(c) if c.endswith(('places_clean', 'suppliers_clean', 'customers_clean')) else c} AS c{i}"
            for i, c in enumerate(columns)
        )
        + f" FROM {view}"
        for stage, view, columns in _SQL_CHECKPOINTS
    ), "resolved"))
def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three intermediate datasets hold."""
    result, out = _etl(spark, _inputs(spark, sf_dir), save_intermediate=True), None
    for stage, _, columns in _SQL_CHECKPOINTS:
        rows = flat(files.read_parquet(spark, result.intermediate_uris[stage]))
        picked = [(F.lit(None).cast("string") if c is None else F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)]
        rows = rows.select(F.lit(stage).alias("stage"), *picked)
        out = rows if out is None else out.unionByName(rows)
    return out
