"""ETL job: two sources in, one registry out, optionally into a lake table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from firmweave.config import EtlConfig
from firmweave.lake import LakeTable, load_with_fallback
from firmweave.operators.clean import clean_source1, clean_source2
from firmweave.operators.harmonize import harmonize, prepared
from firmweave.operators.quality import quality_report, stage_counts
from firmweave.operators.resolve import BLANK_PARTS, blank_rows, resolve_entities
from firmweave.sinks.files import load_dataset, load_registry, timestamp_text
from firmweave.sources.files import ReadOptions, extract_source1, extract_source2, read_parquet
from firmweave.storage import stage


@dataclass(frozen=True)
class EtlResult:
    registry: DataFrame
    registry_uri: str
    blank_uris: dict[str, str]
    fallback_uri: str | None
    intermediate_uris: dict[str, str]
    counts: DataFrame
    report: DataFrame


def build_registry(
    source1: DataFrame,
    source2: DataFrame,
    processed_date: str | None = None,
    drop_blank_keys: bool = False,
) -> DataFrame:
    """Clean, match and harmonise as one lazy plan, with one join in it."""
    sides = prepared(clean_source1(source1)), prepared(clean_source2(source2))
    resolved = resolve_entities(*sides, drop_blank_keys, blank_parts=BLANK_PARTS)
    return harmonize(resolved, processed_date)


def _checkpoint(df: DataFrame, name: str, conf: EtlConfig, timestamp: str, uris: dict[str, str]) -> DataFrame:
    """Save an intermediate frame and go on from what was written."""
    if not conf.save_intermediate:
        return df
    if conf.output_format == "parquet":
        uris[name] = load_dataset(df, conf.output_uri, name, "parquet", timestamp)
        return read_parquet(df.sparkSession, uris[name], df.schema)
    staged = stage(df, name)
    uris[name] = load_dataset(staged, conf.output_uri, name, conf.output_format, timestamp)
    return staged


def run_etl(spark: SparkSession, conf: EtlConfig) -> EtlResult:
    timestamp = conf.timestamp or timestamp_text()
    uris: dict[str, str] = {}
    options = [
        ReadOptions(file_format, conf.multiline, conf.json_layout, conf.lists_as_text)
        for file_format in (conf.source1_format, conf.source2_format)
    ]
    source1 = extract_source1(spark, conf.source1_uri, options[0])
    source2 = extract_source2(spark, conf.source2_uri, options[1])
    cleaned1 = _checkpoint(clean_source1(source1), "source1_cleaned", conf, timestamp, uris)
    cleaned2 = _checkpoint(clean_source2(source2), "source2_cleaned", conf, timestamp, uris)
    blank_uris = {}
    if conf.drop_blank_keys:  # what the match leaves out is kept where it can be looked at
        for name, rows in (("source1_unnamed", cleaned1), ("source2_unnamed", cleaned2)):
            blank_uris[name] = load_dataset(blank_rows(rows), conf.output_uri, name, conf.output_format, timestamp)
    # What is saved of the pairs is what the match makes; else the sides bring along what the registry takes from them.
    sides = (cleaned1, cleaned2) if conf.save_intermediate else (prepared(cleaned1), prepared(cleaned2))
    resolved = resolve_entities(*sides, conf.drop_blank_keys, conf.hot_rows, BLANK_PARTS)
    resolved = _checkpoint(resolved, "entities_resolved", conf, timestamp, uris)
    registry = harmonize(resolved, conf.processed_date)

    # The registry is computed by one write. The table load and the counts read what was written.
    if conf.output_format == "parquet":
        registry_uri = load_registry(registry, conf.output_uri, "parquet", timestamp)
        written = read_parquet(spark, registry_uri, registry.schema)
    else:
        written = stage(registry, "registry")
        registry_uri = load_registry(written, conf.output_uri, conf.output_format, timestamp)

    fallback_uri = None
    if conf.table_enabled:
        table = LakeTable(conf.table_name, conf.table_root, conf.table_catalog)
        fallback_uri = load_with_fallback(
            written, table, conf.output_uri, conf.table_mode, conf.partition_key, timestamp, conf.batch, conf.table_buckets
        )
    counts = stage_counts({"source1": source1, "source2": source2, "registry": written})
    # Computed when looked at; the registry's part is counted over what was written.
    report = quality_report(cleaned1, cleaned2, written)
    return EtlResult(written, registry_uri, blank_uris, fallback_uri, uris, counts, report)
