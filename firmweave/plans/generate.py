"""Generation job: synthetic sources straight to their destination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmweave.config import GenerateConfig
from firmweave.sources.synthetic import generate_and_save


def run_generate(spark: SparkSession, conf: GenerateConfig, ids: DataFrame | None = None) -> dict[str, str]:
    """URIs of the written datasets by ``<source>_<format>``; a row per ``id`` of ``ids`` where given."""
    skipped = [("source1", conf.skip_source1), ("source2", conf.skip_source2)]
    return generate_and_save(
        spark,
        conf.num_rows,
        conf.output_uri,
        conf.output_format,
        conf.seed,
        conf.match_rate,
        tuple(name for name, skip in skipped if skip),
        ids,
    )
