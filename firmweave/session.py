"""A session with the settings the jobs count on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Join strategy, partition count and skew splitting are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


#: Input bytes for each partition that a shuffle starts with; adaptive execution merges what turns out small.
PARTITION_BYTES = 128 << 20
LEAST_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions to start a shuffle of a whole input with: one per 128 MB, 200 at least."""
    return max(LEAST_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def create_session(
    app_name: str, settings: Mapping[str, str] | None = None, master: str | None = None, input_bytes: int = 0
) -> SparkSession:
    """Get or create a session; the given settings override the ones above.

    ``input_bytes`` is about how much the job reads. Adaptive execution only merges partitions, so shuffles must
    start with enough of them.
    """
    start = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions(input_bytes))}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | start | dict(settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
