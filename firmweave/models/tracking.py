"""Model registry kept as tables.

Below one root: ``experiments`` and ``runs`` are Parquet folders that get one row per experiment
and per run, each in a folder of its own, so that jobs may write at once; ``models/<name>/v=<n>`` holds the fitted models in MLlib's own
format. A version belongs to the run whose claim ``models/<name>/claims/<n>`` exists, which only one job can make. A run is recorded
once its model is saved; one that fails before leaves its version unused.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.schemas import EXPERIMENTS, RUNS
from firmweave.sinks.files import timestamp_text
from firmweave.storage import child_names, exists, join_uri, publish_text

MODEL_TYPE = "LogisticRegression"


def _read(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    if exists(spark, uri):
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(uri)
    return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, join_uri(root, "runs"), RUNS)


def _append_row(spark: SparkSession, row: dict, uri: str, schema: T.StructType) -> None:
    values = [tuple(row[name] for name in schema.fieldNames())]
    spark.createDataFrame(values, schema).coalesce(1).write.parquet(join_uri(uri, f"row={uuid.uuid4().hex}"))


def setup_experiment(
    spark: SparkSession, root: str, name: str = "corporate_profit_prediction"
) -> str:
    """Id of the experiment with this name, made if there is none."""
    uri = join_uri(root, "experiments")
    known = _read(spark, uri, EXPERIMENTS).filter(F.col("name") == name).orderBy("created_at").first()
    if known:
        return known.experiment_id
    experiment = {"experiment_id": uuid.uuid4().hex, "name": name, "created_at": datetime.now()}
    _append_row(spark, experiment, uri, EXPERIMENTS)
    return experiment["experiment_id"]


def _claim_version(spark: SparkSession, root: str, model_name: str, run_id: str) -> int:
    """The next version of a model, for this run alone."""
    claims = join_uri(root, "models", model_name, "claims")
    while True:
        taken = [int(n) for n in child_names(spark, claims) if n.isdigit()]
        runs = read_runs(spark, root).filter(F.col("model_name") == model_name)
        version = max([*taken, runs.agg(F.max("model_version")).first()[0] or 0]) + 1
        if publish_text(spark, join_uri(claims, str(version)), run_id):
            return version


def register_model(
    model: LogisticRegressionModel,
    model_name: str,
    metrics: Mapping[str, float],
    feature_columns: Sequence[str],
    root: str,
    experiment_id: str = "0",
    version_label: str | None = None,
    tags: Mapping[str, str] | None = None,
) -> str:
    """Save the model as the next version of its name, record the run and return the run id."""
    spark = SparkSession.active()
    run_id = uuid.uuid4().hex
    version = _claim_version(spark, root, model_name, run_id)
    label = version_label or timestamp_text()
    path = join_uri(root, "models", model_name, f"v={version}")
    model.write().save(path)
    run = {
        "run_id": run_id,
        "experiment_id": experiment_id,
        "run_name": f"{model_name}_{label}",
        "model_name": model_name,
        "model_version": version,
        "version_label": label,
        "model_type": MODEL_TYPE,
        "feature_columns": list(feature_columns),
        "metrics": {k: float(v) for k, v in metrics.items()},
        "tags": dict(tags or {}),
        "created_at": datetime.now(),
        "model_path": path,
    }
    _append_row(spark, run, join_uri(root, "runs"), RUNS)
    return run_id


def load_model(
    spark: SparkSession, root: str, model_name: str, version: int | None = None
) -> LogisticRegressionModel:
    """The given version of a model, else the latest."""
    wanted = read_runs(spark, root).filter(F.col("model_name") == model_name)
    if version:
        wanted = wanted.filter(F.col("model_version") == version)
    run = wanted.orderBy(F.desc("model_version")).first()
    if run is None:
        raise LookupError(f"no model {model_name}" + (f" version {version}" if version else ""))
    return LogisticRegressionModel.load(run.model_path)


def model_metadata(runs: DataFrame) -> DataFrame:
    """What is worth publishing about each run."""
    return runs.select(
        "model_name",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "metrics",
        "feature_columns",
        "model_path",
        "model_type",
    )


def save_model_metadata(spark: SparkSession, root: str, run_id: str, uri: str) -> str:
    """Write the metadata of one run as JSON."""
    runs = read_runs(spark, root).filter(F.col("run_id") == run_id)
    model_metadata(runs).write.json(uri)
    return uri


def compare_runs(runs: DataFrame, metric: str = "auc") -> DataFrame:
    """Runs with their rank by a metric within each model name, best first; later version wins a tie."""
    value: Column = F.col("metrics")[metric]
    order = Window.partitionBy("model_name").orderBy(F.desc_nulls_last("metric"), F.desc("model_version"))
    return runs.withColumn("metric", value).withColumn("metric_rank", F.row_number().over(order))
