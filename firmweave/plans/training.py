"""Training job: registry table in, registered model and its metrics out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession

from firmweave.config import MlConfig
from firmweave.lake import LakeTable, read_table
from firmweave.models.tracking import register_model, save_model_metadata, setup_experiment
from firmweave.models.training import split_random, split_stable, train_logistic_regression
from firmweave.operators.features import engineer_features, prepare_features


@dataclass(frozen=True)
class MlResult:
    model: LogisticRegressionModel
    predictions: DataFrame
    metrics: dict[str, float]
    run_id: str


def run_ml(spark: SparkSession, conf: MlConfig) -> MlResult:
    """Read, derive features, split, fit, evaluate and register.

    Everything up to the fit is one narrow plan over the table scan, so the passes of the fit
    and of the evaluation repeat no shuffle.
    """
    table = read_table(spark, LakeTable(conf.table_name, conf.table_root, conf.table_catalog))
    features = engineer_features(table, conf.profit_threshold)
    prepared = prepare_features(features, conf.feature_columns)
    if conf.stable_split:
        train, test = split_stable(prepared, conf.train_ratio)
    else:
        train, test = split_random(prepared, conf.train_ratio, conf.seed)
    model, predictions, metrics = train_logistic_regression(train, test, conf.max_iter, conf.reg_param)
    run_id = register_model(
        model,
        conf.model_name,
        metrics,
        conf.feature_columns,
        conf.tracking_root,
        experiment_id=setup_experiment(spark, conf.tracking_root, conf.experiment_name),
        tags={"profit_threshold": str(conf.profit_threshold), "table": conf.table_name},
    )
    if conf.metadata_uri:
        save_model_metadata(spark, conf.tracking_root, run_id, conf.metadata_uri)
    return MlResult(model, predictions, metrics, run_id)
