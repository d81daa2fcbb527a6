"""Splits, fitting, metrics, run records and the jobs."""

import threading

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from firmweave.config import EtlConfig, GenerateConfig, MlConfig
from firmweave.lake import LakeTable, append_table, read_table
from firmweave.models import metrics, tracking, training
from firmweave.operators.features import engineer_features, prepare_features
from firmweave.plans.etl import build_registry, run_etl
from firmweave.plans.generate import run_generate
from firmweave.plans.training import run_ml
from firmweave.schemas import REGISTRY
from firmweave.sources.synthetic import generate_source1, generate_source2

DATE = "2026-01-15"


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    """A registry out of generated sources, as a finished ETL run leaves it."""
    where = str(tmp_path_factory.mktemp("registry") / "r.parquet")
    build_registry(generate_source1(spark, 2000), generate_source2(spark, 2000), DATE).write.parquet(where)
    return spark.read.parquet(where)


@pytest.fixture(scope="module")
def prepared(registry):
    return prepare_features(engineer_features(registry, 250.0))


def ids(df):
    return sorted(r.corporate_id for r in df.select("corporate_id").collect())


def test_splits_are_partitions(prepared):
    for train, test in (training.split_random(prepared), training.split_stable(prepared)):
        assert sorted(ids(train) + ids(test)) == ids(prepared)
        assert 0.75 < train.count() / prepared.count() < 0.85


def test_stable_split_ignores_partitioning(prepared):
    assert ids(training.split_stable(prepared)[0]) == ids(training.split_stable(prepared.repartition(13))[0])


def newton(features, labels, reg, steps=50):
    """Ridge logistic regression on standardised features by Newton's method."""
    scale = features.std(axis=0, ddof=1)
    x = np.c_[np.ones(len(features)), features / scale]
    penalty = np.diag([0.0] + [reg] * features.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - labels) / len(labels) + penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(labels) + penalty
        w -= np.linalg.solve(hessian, gradient)
    return np.r_[w[0], w[1:] / scale]


def test_fit_is_the_optimum(prepared):
    model, predictions, found = training.train_logistic_regression(prepared)
    assert predictions is None and found == {}
    rows = prepared.select(vector_to_array("features").alias("x"), "high_profit").collect()
    expected = newton(np.array([r.x for r in rows]), np.array([r.high_profit for r in rows]), 0.01)
    assert np.allclose(np.r_[model.intercept, model.coefficients.toArray()], expected, rtol=1e-3, atol=1e-5)


def test_fit_does_not_depend_on_partitioning(prepared):
    a, b = (training.train_logistic_regression(df)[0] for df in (prepared.coalesce(1), prepared.repartition(7)))
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-6)


def test_fit_refuses_no_rows_and_one_class(prepared):
    with pytest.raises(ValueError, match="no rows"):
        training.train_logistic_regression(prepared.limit(0))
    with pytest.raises(ValueError, match="single value"):
        training.train_logistic_regression(prepared.filter("high_profit = 1"))


def test_metrics_agree_with_the_evaluators(prepared):
    train, test = training.split_stable(prepared)
    _, predictions, found = training.train_logistic_regression(train, test)
    auc = BinaryClassificationEvaluator(labelCol="high_profit", numBins=0).evaluate(predictions)
    assert found["auc"] == pytest.approx(auc, abs=1e-12)

    def multiclass(name):
        return MulticlassClassificationEvaluator(labelCol="high_profit", metricName=name, metricLabel=1.0).evaluate(predictions)

    assert found["accuracy"] == pytest.approx(multiclass("accuracy"), abs=1e-12)
    assert found["precision"] == pytest.approx(multiclass("precisionByLabel"), abs=1e-12)
    assert found["recall"] == pytest.approx(multiclass("recallByLabel"), abs=1e-12)
    assert found["f1"] == pytest.approx(multiclass("fMeasureByLabel"), abs=1e-12)
    assert metrics.accuracy(predictions).first()[0] == pytest.approx(found["accuracy"])


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_auc_by_hand(spark, partitions):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(0, 40)) / 40, float(rng.integers(0, 2))) for _ in range(400)]
    wins = sum((p > n) + (p == n) / 2 for p, y in rows if y for n, z in rows if not z)
    positives = sum(y for _, y in rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "score double, high_profit double")
        found = metrics.exact_auc(df).first().auc
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == pytest.approx(wins / (positives * (len(rows) - positives)), abs=1e-12)


def test_auc_takes_many_batches(spark):
    """A range wider than one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select((F.col("id") / 100).alias("score"), (F.col("id") % 3 == 0).cast("double").alias("high_profit"))
        found = metrics.exact_auc(df).first().auc
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pos, neg = [i for i in range(100) if i % 3 == 0], [i for i in range(100) if i % 3]
    assert found == pytest.approx(sum(p > n for p in pos for n in neg) / (len(pos) * len(neg)))


def test_metrics_without_a_denominator_are_null(spark):
    df = spark.createDataFrame([(0.1, 0.0, 0.0)], "score double, high_profit double, prediction double")
    row = metrics.evaluate(df).first()
    assert (row.auc, row.accuracy, row.precision, row.recall, row.f1) == (None, 1.0, None, None, None)
    assert metrics.exact_auc(df.limit(0)).first().auc is None


def test_probability_expression_is_the_model(prepared):
    model, _, _ = training.train_logistic_regression(prepared)
    names = ["revenue", "num_suppliers", "profit_margin_normalized"]
    p = training.linear_probability(names, [float(w) for w in model.coefficients], float(model.intercept))
    both = model.transform(prepared).select(p.alias("a"), training.positive_probability().alias("b")).collect()
    assert max(abs(r.a - r.b) for r in both) < 1e-12


# --- run records -------------------------------------------------------------------------------


def test_register_load_and_compare(spark, prepared, uri):
    root = uri("tracking")
    model, _, _ = training.train_logistic_regression(prepared)
    other, _, _ = training.train_logistic_regression(prepared, reg_param=5.0)
    experiment = tracking.setup_experiment(spark, root, "e")
    assert tracking.setup_experiment(spark, root, "e") == experiment
    assert tracking.setup_experiment(spark, root, "f") != experiment
    columns = ["revenue"]
    first = tracking.register_model(model, "m", {"auc": 0.9}, columns, root, experiment, tags={"k": "v"})
    tracking.register_model(other, "m", {"auc": 0.7}, columns, root, version_label="second")
    tracking.register_model(model, "n", {"accuracy": 0.5}, columns, root)

    assert tracking.load_model(spark, root, "m", 1).coefficients == model.coefficients
    assert tracking.load_model(spark, root, "m").coefficients == other.coefficients
    with pytest.raises(LookupError):
        tracking.load_model(spark, root, "unknown")

    ranked = {(r.model_name, r.model_version): (r.metric_rank, r.metric) for r in
              tracking.compare_runs(tracking.read_runs(spark, root)).collect()}
    assert ranked == {("m", 1): (1, 0.9), ("m", 2): (2, 0.7), ("n", 1): (1, None)}

    tracking.save_model_metadata(spark, root, first, uri("meta"))
    (row,) = spark.read.json(uri("meta")).collect()
    assert (row.model_name, row.model_type, row.metrics.auc) == ("m", "LogisticRegression", 0.9)
    assert row.model_path.endswith("/models/m/v=1")


# --- jobs --------------------------------------------------------------------------------------


def test_generate_etl_and_training_jobs(spark, uri):
    written = run_generate(spark, GenerateConfig(num_rows=400, output_uri=uri("data"), match_rate=1.0))
    settings = dict(
        source1_uri=written["source1_parquet"], source2_uri=written["source2_parquet"], output_uri=uri("out"),
        processed_date=DATE, timestamp="ts", table_enabled=True, table_root=uri("lake"), partition_key="processed_date",
    )
    result = run_etl(spark, EtlConfig(**settings, save_intermediate=True))
    assert {r.stage: r.rows for r in result.counts.collect()} == {"source1": 400, "source2": 400, "registry": 400}
    assert sorted(result.intermediate_uris) == ["entities_resolved", "source1_cleaned", "source2_cleaned"]
    assert result.registry_uri == uri("out/corporate_registry_ts.parquet") and result.fallback_uri is None
    table = read_table(spark, LakeTable(EtlConfig.table_name, uri("lake")))
    assert table.count() == 400 and set(table.columns) == set(REGISTRY.fieldNames())

    conf = MlConfig(table_root=uri("lake"), tracking_root=uri("runs"), profit_threshold=250.0, metadata_uri=uri("meta"))
    trained = run_ml(spark, conf)
    assert set(trained.metrics) == {"auc", "accuracy", "precision", "recall", "f1"} and trained.metrics["auc"] > 0.8
    (run,) = tracking.read_runs(spark, conf.tracking_root).collect()
    assert run.run_id == trained.run_id and run.tags["table"] == conf.table_name
    assert spark.read.json(uri("meta")).count() == 1


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_etl_in_text_formats(spark, uri, fmt):
    written = run_generate(spark, GenerateConfig(num_rows=50, output_uri=uri("data"), output_format=fmt))
    result = run_etl(spark, EtlConfig(
        source1_uri=written[f"source1_{fmt}"], source2_uri=written[f"source2_{fmt}"], output_uri=uri("out"),
        output_format=fmt, processed_date=DATE, save_intermediate=True))
    direct = build_registry(generate_source1(spark, 50), generate_source2(spark, 50), DATE)
    assert sorted(map(tuple, result.registry.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_etl_falls_back(spark, uri):
    written = run_generate(spark, GenerateConfig(num_rows=10, output_uri=uri("data")))
    result = run_etl(spark, EtlConfig(
        source1_uri=written["source1_parquet"], source2_uri=written["source2_parquet"], output_uri=uri("out"),
        timestamp="ts", table_enabled=True, table_catalog="no_such_catalog"))
    assert result.fallback_uri == uri("out/iceberg_fallback/corporate_registry_backup_ts.parquet")


def test_configs():
    assert EtlConfig.from_mapping({"output_format": "csv"}).output_format == "csv"
    with pytest.raises(ValueError, match="unknown settings"):
        MlConfig.from_mapping({"threshold": 1})
    assert (MlConfig().profit_threshold, MlConfig().train_ratio, MlConfig().max_iter, MlConfig().reg_param) == (100.0, 0.8, 100, 0.01)
    assert GenerateConfig().num_rows == 100


def test_append_then_read_columns(spark, registry, uri):
    append_table(registry, LakeTable("t", uri("lake")))
    assert read_table(spark, LakeTable("default.t", uri("lake"))).count() == registry.count()


def test_the_binned_area_is_within_its_error(spark):
    rng = np.random.default_rng(5)
    scores = np.concatenate((rng.beta(2, 5, 900), rng.beta(5, 2, 600), [0.0, 1.0, -3.0, 7.0]))
    labels = np.concatenate((np.zeros(900), np.ones(600), [0.0, 1.0, 0.0, 1.0]))
    rows = [(float(s), float(y)) for s, y in zip(scores, labels, strict=True)]
    df = spark.createDataFrame([*rows, (None, 1.0), (float("nan"), 0.0)], "score double, high_profit double").repartition(5)
    exact = metrics.exact_auc(spark.createDataFrame(rows, "score double, high_profit double")).first().auc
    errors = []
    for bins in (1, 10, 100, 1000):
        found = metrics.binned_auc(df, bins=bins).first()
        assert abs(found.auc - exact) <= found.error + 1e-12
        errors.append(found.error)
    assert errors == sorted(errors, reverse=True) and errors[0] == 0.5 and errors[-1] < 0.002
    assert metrics.binned_auc(df.where("high_profit = 1")).first().auc is None


def test_ten_registrations_at_once_have_ten_versions(spark, uri):
    rows = spark.createDataFrame([(float(i % 2), float(i)) for i in range(20)], "high_profit double, x double")
    frame = prepare_features(rows.withColumn("corporate_id", F.col("x").cast("string")), ["x"])
    model = training.train_logistic_regression(frame)[0]
    failures = []

    def register(k):
        try:
            tracking.register_model(model, "m", {"auc": k / 10}, ["x"], uri("tracking"))
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=register, args=(k,)) for k in range(10)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    runs = tracking.read_runs(spark, uri("tracking")).collect()
    assert sorted(r.model_version for r in runs) == list(range(1, 11)) and len({r.model_path for r in runs}) == 10
    assert tracking.load_model(spark, uri("tracking"), "m", 7).coefficients == model.coefficients
