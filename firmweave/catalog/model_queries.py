"""Queries over features, models, run records and the generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.functions import vector_to_array

from firmweave.catalog import fixtures
from firmweave.catalog.fixtures import with_views
from firmweave.catalog.query import QuerySet
from firmweave.catalog.registry_queries import flat, registry_table
from firmweave.catalog.duck import shown as sql_shown
from firmweave.config import GenerateConfig, MlConfig
from firmweave.lake import append_table
from firmweave.models import metrics, tracking, training
from firmweave.operators import features
from firmweave.operators.quality import label_balance
from firmweave.plans.generate import run_generate
from firmweave.plans.training import run_ml
from firmweave.sources import synthetic
from firmweave.functions.lists import SEPARATOR
from firmweave.schemas import RUNS, SOURCE1, SOURCE2
from firmweave.sources.files import ReadOptions, read_source
from firmweave.sources.synthetic import ACTIVITIES, CUSTOMERS, FAMILIES, KINDS, STREETS, SUPPLIERS, TOWNS
from firmweave.storage import join_uri, scratch_dir, stage

QUERIES = QuerySet()

# --- features ----------------------------------------------------------------------------------

_FIRST = "substr(corporate_id, 1, 1)"


def _unless(digits: str, value: Column, other: Column | None = None) -> Column:
    return F.when(~F.substring("corporate_id", 1, 1).isin(*digits), value).otherwise(
        F.lit(None) if other is None else other
    )


def _rough_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with gaps and with text among the numbers."""
    return fixtures.registry(spark, sf_dir).withColumns(
        {
            "revenue": _unless("0", F.col("revenue").cast("string"), F.lit("n/a")),
            "profit": _unless("1", F.col("profit")),
            "profit_margin": _unless("2", F.col("profit_margin"), F.lit(float("nan"))),
            "num_suppliers": _unless("3", F.col("num_suppliers").cast("string"), F.lit("several")),
            "num_customers": _unless("4", F.col("num_customers")),
        }
    )


_SQL_ROUGH = f"""(SELECT corporate_id, corporate_name, CASE WHEN {_FIRST} <> '0' THEN revenue END AS revenue,
  CASE WHEN {_FIRST} <> '1' THEN profit END AS profit, CASE WHEN {_FIRST} <> '2' THEN profit_margin END AS profit_margin,
  CASE WHEN {_FIRST} <> '3' THEN num_suppliers END AS num_suppliers,
  CASE WHEN {_FIRST} <> '4' THEN num_customers END AS num_customers, num_activity_places, revenue_category FROM registry)"""
_REQUIRED = "revenue IS NOT NULL AND profit IS NOT NULL AND num_suppliers IS NOT NULL"
_SQL_FEATURES = f"""SELECT *, CASE WHEN profit >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high_profit,
  round(ln(revenue + 1), 6) AS revenue_log, coalesce(profit_margin / 100::DOUBLE, 0.0) AS profit_margin_normalized,
  CASE WHEN num_customers > 0 THEN num_suppliers / num_customers::DOUBLE ELSE 0.0 END AS supplier_customer_ratio
  FROM {_SQL_ROUGH} WHERE {_REQUIRED}"""


@QUERIES.add("feature_select", with_views(f"SELECT * FROM {_SQL_ROUGH}", "registry"))
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.select_features(_rough_registry(spark, sf_dir))


@QUERIES.add("filter_required", with_views(f"SELECT * FROM {_SQL_ROUGH} WHERE {_REQUIRED}", "registry"))
def filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.filter_required(features.select_features(_rough_registry(spark, sf_dir)))


@QUERIES.add("label_high_profit", with_views(
    f"SELECT corporate_id, CASE WHEN profit >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high_profit "
    f"FROM {_SQL_ROUGH}", "registry"))
def label_high_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.label_high_profit(_rough_registry(spark, sf_dir)).select("corporate_id", "high_profit")


@QUERIES.add("engineer_features", with_views(_SQL_FEATURES, "registry"))
def engineer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = features.engineer_features(_rough_registry(spark, sf_dir))
    return derived.withColumn("revenue_log", F.round("revenue_log", 6))


@QUERIES.add("label_balance", with_views(
    f"SELECT count(*) FILTER (WHERE high_profit = 1) AS positives, count(*) AS total, "
    f"count(*) FILTER (WHERE high_profit = 1) * 100.0::DOUBLE / count(*) AS percent FROM ({_SQL_FEATURES})", "registry"))
def query_label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_balance(features.engineer_features(_rough_registry(spark, sf_dir)))


def _gappy_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = {"high_profit": _unless("5", F.col("high_profit")), "revenue": _unless("6", F.col("revenue"))}
    return features.engineer_features(fixtures.registry(spark, sf_dir)).withColumns(gaps)


@QUERIES.add("filter_features", with_views(
    f"SELECT corporate_id, high_profit, revenue, num_suppliers, profit_margin_normalized FROM features "
    f"WHERE {_FIRST} NOT IN ('5', '6')", "features"))
def filter_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.filter_features(_gappy_features(spark, sf_dir))


@QUERIES.add("assemble_skip", with_views(
    f"SELECT corporate_id FROM features WHERE {_FIRST} NOT IN ('7', '8')", "features"))
def assemble_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = {
        "revenue": _unless("7", F.col("revenue")),
        "profit_margin_normalized": _unless("8", F.col("profit_margin_normalized"), F.lit(float("nan"))),
    }
    rows = features.engineer_features(fixtures.registry(spark, sf_dir)).withColumns(gaps)
    return features.assemble(rows).select("corporate_id")


@QUERIES.add("prepare_features", with_views(
    f"SELECT corporate_id, high_profit, revenue AS f0, num_suppliers::DOUBLE AS f1, profit_margin_normalized AS f2 "
    f"FROM features WHERE {_FIRST} NOT IN ('5', '6')", "features"))
def prepare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = vector_to_array("features")
    return features.prepare_features(_gappy_features(spark, sf_dir)).select(
        "corporate_id", "high_profit", *[vector[i].alias(f"f{i}") for i in range(3)]
    )


# --- split, fit, score -------------------------------------------------------------------------


def _engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.engineer_features(fixtures.registry(spark, sf_dir))


def _flagged(df: DataFrame) -> DataFrame:
    """The number of suppliers as a 0/1 flag: fitted without a penalty on it alone, the model's probabilities are the group means."""
    return df.withColumn("num_suppliers", (F.col("num_suppliers") >= 6).cast("int"))


_FLAG = ("num_suppliers",)


def _training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written out once, as the table of a real run is: fitting reads it many times."""
    staged = stage(features.engineer_features(_flagged(fixtures.registry(spark, sf_dir))), "features")
    return features.prepare_features(staged, _FLAG)


def _sides(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.select("corporate_id", F.lit("train").alias("side")).unionByName(
        test.select("corporate_id", F.lit("test").alias("side"))
    )


@QUERIES.add("split_random", with_views("SELECT corporate_id FROM features", "features"))
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which side a row falls on is chance; that each row falls on exactly one is not."""
    rows = stage(_engineered(spark, sf_dir), "features")
    return _sides(*training.split_random(rows)).select("corporate_id")


@QUERIES.add("split_stable", with_views(
    "SELECT corporate_id, CASE WHEN ('0x' || substr(corporate_id, 1, 8))::BIGINT < 3435973837 THEN 'train' "
    "ELSE 'test' END AS side FROM features", "features"))
def split_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(*training.split_stable(_engineered(spark, sf_dir)))


_SQL_TEST_IDS = "('0x' || substr(corporate_id, 1, 8))::BIGINT >= 3435973837"
_SQL_FLAGGED = f"""(SELECT corporate_id, high_profit, CASE WHEN num_suppliers >= 6 THEN 1 ELSE 0 END AS flag, {_SQL_TEST_IDS} AS test
  FROM features)"""
_SQL_MEANS = f"""(SELECT avg(high_profit) FILTER (WHERE flag = 0) AS p0, avg(high_profit) FILTER (WHERE flag = 1) AS p1
  FROM {_SQL_FLAGGED} WHERE NOT test)"""
_SQL_SCORES = f"(SELECT *, CASE flag WHEN 1 THEN p1 ELSE p0 END AS p FROM {_SQL_FLAGGED}, {_SQL_MEANS} WHERE test)"
_SQL_PREDICTED = f"""SELECT corporate_id, high_profit, round(p, 4) AS probability,
  CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM {_SQL_SCORES}"""


@QUERIES.add("train_lr", with_views(
    f"""SELECT 'intercept' AS term, round(ln(p0 / (1 - p0)), 4) AS weight FROM {_SQL_MEANS} UNION ALL
    SELECT 'num_suppliers', round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 4) FROM {_SQL_MEANS}""", "features"))
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = training.split_stable(_training_frame(spark, sf_dir))
    model, _, _ = training.train_logistic_regression(train, reg_param=0.0)
    return training.coefficient_table(model, _FLAG).withColumn("weight", F.round("weight", 4))


def _predicted(scored: DataFrame) -> DataFrame:
    probability = F.round(training.positive_probability(), 4).alias("probability")
    return scored.select("corporate_id", "high_profit", probability, "prediction")


@QUERIES.add("predict_lr", with_views(_SQL_PREDICTED, "features"))
def predict_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = training.split_stable(_training_frame(spark, sf_dir))
    return _predicted(training.train_logistic_regression(train, test, reg_param=0.0)[1])


_WEIGHTS, _INTERCEPT = (0.002, -0.3, 4.0), -1.5
_SQL_LINEAR = "(-1.5::DOUBLE + revenue * 0.002::DOUBLE + num_suppliers * -0.3::DOUBLE + profit_margin_normalized * 4.0::DOUBLE)"


@QUERIES.add("linear_score", with_views(
    f"SELECT corporate_id, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-{_SQL_LINEAR})), 6) AS probability FROM features", "features"))
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expression form of a model of given weights, over all features."""
    probability = training.linear_probability(features.DEFAULT_FEATURES, _WEIGHTS, _INTERCEPT)
    return _engineered(spark, sf_dir).select("corporate_id", F.round(probability, 6).alias("probability"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score, with ties, in place of a fitted one."""
    score = F.floor(F.col("revenue") / 50) / (F.floor(F.col("revenue") / 50) + 20)
    scored = _engineered(spark, sf_dir).select(
        "corporate_id", "revenue_category", "num_activity_places", "high_profit", score.alias("score")
    )
    return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


_SQL_SCORED = """(SELECT *, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM (
  SELECT corporate_id, revenue_category, num_activity_places, high_profit,
         floor(revenue / 50) / (floor(revenue / 50) + 20) AS score FROM features))"""
_SQL_AUC = f"""SELECT sum(neg * (above + pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM (SELECT score, sum(high_profit) AS pos, sum(1 - high_profit) AS neg FROM {_SQL_SCORED} GROUP BY score))"""
_SQL_CELLS = f"""(SELECT sum(high_profit * prediction) AS tp, sum((1 - high_profit) * prediction) AS fp,
  sum(high_profit * (1 - prediction)) AS fn, sum((1 - high_profit) * (1 - prediction)) AS tn FROM {_SQL_SCORED})"""
_SQL_PRF = "tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1"


@QUERIES.add("eval_auc", with_views(_SQL_AUC, "features"))
def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.exact_auc(_scored(spark, sf_dir))


_SQL_BINNED_AUC = f"""SELECT sum(neg * (above + pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS auc, sum(neg * pos) / 2 / (sum(pos) * sum(neg)) AS error FROM (
  SELECT *, coalesce(sum(pos) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM (SELECT least(floor(score * 40), 39) AS bin, sum(high_profit) AS pos, sum(1 - high_profit) AS neg FROM {_SQL_SCORED} GROUP BY bin))"""


@QUERIES.add("eval_auc_binned", with_views(_SQL_BINNED_AUC, "features"))
def eval_auc_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.binned_auc(_scored(spark, sf_dir), bins=40)


@QUERIES.add("eval_accuracy", with_views(f"SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy FROM {_SQL_CELLS}", "features"))
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(_scored(spark, sf_dir))


@QUERIES.add("eval_prf", with_views(f"SELECT {_SQL_PRF} FROM {_SQL_CELLS}", "features"))
def eval_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.precision_recall_f1(_scored(spark, sf_dir))


@QUERIES.add("eval_all", with_views(
    f"SELECT auc, (tp + tn) / (tp + tn + fp + fn) AS accuracy, {_SQL_PRF} FROM ({_SQL_AUC}), {_SQL_CELLS}", "features"))
def eval_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.evaluate(_scored(spark, sf_dir))


# --- run records -------------------------------------------------------------------------------

_MODEL = MlConfig.model_name


def _register(spark: SparkSession, sf_dir: str, versions: int = 1) -> tuple[str, DataFrame]:
    """Fit, register, and give the tracking root and the scored test rows."""
    root = scratch_dir(spark, "tracking")
    train, test = training.split_stable(_training_frame(spark, sf_dir))
    model, predictions, found = training.train_logistic_regression(train, test, reg_param=0.0)
    experiment = tracking.setup_experiment(spark, root)
    for _ in range(versions):
        tracking.register_model(
            model, _MODEL, found, _FLAG, root, experiment, tags={"profit_threshold": "100.0"}
        )
    return root, predictions


_SQL_METRICS = f"""(SELECT (x.w1 * (p1 > p0)::INT + x.w0 * (p1 < p0)::INT + x.ties / 2 + (p1 = p0)::INT * (x.w1 + x.w0) / 2)
    / (pos * neg)::DOUBLE AS auc, hits / n::DOUBLE AS accuracy, marked FROM {_SQL_MEANS}, (
  SELECT sum((flag = 1 AND y = 1)::INT) * sum((flag = 0 AND y = 0)::INT) AS w1, sum((flag = 0 AND y = 1)::INT) * sum((flag = 1 AND y = 0)::INT) AS w0,
    (sum((flag = 1 AND y = 1)::INT) * sum((flag = 1 AND y = 0)::INT) + sum((flag = 0 AND y = 1)::INT) * sum((flag = 0 AND y = 0)::INT))::DOUBLE AS ties,
    sum(y) AS pos, sum(1 - y) AS neg, count(*) AS n, sum(((p > 0.5)::INT = y)::INT) AS hits, sum((p > 0.5)::INT) AS marked
  FROM (SELECT *, high_profit::INT AS y FROM {_SQL_SCORES})) x)"""


@QUERIES.add("register_model", with_views(
    f"""SELECT '{_MODEL}' AS model_name, CAST(v AS INTEGER) AS model_version, 'LogisticRegression' AS model_type,
      'num_suppliers' AS feature_columns, round(auc, 9) AS auc, round(accuracy, 9) AS accuracy
    FROM {_SQL_METRICS}, (VALUES (1), (2)) AS versions(v)""", "features"))
def register_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _register(spark, sf_dir, versions=2)
    return tracking.read_runs(spark, root).select(
        "model_name", "model_version", "model_type", F.array_join("feature_columns", ",").alias("feature_columns"),
        F.round(F.col("metrics")["auc"], 9).alias("auc"), F.round(F.col("metrics")["accuracy"], 9).alias("accuracy"),
    )


@QUERIES.add("load_model", with_views(_SQL_PREDICTED, "features"))
def load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reloaded model says of the test rows."""
    root, predictions = _register(spark, sf_dir)
    rows = predictions.select("corporate_id", "high_profit", "features")
    return _predicted(tracking.load_model(spark, root, _MODEL).transform(rows))


@QUERIES.add("model_metadata", with_views(
    f"""SELECT '{_MODEL}' AS model_name, 'num_suppliers' AS feature_columns, 'LogisticRegression' AS model_type,
      CASE WHEN marked > 0 THEN 'accuracy,auc,f1,precision,recall' ELSE 'accuracy,auc,f1,recall' END AS metrics FROM {_SQL_METRICS}""",
    "features"))
def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _register(spark, sf_dir)
    return tracking.model_metadata(tracking.read_runs(spark, root)).select(
        "model_name", F.array_join("feature_columns", ",").alias("feature_columns"), "model_type",
        F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("metrics"),
    )


@QUERIES.add("runs_compare", with_views(
    f"""SELECT model_name, model_version, accuracy, CAST(row_number() OVER (PARTITION BY model_name
          ORDER BY accuracy DESC, model_version DESC) AS INTEGER) AS metric_rank FROM (
          SELECT revenue_category AS model_name, num_activity_places AS model_version,
                 avg(CASE WHEN high_profit = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM {_SQL_SCORED} GROUP BY 1, 2)""",
    "features"))
def runs_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per revenue bucket (the model) and number of activity places (its version)."""
    hit = F.when(F.col("high_profit") == F.col("prediction"), 1.0).otherwise(0.0)
    runs = _scored(spark, sf_dir).groupBy(
        F.col("revenue_category").alias("model_name"), F.col("num_activity_places").alias("model_version")
    ).agg(F.create_map(F.lit("accuracy"), F.avg(hit)).alias("metrics"))
    root = scratch_dir(spark, "tracking")
    columns = [F.col(f.name) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RUNS]
    runs.select(*columns).write.parquet(join_uri(root, "runs"))
    return tracking.compare_runs(tracking.read_runs(spark, root), "accuracy").select(
        "model_name", "model_version", F.col("metric").alias("accuracy"), "metric_rank"
    )


@QUERIES.add("ml_job", with_views(_SQL_PREDICTED, "features"))
def ml_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = registry_table(spark)
    append_table(_flagged(fixtures.registry(spark, sf_dir)), lake)
    conf = MlConfig(
        table_name=lake.name, table_root=lake.root, tracking_root=scratch_dir(spark, "tracking"), feature_columns=_FLAG, reg_param=0.0
    )
    result = run_ml(spark, conf)
    registered = tracking.load_model(spark, conf.tracking_root, conf.model_name)
    return _predicted(registered.transform(result.predictions.select("corporate_id", "high_profit", "features")))


# --- generator ---------------------------------------------------------------------------------


def _sql_digest(row_id: str, field: str) -> str:
    return f"sha256({row_id} || '|{field}|42')"


def _sql_digits(digest: str, start: int, length: int) -> str:
    return f"('0x' || substr({digest}, {start}, {length}))::BIGINT"


def _sql_pick(words: tuple[str, ...], draw: str) -> str:
    return f"[{', '.join(repr(w) for w in words)}][{draw} % {len(words)} + 1]"


def _sql_sample(words: tuple[str, ...], field: str, low: int, high: int) -> str:
    digest = _sql_digest("id", field)
    keyed = ", ".join(f"{{'k': substr({digest}, {1 + 6 * i}, 6), 'word': '{w}'}}" for i, w in enumerate(words))
    size = f"{low} + {_sql_digits(digest, 61, 4)} % {high - low + 1}"
    return sql_shown(f"list_transform(list_sort([{keyed}])[1:{size}], lambda e: e.word)")


def _sql_name(key: str) -> str:
    digest = _sql_digest(key, "name")
    family, kind = _sql_pick(FAMILIES, _sql_digits(digest, 1, 4)), _sql_pick(KINDS, _sql_digits(digest, 5, 4))
    return f"concat_ws(' ', {family}, {key}, {kind})"


_PLACE, _MONEY = _sql_digest("id", "address"), _sql_digest("id", "money")
_SQL_GEN1 = f"""SELECT {_sql_name('id')} AS corporate_name_S1,
  concat({_sql_digits(_PLACE, 1, 4)} % 999 + 1, ' ', {_sql_pick(STREETS, _sql_digits(_PLACE, 5, 4))}, ' Street, ',
         {_sql_pick(TOWNS, _sql_digits(_PLACE, 9, 4))}, ' ', lpad(CAST({_sql_digits(_PLACE, 13, 6)} % 100000 AS VARCHAR), 5, '0'))
    AS address, {_sql_sample(ACTIVITIES, 'activities', 2, 5)} AS activity_places,
  {_sql_sample(SUPPLIERS, 'suppliers', 3, 8)} AS top_suppliers FROM ids"""
_SQL_GEN2 = f"""SELECT {_sql_name('name_key')} AS corporate_name_S2, customers AS main_customers,
  cents / 100::DOUBLE AS revenue, ((cents * margin + 500000) // 1000000) / 100::DOUBLE AS profit FROM (
  SELECT CASE WHEN {_sql_digits(_MONEY, 1, 6)} < 13421773 THEN id ELSE 'x' || id END AS name_key,
         1000 + {_sql_digits(_MONEY, 7, 10)} % 499001 AS cents, 50000 + {_sql_digits(_MONEY, 17, 10)} % 150001 AS margin,
         {_sql_sample(CUSTOMERS, 'customers', 2, 6)} AS customers FROM ids)"""
_SQL_CUSTOMER_IDS = "WITH ids AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)\n"


@QUERIES.add("gen_source1", _SQL_CUSTOMER_IDS + _SQL_GEN1)
def gen_source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(synthetic.source1_rows(fixtures.table(spark, sf_dir, "customer", "c_custkey"), "c_custkey"))


@QUERIES.add("gen_source2", _SQL_CUSTOMER_IDS + _SQL_GEN2)
def gen_source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(synthetic.source2_rows(fixtures.table(spark, sf_dir, "customer", "c_custkey"), "c_custkey"))


def _customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "customer", F.col("c_custkey").alias("id"))


def _read_back(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    """Every written dataset in one layout: lists as text, numbers as numbers."""
    out = None
    for name, uri in sorted(written.items()):
        schema, file_format = (SOURCE1 if name.startswith("source1") else SOURCE2), name.partition("_")[2]
        rows = read_source(spark, uri, schema, ReadOptions(file_format))
        lists = [f.name for f in schema if isinstance(f.dataType, T.ArrayType)]
        if file_format == "csv":
            rows = rows.withColumns({c: F.split(c, SEPARATOR) for c in lists})
        rows = flat(rows)
        none = F.lit(None).cast("string")
        own = [
            F.lit(name).alias("dataset"),
            F.col(schema[0].name).alias("name"),
            (F.col("address") if "address" in rows.columns else none).alias("address"),
            F.col(lists[0]).alias("first_list"),
            (F.col(lists[1]) if len(lists) > 1 else none).alias("second_list"),
            *[(F.col(c) if c in rows.columns else none).cast("double").alias(c) for c in ("revenue", "profit")],
        ]
        out = rows.select(*own) if out is None else out.unionByName(rows.select(*own))
    return out


def _sql_written(*formats: str) -> str:
    one = ", ".join(f"('source1_{f}')" for f in formats)
    two = ", ".join(f"('source2_{f}')" for f in formats)
    return f"""{_SQL_CUSTOMER_IDS} SELECT dataset, corporate_name_S1 AS name, address, activity_places AS first_list, top_suppliers AS second_list,
      CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS profit FROM ({_SQL_GEN1}), (VALUES {one}) AS d(dataset)
    UNION ALL SELECT dataset, corporate_name_S2, NULL, main_customers, NULL, revenue, profit FROM ({_SQL_GEN2}), (VALUES {two}) AS d(dataset)"""


@QUERIES.add("gen_save", _sql_written("json", "csv", "parquet"))
def gen_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = synthetic.generate_and_save(spark, 0, scratch_dir(spark, "generated"), "both", ids=_customer_ids(spark, sf_dir))
    return _read_back(spark, written)


@QUERIES.add("gen_job", _sql_written("parquet"))
def gen_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = GenerateConfig(output_uri=scratch_dir(spark, "generated"))
    return _read_back(spark, run_generate(spark, conf, _customer_ids(spark, sf_dir)))
