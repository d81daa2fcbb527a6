"""Cleaning, matching, the registry, reports and features."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from firmweave.operators import features
from firmweave.operators.clean import clean_source1, clean_source2
from firmweave.operators.harmonize import harmonize
from firmweave.operators.quality import label_balance, null_profile, quality_report, stage_counts
from firmweave.operators.resolve import match_diagnostics, resolve_entities
from firmweave.plans.etl import build_registry
from firmweave.schemas import REGISTRY, SOURCE1, SOURCE2

DATE = "2026-01-15"


@pytest.fixture
def source1(spark):
    rows = [
        (" Acme, Inc ", " 1  Main St ", ["Mill", " Dock "], ["S1", None, "S;2"]),
        ("none", "x", None, []),
        (None, None, ["a"], ["b"]),
        (None, "y", ["c"], ["d"]),
        ("Solo", "z", ["e"], ["f"]),
    ]
    return spark.createDataFrame(rows, SOURCE1)


@pytest.fixture
def source2(spark):
    rows = [
        ("ACME inc", ["['A', 'B']", None], 200.0, 20.0),
        ("None", ["c"], 0.0, 5.0),
        (None, ["d"], math.nan, None),
        ("!!", ["e"], 6000.0, 60.0),
        ("Lone", ["f"], 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, SOURCE2)


def test_clean_source1_keeps_rows_and_raw_columns(source1):
    cleaned = clean_source1(source1)
    assert cleaned.columns[:4] == SOURCE1.fieldNames()
    first = cleaned.first()
    assert first.activity_places_clean == ["Mill", "Dock"]
    assert first.top_suppliers_clean == ["S1", "None", "S;2"]
    assert (first.corporate_name_clean, first.address_clean) == ("Acme, Inc", "1 Main St")
    assert cleaned.count() == 5


def test_clean_follows_the_column_type(spark):
    s1 = spark.createDataFrame([("n", "a", "x; y", 7)], "corporate_name_S1 string, address string, "
                               "activity_places string, top_suppliers int")
    row = clean_source1(s1).first()
    assert (row.activity_places_clean, row.top_suppliers_clean) == (["x", "y"], ["7"])
    s2 = spark.createDataFrame([("n", "x, y", "1e3", "abc")], "corporate_name_S2 string, main_customers string, "
                               "revenue string, profit string")
    row = clean_source2(s2).first()
    assert (row.main_customers_clean, row.revenue, row.profit) == (["x", "y"], 1000.0, 0.0)
    assert (row.profit_margin, row.revenue_category) == (0.0, "Large")


def test_sources_may_lack_list_columns(spark):
    s1 = spark.createDataFrame([("n", "a")], "corporate_name_S1 string, address string")
    s2 = spark.createDataFrame([("N", 5.0, 1.0)], "corporate_name_S2 string, revenue double, profit double")
    row = build_registry(s1, s2, DATE).first()
    assert (row.activity_places, row.main_customers, row.num_suppliers) == (None, None, 0)


def test_blank_keys_pair_with_each_other(spark):
    s1 = clean_source1(spark.createDataFrame([(n, "", [], []) for n in (None, "!", "a")], SOURCE1))
    s2 = clean_source2(spark.createDataFrame([(n, [], 1.0, 1.0) for n in (None, "", "a", "A")], SOURCE2))
    assert resolve_entities(s1, s2).count() == 6
    assert resolve_entities(s1, s2, drop_blank_keys=True).count() == 2


def test_clashing_names_get_suffixes(source1, source2):
    resolved = resolve_entities(clean_source1(source1), clean_source2(source2))
    assert {"corporate_name_clean_s1", "corporate_name_clean_s2", "name_key", "address_key"} <= set(resolved.columns)
    assert "corporate_name_clean" not in resolved.columns


def test_registry_values(source1, source2):
    registry = build_registry(source1, source2, DATE)
    assert registry.columns == REGISTRY.fieldNames()
    assert [f.dataType for f in registry.schema] == [f.dataType for f in REGISTRY]
    rows = {r.main_customers: r for r in registry.filter("address = '1  Main St'").collect()}
    acme = rows["A; B"]
    assert acme.corporate_name == "Acme, Inc"
    # An item that holds a semicolon counts twice, a missing item not at all.
    assert (acme.top_suppliers, acme.num_suppliers, acme.num_customers) == ("S1; S;2", 3, 2)
    assert (acme.profit_margin, acme.revenue_category, acme.source) == (10.0, "Medium", "harmonized")
    assert acme.processed_date == DATE


def test_registry_null_rules(source1, source2):
    rows = build_registry(source1, source2, DATE).collect()
    by_customer = {r.main_customers: r for r in rows}
    # The name "none" is a null token; the name key it matched on is not.
    assert by_customer["c"].corporate_name is None
    # Two rows without a name on one side, and two with a blank key on the other: four pairs.
    assert Counter(r.main_customers for r in rows) == {"A; B": 1, "c": 1, "d": 2, "e": 2}
    assert by_customer["d"].revenue == 0.0 and by_customer["d"].revenue_category == "Small"
    # S1 has no name, so that of S2 stands in.
    assert by_customer["e"].corporate_name == "!!"


def test_harmonize_fills_missing_columns(spark):
    row = harmonize(spark.createDataFrame([("id1",)], "corporate_id string"), DATE).first()
    assert (row.corporate_name, row.revenue, row.revenue_category, row.num_customers) == (None, 0.0, "Unknown", 0)


def brute_force_diagnostics(s1, s2):
    """The full outer join written out pair by pair."""
    left = [(r.corporate_name_clean, r.corporate_name_S1) for r in s1.collect()]
    right = [(r.corporate_name_clean, r.corporate_name_S2) for r in s2.collect()]

    def key(name):
        return "".join(c for c in name.lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789")

    pairs = [(a, b) for n, a in left for m, b in right if key(n) == key(m)]
    pairs += [(a, None) for n, a in left if key(n) not in {key(m) for m, _ in right}]
    pairs += [(None, b) for m, b in right if key(m) not in {key(n) for n, _ in left}]
    kinds = Counter((a is not None, b is not None) for a, b in pairs)
    return (kinds[True, True], kinds[True, False], kinds[False, True], kinds[False, False])


def test_match_diagnostics_equal_the_full_outer_join(source1, source2):
    s1, s2 = clean_source1(source1), clean_source2(source2)
    row = match_diagnostics(s1, s2).first()
    found = tuple(int(row[c]) for c in ("matched", "s1_only", "s2_only", "neither"))
    assert found == brute_force_diagnostics(s1, s2)


def test_match_diagnostics_of_nothing(source1, source2):
    row = match_diagnostics(clean_source1(source1.limit(0)), clean_source2(source2.limit(0))).first()
    assert [int(v) for v in row] == [0] * 6


def test_hot_key_partition_is_split(spark):
    """A key that holds most rows: adaptive execution splits its partition, and no pair is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        name = F.when(F.col("id") % 2 == 0, F.lit("Hot Inc")).otherwise(F.concat(F.lit("firm "), F.col("id")))
        wide = F.sha2(F.col("id").cast("string"), 512)
        empty = F.array().cast("array<string>")
        s1 = spark.range(0, 20000, 1, 8).select(
            name.alias("corporate_name_S1"), wide.alias("address"), empty.alias("activity_places"), empty.alias("top_suppliers"))
        s2 = spark.range(0, 20000, 1, 8).filter("id % 2 = 1 or id < 20").select(
            name.alias("corporate_name_S2"), empty.alias("main_customers"), F.lit(1.0).alias("revenue"), F.lit(1.0).alias("profit"))
        registry = build_registry(s1, s2, DATE)
        rows = registry.select("corporate_id", "address").collect()
        assert len(rows) == 10000 * 10 + 10000
        plan = registry.select("corporate_id", "address")
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_python_in_the_registry_plan(source1, source2):
    plan = build_registry(source1, source2)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapInArrow" not in plan


def test_stage_counts_and_null_profile(source1):
    counts = {r.stage: r.rows for r in stage_counts({"a": source1, "b": source1.limit(2)}).collect()}
    assert counts == {"a": 5, "b": 2}
    nulls = {r.column_name: r.nulls for r in null_profile(source1).collect()}
    assert nulls == {"corporate_name_S1": 2, "address": 1, "activity_places": 1, "top_suppliers": 0}


def test_quality_report(source1, source2):
    report = quality_report(clean_source1(source1), clean_source2(source2), build_registry(source1, source2, DATE))
    found = {(r.stage, r.metric): r.value for r in report.collect()}
    assert found["source1", "rows"] == 5 and found["source2", "rows"] == 5 and found["registry", "rows"] == 6
    assert found["resolve", "s2_only"] == 3 and found["registry", "nulls_address"] == 2
    assert len(found) == 2 + 4 + 1 + len(REGISTRY)


# --- features ----------------------------------------------------------------------------------

# The five-row smoke sample.
SAMPLE = [
    ("corp1", "One", 1000.0, 150.0, 15.0, 5, 3, 2, "Large"),
    ("corp2", "Two", 500.0, 80.0, 16.0, 3, 2, 1, "Medium"),
    ("corp3", "Three", 2000.0, 250.0, 12.5, 8, 5, 3, "Enterprise"),
    ("corp4", "Four", 50.0, 30.0, 60.0, 2, 1, 1, "Small"),
    ("corp5", "Five", 1500.0, 120.0, 8.0, 6, 4, 2, "Large"),
]
SAMPLE_COLUMNS = (
    "corporate_id string, corporate_name string, revenue double, profit double, profit_margin double, "
    "num_suppliers int, num_customers int, num_activity_places int, revenue_category string"
)


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(SAMPLE, SAMPLE_COLUMNS)


def test_sample_labels_and_features(sample):
    rows = features.engineer_features(sample, 100.0).orderBy("corporate_id").collect()
    assert [r.high_profit for r in rows] == [1.0, 0.0, 1.0, 0.0, 1.0]
    assert rows[0].revenue_log == pytest.approx(math.log(1001))
    assert rows[0].profit_margin_normalized == pytest.approx(0.15)
    assert rows[1].supplier_customer_ratio == 1.5


def test_bad_text_becomes_null_and_drops_the_row(spark):
    df = spark.createDataFrame(
        [("a", "n", "12.5", "nan", None, "3", "x", "1", "c"), ("b", "n", "12.5", "7", None, "3", "x", "1", "c")],
        SAMPLE_COLUMNS.replace("double", "string").replace("int", "string"),
    )
    (row,) = features.engineer_features(df).collect()
    assert (row.corporate_id, row.num_customers, row.supplier_customer_ratio) == ("b", None, 0.0)
    assert row.profit_margin_normalized == 0.0


def test_filter_and_columns_reach_the_scan(spark, sample, uri, capsys):
    sample.write.parquet(uri("table"))
    features.prepare_features(features.engineer_features(spark.read.parquet(uri("table")))).explain("formatted")
    plan = capsys.readouterr().out
    (pushed,) = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert all(f"IsNotNull({c})" in pushed for c in features.REQUIRED)
    (read,) = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert "num_customers" not in read and "corporate_name" not in read


def test_assembler_drops_null_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 1.0), ("c", math.nan, 1.0)], "corporate_id string, x double, y double")
    assert [r.corporate_id for r in features.assemble(df, ["x", "y"]).collect()] == ["a"]


def test_filter_features(spark):
    rows = [("a", 1.0, 2.0), ("b", None, 1.0), ("c", 0.0, None)]
    df = spark.createDataFrame(rows, "corporate_id string, high_profit double, x double")
    assert [r.corporate_id for r in features.filter_features(df, ["x"]).collect()] == ["a"]


def test_label_balance(spark, sample):
    row = label_balance(features.engineer_features(sample)).first()
    assert (row.positives, row.total, row.percent) == (3, 5, 60.0)
    empty = label_balance(features.engineer_features(sample.limit(0))).first()
    assert (empty.positives, empty.total, empty.percent) == (0, 0, None)


def test_a_hot_key_is_cut_without_adaptive_execution(spark):
    """The largest task holds a fraction of the blank key's pairs, and the pairs are all there."""
    from firmweave.operators import resolve

    left = spark.createDataFrame([(None if i % 2 else f"n{i}", "a", i) for i in range(800)], "corporate_name_clean string, address_clean string, i int")
    right = spark.createDataFrame([(None if i < 5 else f"n{i}", i) for i in range(40)], "corporate_name_clean string, j int")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes, pairs = {}, {}
        for hot_rows in (None, 20):
            rows = resolve.resolve_entities(left, right, hot_rows=hot_rows)
            pairs[hot_rows] = sorted((r.i, r.j) for r in rows.collect())
            sizes[hot_rows] = max(r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert pairs[None] == pairs[20] and len(pairs[20]) == 400 * 5 + 17
    assert sizes[None] >= 2000 and sizes[20] < 1200


def test_a_key_hot_on_both_sides_meets_in_even_cells(spark):
    """A third of both sides without a name: no cell of the grid is large, and the pairs are those of the plain join."""
    from firmweave.operators import resolve

    left = spark.createDataFrame([(None if i % 3 == 0 else f"n{i}", "a", i) for i in range(900)], "corporate_name_clean string, address_clean string, i int")
    right = spark.createDataFrame([(" -" if i % 3 == 1 else f"n{i}", i) for i in range(600)], "corporate_name_clean string, j int")
    keyed = resolve.with_keys(left, True), resolve.with_keys(right, False)
    sides = resolve.gridded(*keyed, 20)
    for side, total, repeats in zip(sides, (300, 200), (10, 15), strict=True):
        cells = [r["count"] for r in side.where("name_key = ''").groupBy(resolve._ROW, resolve._COLUMN).count().collect()]
        assert sum(cells) == total * repeats and len(cells) == 150 and max(cells) <= 2 * 20
        assert side.where("name_key <> ''").count() == {300: 600, 200: 400}[total]
    pairs = {
        hot: sorted((r.i, r.j) for r in resolve.resolve_entities(left, right, hot_rows=hot).collect()) for hot in (None, 20, 1_000_000)
    }
    assert pairs[None] == pairs[20] == pairs[1_000_000] and len(pairs[20]) >= 300 * 200


def test_hot_keys_of_no_rows(spark):
    from firmweave.operators import resolve

    left = spark.createDataFrame([], "corporate_name_clean string, address_clean string, i int")
    right = spark.createDataFrame([("a", 1)], "corporate_name_clean string, j int")
    assert resolve.resolve_entities(left, right, hot_rows=1).count() == 0


def test_rows_without_a_name_are_set_aside(spark):
    from firmweave.operators import resolve

    rows = spark.createDataFrame([("A",), (None,), (" -.",)], "corporate_name_clean string")
    assert resolve.blank_rows(rows).count() == 2


def test_the_blank_key_is_cut_without_being_counted(spark):
    """The pairs of rows without a name are dealt to many tasks; pairs and registry are those of the plain join."""
    from firmweave.operators import resolve
    from firmweave.operators.clean import clean_source1, clean_source2
    from firmweave.operators.harmonize import harmonize, prepared

    left = spark.createDataFrame(
        [(None if i % 2 else f"n{i}", f" a {i}", ["x", "none", f" {i}"], ["s"]) for i in range(400)],
        "corporate_name_S1 string, address string, activity_places array<string>, top_suppliers array<string>",
    )
    right = spark.createDataFrame(
        [(" - " if i < 200 else "nan" if i == 200 else f"n{i}", ["['b' 'c']"], float(i), 1.0) for i in range(400)],
        "corporate_name_S2 string, main_customers array<string>, revenue double, profit double",
    )
    s1, s2 = clean_source1(left), clean_source2(right)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = harmonize(resolve.resolve_entities(s1, s2), "2026-01-15")
        cut = harmonize(resolve.resolve_entities(prepared(s1), prepared(s2), blank_parts=resolve.BLANK_PARTS), "2026-01-15")
        largest = [max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()) for df in (plain, cut)]
        rows = [sorted(map(tuple, df.collect()), key=repr) for df in (plain, cut)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert rows[0] == rows[1] and len(rows[0]) == 200 * 200 + 99
    assert largest[0] >= 40_000 and largest[1] < 16_000
    assert plain.schema == cut.schema
