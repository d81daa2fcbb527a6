"""Files, lake tables and the generator."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from firmweave import lake, session, storage
from firmweave.lake import LakeTable
from firmweave.operators.clean import clean_source1, clean_source2
from firmweave.schemas import SOURCE1, SOURCE2
from firmweave.sinks import files as sinks
from firmweave.sources import files, synthetic

ROWS = [
    (' Ac"me, Inc', "1 Main St,\nTown ", ["a", "b; c"], [" s "]),
    (None, "", None, []),
    ("É", "x", [None, "y"], ["z"]),
]


@pytest.fixture
def source1(spark):
    return spark.createDataFrame(ROWS, SOURCE1)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    ("uri", "explicit", "expected"),
    [("a/b.parquet", "auto", "parquet"), ("b.csv", "auto", "csv"), ("b.json/", "auto", "json"),
     ("b.dat", "auto", "parquet"), ("b.csv", "json", "json"), ("b", "PARQUET", "parquet")],
)
def test_resolve_format(uri, explicit, expected):
    assert files.resolve_format(uri, explicit) == expected


def test_unknown_formats_are_refused(source1, uri):
    with pytest.raises(ValueError, match="no (reader|writer) for format"):
        files.resolve_format("x", "orc")
    with pytest.raises(ValueError, match="no (reader|writer) for format"):
        sinks.write_dataset(source1, uri("x"), "orc")


def test_parquet_and_json_round_trip(spark, source1, uri):
    for fmt in ("parquet", "json"):
        sinks.write_dataset(source1, uri(f"d.{fmt}"), fmt)
        assert values(files.read_source(spark, uri(f"d.{fmt}"), SOURCE1)) == values(source1)


def test_csv_round_trip_keeps_padding_quotes_and_line_breaks(spark, source1, uri):
    sinks.write_dataset(source1, uri("d.csv"), "csv")
    back = files.read_csv(spark, uri("d.csv"), multiline=True)
    assert back.columns == SOURCE1.fieldNames()
    assert values(back) == sorted(
        [(' Ac"me, Inc', "1 Main St,\nTown ", "a; b; c", " s "), (None, None, None, None), ("É", "x", "None; y", "z")],
        key=repr,
    )


def test_csv_from_elsewhere(spark, uri):
    with open(uri("s.csv"), "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["revenue", "corporate_name_S2", "profit"], ["1e3", "A, B", "NA"], ["x", "None", "5"]])
    rows = clean_source2(files.extract_source2(spark, uri("s.csv"))).orderBy("corporate_name_S2").collect()
    assert [(r.corporate_name_S2, r.revenue, r.profit) for r in rows] == [(None, 0.0, 5.0), ("A, B", 1000.0, 0.0)]


@pytest.mark.parametrize("indent", [2, None])
def test_json_array_from_elsewhere(spark, uri, indent):
    records = [{"corporate_name_S2": n, "main_customers": ["a"], "revenue": 1.5, "profit": "2"} for n in ("x", "y")]
    with open(uri("s.json"), "w", encoding="utf-8") as out:
        json.dump(records, out, indent=indent)
    rows = clean_source2(files.extract_source2(spark, uri("s.json"))).orderBy("corporate_name_S2").collect()
    assert [(r.corporate_name_S2, r.main_customers_clean, r.revenue, r.profit) for r in rows] == [
        ("x", ["a"], 1.5, 2.0), ("y", ["a"], 1.5, 2.0)]


def test_json_that_does_not_fit_is_an_error(spark, uri):
    with open(uri("s.json"), "w", encoding="utf-8") as out:
        out.write('{"corporate_name_S2": "x", "main_customers": "not a list"}\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST|cannot"):
        files.extract_source2(spark, uri("s.json")).collect()


def test_load_dataset_names_and_flattens(spark, source1, uri):
    cleaned = clean_source1(source1)
    where = sinks.load_dataset(cleaned, uri("out/"), "source1_cleaned", "json", "20260115_060000")
    assert where == uri("out/source1_cleaned_20260115_060000.json")
    back = spark.read.json(where)
    assert dict(back.dtypes)["top_suppliers_clean"] == "string"
    assert sinks.load_registry(source1, uri("out"), timestamp="t").endswith("/corporate_registry_t.parquet")


def test_scratch_is_the_shared_folder(spark):
    assert storage.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stage_cuts_the_lineage(spark, source1):
    staged = storage.stage(source1, "x")
    assert values(staged) == values(source1)
    assert "ExistingRDD" not in staged._jdf.queryExecution().executedPlan().toString()


# --- lake --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("name", "parts"), [("a.b", ("a", "b")), ("a.b.c", ("a", "b.c")), ("a", ("default", "a"))]
)
def test_split_table_name(name, parts):
    assert lake.split_table_name(name) == parts


def registry_rows(spark, rows):
    return spark.createDataFrame(rows, "corporate_id string, revenue double, processed_date string")


def test_append_doubles_and_partition_values_stay_text(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    rows = registry_rows(spark, [("a", 1.0, "2026-01-15"), ("b", 2.0, "2026-01-16")])
    assert not lake.table_exists(spark, table)
    for _ in range(2):
        lake.append_table(rows, table, "processed_date")
    back = lake.read_table(spark, table)
    assert values(back.select(rows.columns)) == values(rows.union(rows))
    assert dict(back.dtypes)["processed_date"] == "string"


def test_append_fills_partition_column_and_writes_lists_as_json(spark, source1, uri):
    table = LakeTable("db.t", uri("lake"))
    lake.append_table(source1, table, "load_date")
    back = lake.read_table(spark, table)
    assert back.select("load_date").distinct().count() == 1
    kept = {r.corporate_name_S1: r.activity_places for r in back.collect()}
    assert kept == {' Ac"me, Inc': '["a","b; c"]', None: None, "É": '[null,"y"]'}


def test_upsert_twice_is_upsert_once(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    lake.append_table(registry_rows(spark, [("a", 1.0, "2026-01-15"), ("b", 2.0, "2026-01-15")]), table)
    updates = registry_rows(
        spark, [("b", 5.0, "2026-01-16"), ("b", 4.0, "2026-01-14"), ("b", 3.0, "2026-01-16"), ("c", 6.0, "2026-01-16")]
    )
    expected = [("a", 1.0, "2026-01-15"), ("b", 5.0, "2026-01-16"), ("c", 6.0, "2026-01-16")]
    for _ in range(2):
        lake.upsert_table(updates, table)
        assert values(lake.read_table(spark, table)) == expected


def test_upsert_into_a_new_table_and_with_partitions(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    lake.upsert_table(registry_rows(spark, [("a", 1.0, "d1"), ("a", 2.0, "d2")]), table, partition_key="processed_date")
    lake.upsert_table(registry_rows(spark, [("b", 1.0, "d3")]), table, partition_key="processed_date")
    back = lake.read_table(spark, table).select("corporate_id", "revenue", "processed_date")
    assert values(back) == [("a", 2.0, "d2"), ("b", 1.0, "d3")]


def test_append_refuses_rows_of_another_layout(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    rows = registry_rows(spark, [("a", 1.0, "2026-01-15")])
    lake.append_table(rows, table, "processed_date")
    odd = {
        "unpartitioned": (rows, ""),
        "extra": (rows.withColumn("more", F.lit(1)), "processed_date"),
        "missing": (rows.drop("revenue"), "processed_date"),
        "typed": (rows.withColumn("revenue", F.col("revenue").cast("string")), "processed_date"),
    }
    for other, key in odd.values():
        with pytest.raises(ValueError, match="partitioned by"):
            lake.append_table(other, table, key)
    lake.append_table(rows.select("processed_date", "revenue", "corporate_id"), table, "processed_date")
    assert values(lake.read_table(spark, table).select(rows.columns)) == values(rows.union(rows))


def test_partition_column_keeps_its_type(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    rows = registry_rows(spark, [("a", 1.0, "2026-01-15")]).withColumn("day", F.col("processed_date").cast("date"))
    lake.append_table(rows, table, "day")
    assert dict(lake.read_table(spark, table).dtypes)["day"] == "date"


def test_upsert_keeps_the_newest_of_table_and_batch(spark, uri):
    table = LakeTable("db.t", uri("lake"))
    lake.append_table(registry_rows(spark, [("a", 9.0, "2026-02-01"), ("a", 8.0, "2026-02-01")]), table, "processed_date")
    lake.upsert_table(registry_rows(spark, [("a", 1.0, "2026-01-01")]), table)  # late
    assert values(lake.read_table(spark, table).select("revenue")) == [(9.0,)]
    lake.upsert_table(registry_rows(spark, [("a", 2.0, "2026-02-01"), ("a", 3.0, "2026-02-01")]), table)  # tie: the batch, then revenue
    assert values(lake.read_table(spark, table).select("revenue")) == [(3.0,)]
    assert lake.table_version(spark, table).layout.partition_key == "processed_date"
    with pytest.raises(ValueError, match="without corporate_id"):
        lake.upsert_table(registry_rows(spark, [(None, 1.0, "d"), (None, 2.0, "d")]), table)


def test_upsert_tells_companies_with_one_id_apart(spark, uri):
    schema = "corporate_id string, corporate_name string, address string, revenue double, processed_date string"
    rows = spark.createDataFrame([("x", "Ab", "s 1", 1.0, "d"), ("x", "Cd", "s 1", 2.0, "d"), ("x", "AB.", "S1", 3.0, "e")], schema)
    table = LakeTable("db.t", uri("lake"))
    lake.upsert_table(rows, table)
    assert values(lake.read_table(spark, table).select("revenue")) == [(2.0,), (3.0,)]


def test_json_folder_of_both_layouts(spark, tmp_path, uri):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('\n [\n{"corporate_name_S2": "A"},\n{"corporate_name_S2": "B"}\n]')
    (tmp_path / "j/b c.json").write_text('{"corporate_name_S2": "C"}\n{"corporate_name_S2": "D"}\n{"corporate_name_S2": "E"}\n')
    (tmp_path / "j/d.json").write_text("\n")
    names = {r.corporate_name_S2 for r in files.read_json(spark, uri("j"), SOURCE2).collect()}
    assert names == set("ABCDE")
    with pytest.raises(ValueError, match="layout"):
        files.read_json(spark, uri("j"), SOURCE2, "guess")


def test_json_lists_as_text_take_the_text_rule(spark, source1, uri):
    files_out = sinks.load_dataset(clean_source1(source1), uri("out"), "s", "json", "ts")
    options = files.ReadOptions(lists_as_text=True)
    back = files.read_source(spark, files_out, SOURCE1, options)
    assert dict(back.dtypes)["activity_places"] == "string"
    assert back.count() == source1.count()


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions(0) == session.LEAST_PARTITIONS
    assert session.shuffle_partitions(100 << 40) == (100 << 40) // session.PARTITION_BYTES


def test_newest_per_key_limits_rows_before_the_shuffle(spark, uri):
    registry_rows(spark, [("a", 1.0, "d")]).write.parquet(uri("t"))
    plan = lake.newest_per_key(spark.read.parquet(uri("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange"):]


def test_fallback_writes_the_rows_elsewhere(spark, uri):
    rows = registry_rows(spark, [("a", 1.0, "d")])
    broken = LakeTable("db.t", catalog="no_such_catalog")
    where = lake.load_with_fallback(rows, broken, uri("out"), timestamp="ts")
    assert where == uri("out/iceberg_fallback/t_backup_ts.parquet")
    assert values(spark.read.parquet(where)) == values(rows)
    assert lake.load_with_fallback(rows, LakeTable("db.t", uri("lake")), uri("out")) is None
    with pytest.raises(ValueError, match="append or upsert"):
        lake.load_with_fallback(rows, broken, uri("out"), mode="replace")


def test_missing_table(spark, uri):
    with pytest.raises(FileNotFoundError):
        lake.read_table(spark, LakeTable("db.t", uri("lake")))
    with pytest.raises(ValueError, match="neither"):
        lake.read_table(spark, LakeTable("db.t"))


# --- generator ---------------------------------------------------------------------------------


def test_generated_rows_obey_the_rules(spark):
    for r in synthetic.generate_source1(spark, 1000).collect():
        assert 2 <= len(r.activity_places) <= 5 and len(set(r.activity_places)) == len(r.activity_places)
        assert 3 <= len(r.top_suppliers) <= 8 and set(r.top_suppliers) <= set(synthetic.SUPPLIERS)
        assert "\n" not in r.address
    sizes = set()
    for r in synthetic.generate_source2(spark, 1000).collect():
        sizes.add(len(r.main_customers))
        assert len(set(r.main_customers)) == len(r.main_customers)
        assert 10 <= r.revenue <= 5000 and round(r.revenue, 2) == r.revenue
        assert 0.05 * r.revenue - 0.0051 <= r.profit <= 0.20 * r.revenue + 0.0051
    assert sizes == {2, 3, 4, 5, 6}


def test_generated_rows_do_not_depend_on_partitioning(spark):
    for make in (synthetic.source1_rows, synthetic.source2_rows):
        one, seven = make(spark.range(0, 300, 1, 1)), make(spark.range(0, 300, 1, 7))
        assert values(one) == values(seven)
    assert values(synthetic.generate_source2(spark, 50, seed=1)) != values(synthetic.generate_source2(spark, 50, seed=2))


def test_match_rate(spark):
    names = F.col("corporate_name_S1") == F.col("corporate_name_S2")
    s1 = synthetic.generate_source1(spark, 2000)
    for rate in (0.0, 0.5, 1.0):
        matches = s1.join(synthetic.generate_source2(spark, 2000, match_rate=rate), names).count()
        assert abs(matches - 2000 * rate) <= 100


def test_generate_and_save(spark, uri):
    written = synthetic.generate_and_save(spark, 20, uri("data"), "both")
    assert sorted(written) == sorted(f"source{i}_{f}" for i in (1, 2) for f in ("json", "csv", "parquet"))
    assert written["source1_csv"] == uri("data/source1_supply_chain.csv")
    for name, where in written.items():
        assert files.read_source(spark, where, SOURCE1 if "source1" in name else SOURCE2).count() == 20
    with pytest.raises(ValueError, match="cannot generate"):
        synthetic.generate_and_save(spark, 0, uri("none"))
    with pytest.raises(ValueError, match="no (reader|writer) for format"):
        synthetic.generate_and_save(spark, 1, uri("none"), "orc")
