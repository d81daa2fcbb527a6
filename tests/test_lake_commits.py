"""Commits: whole or nothing, once per batch, and upserts and compaction that touch only what they must."""

import threading

import pytest
from pyspark.sql import functions as F

from firmweave import commits, lake, storage
from firmweave.lake import LakeTable

SCHEMA = "corporate_id string, revenue double, processed_date string"


@pytest.fixture
def table(uri):
    return LakeTable("db.t", uri("lake"))


def rows(spark, *ids, revenue=1.0, date="2026-01-15"):
    return spark.createDataFrame([(i, revenue, date) for i in ids], SCHEMA)


def stored(spark, table):
    return sorted((r.corporate_id, r.revenue) for r in lake.read_table(spark, table).collect())


def files(spark, table):
    return set(lake.table_version(spark, table).files)


def failing(spark, at):
    """Rows of several tasks of which one fails."""
    bad = F.when(F.col("id") == at, F.raise_error(F.lit("broken row"))).otherwise(F.lit(1.0)).cast("double")
    return spark.range(0, 100, 1, 4).select(F.concat(F.lit("x"), "id").alias("corporate_id"), bad.alias("revenue"), F.lit("2026-01-15").alias("processed_date"))


def test_a_failed_write_leaves_no_row(spark, table, tmp_path):
    lake.append_table(rows(spark, "a"), table)
    for write in (lake.append_table, lake.upsert_table):
        with pytest.raises(Exception, match="broken row"):
            write(failing(spark, 99), table)
        assert stored(spark, table) == [("a", 1.0)]
    assert len(list((tmp_path / "lake/db/t/data").iterdir())) == 1  # and no file


def test_files_that_no_commit_names_are_not_read(spark, table, tmp_path):
    lake.append_table(rows(spark, "a"), table)
    left = tmp_path / "lake/db/t/data/_write=killed"
    rows(spark, "b").write.parquet(str(left))
    (tmp_path / "lake/db/t/_commits/00000000000000000002.json.123.draft").write_text("{")
    assert stored(spark, table) == [("a", 1.0)]
    assert lake.append_table(rows(spark, "c"), table) and stored(spark, table) == [("a", 1.0), ("c", 1.0)]
    assert lake.remove_uncommitted(spark, table) == ["_write=killed"] and not left.exists()
    assert stored(spark, table) == [("a", 1.0), ("c", 1.0)]


def test_a_reader_keeps_its_version(spark, table):
    lake.append_table(rows(spark, "a"), table)
    before = lake.read_table(spark, table)
    lake.upsert_table(rows(spark, "a", revenue=9.0), table)
    assert [r.revenue for r in before.collect()] == [1.0] and stored(spark, table) == [("a", 9.0)]


def test_two_writers_between_files_and_commit(spark, table, monkeypatch):
    lake.append_table(rows(spark, "a"), table)
    real, others = commits.commit, iter(["b", "c"])

    def late(*args, **more):
        other = next(others, None)
        if other:  # another writer commits after our files were written
            assert lake.append_table(rows(spark, other), table)
        return real(*args, **more)

    monkeypatch.setattr(commits, "commit", late)
    assert lake.append_table(rows(spark, "d"), table)
    assert stored(spark, table) == [(i, 1.0) for i in "abcd"]


def test_an_upsert_merges_again_if_another_was_first(spark, table, monkeypatch):
    lake.upsert_table(rows(spark, "a", "b"), table, buckets=4)
    real, others = commits.commit, iter([rows(spark, "a", "c", revenue=2.0, date="2026-03-01")])

    def late(*args, **more):
        other = next(others, None)
        if other is not None:
            assert lake.upsert_table(other, table)
        return real(*args, **more)

    monkeypatch.setattr(commits, "commit", late)
    assert lake.upsert_table(rows(spark, "a", "b", revenue=3.0, date="2026-02-01"), table)
    assert stored(spark, table) == [("a", 2.0), ("b", 3.0), ("c", 2.0)]


def test_many_writers_at_once(spark, table):
    lake.append_table(rows(spark, "start"), table)
    failures = []

    def write(i):
        try:
            lake.append_table(rows(spark, f"w{i}"), table, batch=f"run-{i % 6}")
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    assert len(stored(spark, table)) == 7  # each of six batches once
    assert lake.table_version(spark, table).number == 7


def test_a_batch_counts_once(spark, table):
    for _ in range(3):
        lake.append_table(rows(spark, "a"), table, batch="monday")
    for i in range(25):  # beyond a full commit
        assert lake.append_table(rows(spark, f"b{i}"), table)
    assert not lake.append_table(rows(spark, "a"), table, batch="monday")
    assert lake.append_table(rows(spark, "a"), table, batch="tuesday")
    assert len(stored(spark, table)) == 27
    assert lake.upsert_table(rows(spark, "z"), table, batch="up") and not lake.upsert_table(rows(spark, "z", revenue=5.0), table, batch="up")
    assert ("z", 1.0) in stored(spark, table)


@pytest.mark.parametrize("partition_key", ["", "processed_date"])
def test_an_upsert_rewrites_only_its_buckets(spark, table, partition_key):
    ids = [f"id{i}" for i in range(2000)]
    lake.append_table(rows(spark, *ids), table, partition_key)
    lake.upsert_table(rows(spark, "id0"), table, buckets=100)  # lays the table out
    bucket = spark.createDataFrame([(i,) for i in ids], "corporate_id string").withColumn("b", lake.bucket_of("corporate_id", 100))
    some = [r.corporate_id for r in bucket.where("b = 7").collect()]
    before = lake.table_version(spark, table).files
    lake.upsert_table(rows(spark, *some, revenue=2.0, date="2026-02-01"), table)
    after = lake.table_version(spark, table).files
    assert {before[p].bucket for p in before.keys() - after.keys()} == {7} == {after[p].bucket for p in after.keys() - before.keys()}
    rewritten = sum(after[p].size for p in after.keys() - before.keys())
    assert rewritten < 0.03 * sum(f.size for f in after.values())
    assert stored(spark, table) == sorted([(i, 2.0 if i in set(some) else 1.0) for i in ids])
    lake.append_table(rows(spark, "id0", "id0", revenue=7.0, date="2026-03-01"), table, partition_key)  # into its bucket
    lake.upsert_table(rows(spark, "new", date="2026-03-01"), table)
    lake.upsert_table(rows(spark, "id0", revenue=0.5, date="2026-03-01"), table)
    found = stored(spark, table)
    assert [r for r in found if r[0] in ("id0", "new")] == [("id0", 0.5), ("new", 1.0)] and len(found) == 2001


def test_old_versions_go(spark, table, tmp_path):
    for k in range(24):
        lake.upsert_table(rows(spark, "a", "b", revenue=float(k)), table, buckets=2)
    folders = {p.split("/")[1] for p in files(spark, table)}
    assert len(list((tmp_path / "lake/db/t/data").iterdir())) <= len(folders) + 2
    assert len(list((tmp_path / "lake/db/t/_commits").glob("*.json"))) <= 2 * commits.FULL_EVERY
    assert stored(spark, table) == [("a", 23.0), ("b", 23.0)]


@pytest.mark.parametrize("buckets", [0, 3])
def test_compaction(spark, table, buckets):
    if buckets:
        lake.upsert_table(rows(spark, "a", "b", "c"), table, buckets=buckets)
    for k in range(30):
        lake.append_table(rows(spark, f"x{k}", f"y{k}").repartition(2), table)
    before, reader, count = stored(spark, table), lake.read_table(spark, table), len(files(spark, table))
    assert lake.compact_table(spark, table) == count > 30
    assert len(files(spark, table)) <= max(buckets, 1)
    assert stored(spark, table) == before == sorted((r.corporate_id, r.revenue) for r in reader.collect())
    assert lake.compact_table(spark, table) == 0


def test_tables_of_no_rows(spark, table):
    for key in ("", "processed_date"):
        none = LakeTable(f"db.none{key}", table.root)
        lake.append_table(rows(spark), none, key)
        lake.upsert_table(rows(spark), none)
        assert lake.compact_table(spark, none) == 0 and stored(spark, none) == []
        lake.upsert_table(rows(spark, "a"), none)
        assert stored(spark, none) == [("a", 1.0)]


def test_reserved_names_and_catalogs(spark, table):
    with pytest.raises(ValueError, match="cannot have columns"):
        lake.append_table(rows(spark, "a").withColumn("_bucket", F.lit(1)), table)
    for write in (lake.append_table, lake.upsert_table):
        with pytest.raises(ValueError, match="folder tables"):
            write(rows(spark, "a"), LakeTable("db.t", catalog="c"), batch="x")


def test_a_catalog_merges_on_id_name_and_address(spark):
    """No catalog that merges is here; the condition itself is tried on a join."""
    schema = "corporate_id string, corporate_name string, address string"
    old = spark.createDataFrame([("x", "Ab", "s 1"), ("y", None, "s")], schema).alias("t")
    new = spark.createDataFrame([("x", "AB.", "S1"), ("x", "Cd", "s 1"), ("y", "", "S")], schema).alias("s")
    met = old.join(new, lake.merge_condition(old.columns, "t")).select("s.corporate_id", "s.corporate_name").collect()
    assert sorted(map(tuple, met)) == [("x", "AB."), ("y", "")]
    assert storage.exists(spark, storage.scratch_root(spark))


def test_a_name_is_given_once(spark, uri):
    assert storage.publish_text(spark, uri("f"), "one") and not storage.publish_text(spark, uri("f"), "two")
    assert storage.read_text(spark, uri("f")) == "one" and storage.child_names(spark, uri("")) == ["f"]
