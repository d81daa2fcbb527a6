"""Top-level JSON arrays in files of bounded size."""

import json

import pytest

from firmweave.catalog.registry_queries import write_json_arrays
from firmweave.sources import json_arrays
from firmweave.sources.files import json_array_files, read_json


def test_arrays_are_spread_over_files_and_read_back(spark, uri):
    rows = spark.createDataFrame([("one name", i, None if i % 3 else ["a", str(i)]) for i in range(300)], "name string, n long, l array<string>")
    rows.where("n < 20").write.json(uri("mixed"), ignoreNullFields=False)
    write_json_arrays(rows.where("n >= 20"), uri("mixed"), array_rows=20)
    lines, arrays = json_array_files(spark, uri("mixed"))
    assert lines and len(arrays) >= 10
    for path in arrays:
        assert 0 < read_json(spark, path, rows.schema, "array").count() < 60
    assert sorted(map(repr, read_json(spark, uri("mixed"), rows.schema).collect())) == sorted(map(repr, rows.collect()))


SCHEMA = "name string, n long, l array<string>, o struct<a:string,b:struct<c:string>>, d double"

TEXTS = ["plain", 'quo"te', "br}ace", "}{][", "back\\slash\\", "\\\"}", "new\nline", "tab\t", "", "é日本\U0001f600", "\u2028", "a,b", "},\n {"]


def records(n):
    out = []
    for i in range(n):
        r = {"name": TEXTS[i % len(TEXTS)], "n": i, "l": [TEXTS[(i + k) % len(TEXTS)] for k in range(i % 4)], "d": i / 4}
        if i % 3 == 0:
            r["o"] = {"a": TEXTS[(i + 5) % len(TEXTS)], "b": {"c": "}" if i % 2 else None} if i % 6 == 0 else None}
        if i % 7 == 0:
            r["l"] = None
        out.append(r)
    return out


@pytest.mark.parametrize(("indent", "ascii_only"), [(2, False), (None, True), (None, False), (0, True)])
def test_a_large_array_is_read_by_many_tasks(spark, uri, tmp_path, indent, ascii_only):
    (tmp_path / "j").mkdir()
    for k, n in enumerate((1200, 1, 0)):
        with open(tmp_path / f"j/{k}.json", "w", encoding="utf-8") as out:
            json.dump(records(n), out, indent=indent, ensure_ascii=ascii_only)
    schema = spark.createDataFrame([], SCHEMA).schema
    expected = sorted(map(repr, spark.read.json(uri("j"), schema=schema, multiLine=True, mode="FAILFAST").collect()))
    assert len(expected) == 1201
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        paths = [str(tmp_path / f"j/{k}.json") for k in range(3)]
        assert json_arrays._pieces(spark, paths).rdd.getNumPartitions() > 8
        found = json_arrays.read_json_array(spark, paths, schema)
        assert sorted(map(repr, found.collect())) == expected
        assert sorted(map(repr, read_json(spark, uri("j"), schema).collect())) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


@pytest.mark.parametrize("text", ['[{"n": 1}', '[{"n": 1}, {"n": 2', '[{"n": 1}] trailing', '[{"n": 1},, {"n": 2}]', '[{"n": 1} {"n": 2}]', '[{"n": "x"}]', '[{"n": 1}, {"name": "open}]', '{"n": 1}'])
def test_what_is_not_one_whole_array_is_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(Exception, match="not one whole|MALFORMED|Malformed|FAILFAST"):
        json_arrays.read_json_array(spark, [str(tmp_path / "a.json")], schema).collect()


def test_the_layout_follows_the_first_character_that_is_not_blank(spark, uri, tmp_path):
    (tmp_path / "j").mkdir()
    for k, blank in enumerate(["\r\n", "\n\t\n ", "﻿\n", " \n" * 3000]):
        (tmp_path / f"j/a{k}.json").write_text(blank + "[\n" + json.dumps({"n": k}) + "]", encoding="utf-8", newline="")
        (tmp_path / f"j/l{k}.json").write_text("\n" * k + json.dumps({"n": 10 + k, "l": ["["]}), encoding="utf-8", newline="")
    lines, arrays = json_array_files(spark, uri("j"))
    assert sorted(p.rsplit("/", 1)[1] for p in arrays) == [f"a{k}.json" for k in range(4)]
    assert len(lines) == 4
    found = read_json(spark, uri("j"), spark.createDataFrame([], "n long, l array<string>").schema)
    assert sorted(r.n for r in found.collect()) == [0, 1, 2, 3, 10, 11, 12, 13]
