"""Prices with fractions of a cent, whose halves two engines may round apart."""

import duckdb

import __spark_entry__ as entry_point
from firmweave.catalog import fixtures

PRICES = [-134.575, 256.275, 1104.495, 2.675, 0.285, 2.665, -0.005, 1001.91, 0.49999999999999994 / 100]


def test_hundredths_round_as_sql_does(spark, uri):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(PRICES * 20)], "o_orderkey bigint, o_totalprice double")
    rows.withColumn("o_custkey", rows.o_orderkey).coalesce(1).write.parquet(uri("orders.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{uri('orders.parquet')}/*.parquet'")
    found = entry_point.queries()["to_number"](spark, uri(""))
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(entry_point.oracle_sql()["to_number"]).fetchall())
    expected = con.execute("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) FROM orders").fetchall()
    cents = spark.read.parquet(uri("orders.parquet")).select("o_orderkey", fixtures.hundredths("o_totalprice"))
    assert sorted(map(tuple, cents.collect())) == sorted(expected)
