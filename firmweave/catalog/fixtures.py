"""Source datasets derived from the driver's tables.

A corporation is a customer. In the supply-chain source the part types it bought are its activity
places and the suppliers it spent most on its top suppliers; in the financial source brands stand
in for customers, spend for revenue and discounts for profit. One customer in ten carries a
different name on one side or the other, so that not all of them match.

Each source is given once as a Spark plan and once as SQL.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmweave.plans.etl import build_registry
from firmweave.catalog import duck

DATE = "2026-01-15"

# The columns in use, so that opening a table needs no look into its files.
_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_discount double",
    "documents": "doc_id bigint, text string",
}

# The most suppliers any customer lists: 3 + the largest remainder below.
_MOST_SUPPLIERS = 8


def table(spark: SparkSession, sf_dir: str, name: str, *columns: Column | str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _purchases(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    """Line items with the customer that ordered them."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", *columns)
    orders = table(spark, sf_dir, "orders", "o_orderkey", F.col("o_custkey").alias("ck"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def hundredths(column: str) -> Column:
    """A value as a whole number of hundredths, which adds up exactly; halves of one go away from zero, as SQL's DECIMAL rounds a double."""
    exact = F.col(column) * 100
    half = F.abs(exact - F.rint(exact)) == 0.5
    return F.when(half, exact + F.signum(exact) / 2).otherwise(F.rint(exact)).cast("bigint")


def _parts(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", column)


def _top_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by spend. The rank bound lets Spark cut each task's rows before the shuffle."""
    spend = (
        _purchases(spark, sf_dir, "l_suppkey", hundredths("l_extendedprice").alias("cents"))
        .groupBy("ck", "l_suppkey")
        .agg(F.sum("cents").alias("spend"))
        .join(table(spark, sf_dir, "supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    by_spend = Window.partitionBy("ck").orderBy(F.desc("spend"), "s_name")
    return (
        spend.select("ck", "s_name", "spend")
        .withColumn("rn", F.row_number().over(by_spend))
        .filter((F.col("rn") <= _MOST_SUPPLIERS) & (F.col("rn") <= 3 + F.col("ck") % 6))
        .groupBy("ck")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "s_name")))["s_name"].alias("top_suppliers"))
    )


def _activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types bought; the list is no longer than the catalogue of types."""
    return (
        _purchases(spark, sf_dir, "l_partkey")
        .join(_parts(spark, sf_dir, "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select("ck", "p_type")
        .distinct()
        .groupBy("ck")
        .agg(F.sort_array(F.collect_list("p_type")).alias("activity_places"))
    )


def _finances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend and discounts, and brands by spend, out of one pass over the line items.

    Sums per brand come first, so a customer brings at most one row per brand of the catalogue
    to its final group.
    """
    cents, percent = F.col("cents"), F.col("percent")
    per_brand = (
        _purchases(
            spark, sf_dir, "l_partkey",
            hundredths("l_extendedprice").alias("cents"), hundredths("l_discount").alias("percent"),
        )
        .join(_parts(spark, sf_dir, "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("ck", "p_brand")
        .agg(F.sum("cents").alias("spend"), F.sum(cents * percent).alias("discount"))
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("spend")).alias("order"), "p_brand")))

    def money(units: Column) -> Column:
        """A sum of ten-thousandths as a decimal, which no number of brands overflows."""
        return (F.sum(units) * F.lit(Decimal("0.0001"))).cast("decimal(38,4)")

    spend, discount = (F.col(c).cast("decimal(20,0)") for c in ("spend", "discount"))
    return per_brand.groupBy("ck").agg(
        money(spend * 100 - discount).alias("net"), money(discount).alias("discount"), ranked["p_brand"].alias("brands")
    )


def _scale() -> Column:
    """Spreads revenue over all buckets."""
    return (
        F.when(F.col("ck") % 4 == 0, 1000.0).when(F.col("ck") % 4 == 1, 5000.0)
        .when(F.col("ck") % 4 == 2, 30000.0).otherwise(300.0)
    )


def decorated_name(key: Column, name: Column) -> Column:
    """Spellings of one name that share a match key."""
    return (
        F.when(key % 4 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(key % 4 == 1, F.upper(name))
        .when(key % 4 == 2, F.replace(name, F.lit("#"), F.lit(" # ")))
        .otherwise(F.lower(name))
    )


def raw_address() -> Column:
    return F.concat(F.lit(" "), F.col("n_name"), F.lit(",   "), F.col("r_name"), F.lit("  "))


def customers_with_place(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer", F.col("c_custkey").alias("ck"), "c_name", "c_nationkey", *columns)
        .join(table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _other_name(remainder: int, suffix: str) -> Column:
    name = F.col("c_name")
    return F.when(F.col("ck") % 10 == remainder, F.concat(name, F.lit(suffix))).otherwise(name)


def keyed_source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        customers_with_place(spark, sf_dir)
        .join(_activities(spark, sf_dir), "ck")
        .join(_top_suppliers(spark, sf_dir), "ck")
        .select(
            "ck",
            decorated_name(F.col("ck"), _other_name(9, " Holdings")).alias("corporate_name_S1"),
            raw_address().alias("address"),
            "activity_places",
            "top_suppliers",
        )
    )


def keyed_source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer", F.col("c_custkey").alias("ck"), "c_name")
        .join(_finances(spark, sf_dir), "ck")
        .select(
            "ck",
            _other_name(8, " Trading").alias("corporate_name_S2"),
            F.slice("brands", F.lit(1), (2 + F.col("ck") % 5).cast("int")).alias("main_customers"),
            (F.col("net").cast("double") / _scale()).alias("revenue"),
            (F.col("discount").cast("double") / _scale()).alias("profit"),
            "net",
            "discount",
        )
    )


def source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_source1(spark, sf_dir).drop("ck")


def source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_source2(spark, sf_dir).drop("ck", "net", "discount")


def _renamed(column: str, null: int, marks: int, twin: int, back: int) -> Column:
    """A few rows in 200 with no name, with a name of punctuation, and with the name of an earlier customer."""
    place = F.col("ck") % 200
    other = F.concat(F.lit("Customer#"), F.lpad((F.col("ck") - back).cast("string"), 9, "0"))
    return F.when(place == null, F.lit(None)).when(place == marks, F.lit(" -.* ")).when(place == twin, other).otherwise(F.col(column))


def hard_source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source1`` with missing, blank and repeated names."""
    rows = keyed_source1(spark, sf_dir)
    return rows.withColumn("corporate_name_S1", _renamed("corporate_name_S1", 7, 17, 27, 1)).drop("ck")


def hard_source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source2`` with missing, blank and repeated names, some of them the same as in ``hard_source1``."""
    rows = keyed_source2(spark, sf_dir).drop("net", "discount")
    return rows.withColumn("corporate_name_S2", _renamed("corporate_name_S2", 57, 67, 28, 2)).drop("ck")


def _joined(column: str, separator: str) -> Column:
    return F.array_join(column, separator)


def _delimited(column: str) -> Column:
    """Semicolon text with the blanks and gaps that people leave in it."""
    ck = F.col("ck")
    return (
        F.when(ck % 6 == 0, _joined(column, "; "))
        .when(ck % 6 == 1, F.concat(F.lit(" "), _joined(column, " ; "), F.lit(" ;")))
        .when(ck % 6 == 2, F.lit(None))
        .when(ck % 6 == 3, _joined(column, ";;"))
        .when(ck % 6 == 4, F.lit("   "))
        .otherwise(_joined(column, ";\t"))
    )


def source1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply-chain rows as a CSV would give them."""
    return keyed_source1(spark, sf_dir).select(
        "corporate_name_S1",
        "address",
        _delimited("activity_places").alias("activity_places"),
        _delimited("top_suppliers").alias("top_suppliers"),
    )


def _number_text(column: str, shift: int) -> Column:
    """A decimal as text, in good and bad notations."""
    kind, text = (F.col("ck") + shift) % 8, F.col(column).cast("decimal(38,4)").cast("string")
    return (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(kind == 2, F.concat(text, F.lit("E-3")))
        .when(kind == 3, F.concat(F.lit("+"), text))
        .when(kind == 4, F.lit("nan"))
        .when(kind == 5, F.lit(None))
        .when(kind == 6, F.concat(text, F.lit("d")))
        .otherwise(F.replace(text, F.lit("."), F.lit(",")))
    )


def source2_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financial rows with free-form customer text and money as text."""
    ck, brands = F.col("ck"), "main_customers"
    customers = (
        F.when(ck % 8 == 0, _joined(brands, "; "))
        .when(ck % 8 == 1, _joined(brands, ", "))
        .when(ck % 8 == 2, _joined(brands, "|"))
        .when(ck % 8 == 3, F.concat(F.lit("['"), _joined(brands, "' '"), F.lit("']")))
        .when(ck % 8 == 4, F.concat(F.lit('["'), _joined(brands, '", "'), F.lit('"]')))
        .when(ck % 8 == 5, _joined(brands, "  "))
        .when(ck % 8 == 6, _joined(brands, "\n"))
        .otherwise(F.lit(None))
    )
    return keyed_source2(spark, sf_dir).select(
        "corporate_name_S2",
        customers.alias("main_customers"),
        _number_text("net", 0).alias("revenue"),
        _number_text("discount", 3).alias("profit"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_registry(source1(spark, sf_dir), source2(spark, sf_dir), DATE)


# --- the same in SQL ---------------------------------------------------------------------------

_SCALE = "CASE CAST(ck%4 AS INT) WHEN 0 THEN 1000 WHEN 1 THEN 5000 WHEN 2 THEN 30000 ELSE 300 END"


def _sql_decorated(name: str, ck: str) -> str:
    return (
        f"CASE CAST({ck}%4 AS INT) WHEN 0 THEN concat('  ', {name}, ' ') WHEN 1 THEN upper({name}) "
        f"WHEN 2 THEN replace({name}, '#', ' # ') ELSE lower({name}) END"
    )


_SQL_TRADE = """li AS (
  SELECT o_custkey AS ck, s_name, p_type, p_brand,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS ext, CAST(l_discount AS DECIMAL(4,2)) AS disc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

_SQL_SOURCE1 = f"""sup AS (SELECT ck, s_name AS nm, ROW_NUMBER() OVER (PARTITION BY ck ORDER BY SUM(ext) DESC, s_name) AS rn
          FROM li GROUP BY ck, s_name),
act AS (SELECT DISTINCT ck, p_type AS nm FROM li),
supa AS (SELECT ck, list(nm ORDER BY rn) AS top_suppliers FROM sup WHERE rn <= 3 + ck%6 GROUP BY ck),
acta AS (SELECT ck, list(nm ORDER BY nm) AS activity_places FROM act GROUP BY ck),
named1 AS (SELECT c_custkey AS ck, CASE WHEN c_custkey%10 = 9 THEN concat(c_name, ' Holdings') ELSE c_name END AS nm,
                  c_nationkey FROM customer),
src1 AS (
  SELECT named1.ck, {_sql_decorated('nm', 'named1.ck')} AS corporate_name_S1,
         concat(' ', n_name, ',   ', r_name, '  ') AS address, activity_places, top_suppliers
  FROM named1 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN acta ON acta.ck = named1.ck JOIN supa ON supa.ck = named1.ck)"""

_SQL_SOURCE2 = f"""fin AS (SELECT ck, SUM(ext*(1-disc)) AS net, SUM(ext*disc) AS discount FROM li GROUP BY ck),
br AS (SELECT ck, p_brand AS nm, ROW_NUMBER() OVER (PARTITION BY ck ORDER BY SUM(ext) DESC, p_brand) AS rn
       FROM li GROUP BY ck, p_brand),
bra AS (SELECT ck, list(nm ORDER BY rn) AS main_customers FROM br WHERE rn <= 2 + ck%5 GROUP BY ck),
src2 AS (
  SELECT fin.ck, CASE WHEN c_custkey%10 = 8 THEN concat(c_name, ' Trading') ELSE c_name END AS corporate_name_S2,
         main_customers, CAST(net AS DOUBLE) / CAST({_SCALE.replace('ck', 'fin.ck')} AS DOUBLE) AS revenue,
         CAST(discount AS DOUBLE) / CAST({_SCALE.replace('ck', 'fin.ck')} AS DOUBLE) AS profit, net, discount
  FROM customer JOIN fin ON fin.ck = c_custkey JOIN bra ON bra.ck = c_custkey)"""


def _sql_delimited(column: str) -> str:
    def join(separator: str) -> str:
        return f"array_to_string({column}, '{separator}')"

    return (
        f"CASE CAST(ck%6 AS INT) WHEN 0 THEN {join('; ')} WHEN 1 THEN concat(' ', {join(' ; ')}, ' ;') "
        f"WHEN 2 THEN NULL WHEN 3 THEN {join(';;')} WHEN 4 THEN '   ' ELSE {join(f';{chr(9)}')} END"
    )


def _sql_number_text(column: str, shift: int) -> str:
    text = f"CAST(CAST({column} AS DECIMAL(38,4)) AS VARCHAR)"
    return (
        f"CASE CAST((ck+{shift})%8 AS INT) WHEN 0 THEN {text} WHEN 1 THEN concat(' ', {text}, ' ') "
        f"WHEN 2 THEN concat({text}, 'E-3') WHEN 3 THEN concat('+', {text}) WHEN 4 THEN 'nan' WHEN 5 THEN NULL "
        f"WHEN 6 THEN concat({text}, 'd') ELSE replace({text}, '.', ',') END"
    )


_SQL_SOURCE1_TEXT = f"""src1_text AS (
  SELECT corporate_name_S1, address, {_sql_delimited('activity_places')} AS activity_places,
         {_sql_delimited('top_suppliers')} AS top_suppliers FROM src1)"""

_SQL_SOURCE2_TEXT = f"""src2_text AS (
  SELECT corporate_name_S2,
         CASE CAST(ck%8 AS INT) WHEN 0 THEN array_to_string(main_customers, '; ')
              WHEN 1 THEN array_to_string(main_customers, ', ') WHEN 2 THEN array_to_string(main_customers, '|')
              WHEN 3 THEN concat('[''', array_to_string(main_customers, ''' '''), ''']')
              WHEN 4 THEN concat('["', array_to_string(main_customers, '", "'), '"]')
              WHEN 5 THEN array_to_string(main_customers, '  ')
              WHEN 6 THEN array_to_string(main_customers, chr(10)) ELSE NULL END AS main_customers,
         {_sql_number_text('net', 0)} AS revenue, {_sql_number_text('discount', 3)} AS profit FROM src2)"""

_SQL_CLEAN1 = f"""clean1 AS (
  SELECT *, {duck.list_array('activity_places')} AS activity_places_clean,
         {duck.list_array('top_suppliers')} AS top_suppliers_clean,
         {duck.name_clean('corporate_name_S1')} AS corporate_name_clean, {duck.squeeze('address')} AS address_clean
  FROM src1)"""

_SQL_CLEAN2 = f"""clean2 AS (
  SELECT corporate_name_S2, main_customers, {duck.customers_array('main_customers')} AS main_customers_clean,
         {duck.name_clean('corporate_name_S2')} AS corporate_name_clean, revenue, profit,
         {duck.margin('revenue', 'profit')} AS profit_margin, {duck.category('revenue')} AS revenue_category
  FROM src2)"""

_SQL_RESOLVED = f"""resolved AS (
  SELECT {duck.corporate_id('k1.name_key', 'k1.address_key')} AS corporate_id, k1.*, k2.* EXCLUDE (name_key)
  FROM (SELECT * EXCLUDE (corporate_name_clean), corporate_name_clean AS corporate_name_clean_s1,
               {duck.key('corporate_name_clean')} AS name_key, {duck.key('address_clean')} AS address_key FROM clean1) k1
  JOIN (SELECT * EXCLUDE (corporate_name_clean), corporate_name_clean AS corporate_name_clean_s2,
               {duck.key('corporate_name_clean')} AS name_key FROM clean2) k2 ON k1.name_key = k2.name_key)"""

_SQL_REGISTRY = f"""texts AS (
  SELECT corporate_id, {duck.null_tokens('coalesce(corporate_name_S1, corporate_name_S2)')} AS corporate_name,
         {duck.null_tokens('address')} AS address, {duck.join_array('activity_places_clean')} AS activity_places,
         {duck.join_array('top_suppliers_clean')} AS top_suppliers,
         {duck.join_array('main_customers_clean')} AS main_customers,
         coalesce(revenue, 0.0) AS revenue, coalesce(profit, 0.0) AS profit,
         coalesce(profit_margin, 0.0) AS profit_margin, {duck.null_tokens('revenue_category')} AS revenue_category
  FROM resolved),
registry AS (
  SELECT *, {duck.count_items('activity_places')} AS num_activity_places,
         {duck.count_items('top_suppliers')} AS num_suppliers, {duck.count_items('main_customers')} AS num_customers,
         '{DATE}' AS processed_date, 'harmonized' AS source FROM texts)"""

def _sql_renamed(column: str, null: int, marks: int, twin: int, back: int) -> str:
    return (
        f"CASE CAST(ck%200 AS INT) WHEN {null} THEN NULL WHEN {marks} THEN ' -.* ' "
        f"WHEN {twin} THEN concat('Customer#', lpad(CAST(ck-{back} AS VARCHAR), 9, '0')) ELSE {column} END"
    )


def _hard(sql: str) -> str:
    """The same view over the sources with the hard names."""
    return re.sub(r"\b(src1|src2|clean1|clean2|resolved|texts|registry)\b", r"hard_\1", sql)


_SQL_HARD1 = f"hard_src1 AS (SELECT * REPLACE ({_sql_renamed('corporate_name_S1', 7, 17, 27, 1)} AS corporate_name_S1) FROM src1)"
_SQL_HARD2 = f"hard_src2 AS (SELECT * REPLACE ({_sql_renamed('corporate_name_S2', 57, 67, 28, 2)} AS corporate_name_S2) FROM src2)"

_SQL_FEATURES = """features AS (
  SELECT corporate_id, corporate_name, revenue, profit, profit_margin, num_suppliers, num_customers,
         num_activity_places, revenue_category, CASE WHEN profit >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high_profit,
         profit_margin / 100.0::DOUBLE AS profit_margin_normalized FROM registry)"""

_CTES = {
    "li": _SQL_TRADE,
    "src1": _SQL_SOURCE1,
    "src2": _SQL_SOURCE2,
    "src1_text": _SQL_SOURCE1_TEXT,
    "src2_text": _SQL_SOURCE2_TEXT,
    "clean1": _SQL_CLEAN1,
    "clean2": _SQL_CLEAN2,
    "resolved": _SQL_RESOLVED,
    "registry": _SQL_REGISTRY,
    "features": _SQL_FEATURES,
    "hard_src1": _SQL_HARD1,
    "hard_src2": _SQL_HARD2,
    "hard_clean1": _hard(_SQL_CLEAN1),
    "hard_clean2": _hard(_SQL_CLEAN2),
    "hard_resolved": _hard(_SQL_RESOLVED),
    "hard_registry": _hard(_SQL_REGISTRY),
}
_NEEDS = {
    "src1": ["li"],
    "src2": ["li"],
    "src1_text": ["src1"],
    "src2_text": ["src2"],
    "clean1": ["src1"],
    "clean2": ["src2"],
    "resolved": ["clean1", "clean2"],
    "registry": ["resolved"],
    "features": ["registry"],
    "hard_src1": ["src1"],
    "hard_src2": ["src2"],
    "hard_clean1": ["hard_src1"],
    "hard_clean2": ["hard_src2"],
    "hard_resolved": ["hard_clean1", "hard_clean2"],
    "hard_registry": ["hard_resolved"],
}


def with_views(select: str, *views: str) -> str:
    """A statement that defines the named views, and those they need, before the select."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        for other in _NEEDS.get(name, []):
            visit(other)
        needed.add(name)

    for view in views:
        visit(view)
    return "WITH " + ",\n".join(_CTES[name] for name in _CTES if name in needed) + "\n" + select
