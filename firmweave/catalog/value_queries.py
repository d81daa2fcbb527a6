"""Queries over single values: text, lists and numbers.

Inputs are whole tables; a row's key picks the shape its value is written in, so that every rule
meets every shape at any scale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.catalog import duck
from firmweave.catalog.fixtures import DATE, customers_with_place, decorated_name, hundredths, raw_address, table
from firmweave.catalog.query import QuerySet
from firmweave.functions import lists, numbers, text

QUERIES = QuerySet()

_SHOW = " ~ "


def shown(items: Column) -> Column:
    return F.array_join(items, _SHOW)


def _case(key: Column, shapes: list[Column], otherwise: Column) -> Column:
    """The shape whose position is the key's remainder."""
    pick = F.when(key % (len(shapes) + 1) == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], start=1):
        pick = pick.when(key % (len(shapes) + 1) == i, shape)
    return pick.otherwise(otherwise)


def _sql_case(key: str, shapes: list[str], otherwise: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {shape}" for i, shape in enumerate(shapes))
    return f"CASE CAST({key} % {len(shapes) + 1} AS INT) {whens} ELSE {otherwise} END"


# --- text --------------------------------------------------------------------------------------

_SQL_PADDED = _sql_case(
    "c_custkey",
    ["concat('  ', c_name, ' ')", "concat(chr(9), c_name, chr(10))", "NULL", "concat(chr(160), c_name, chr(12288))"],
    "c_name",
)


def _v() -> Column:
    """The rewritten value, a column of its own before the function under check sees it."""
    return F.col("v")


def _customers(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").select("c_custkey", value.alias("v"))


@QUERIES.add("name_clean", f"SELECT c_custkey, {duck.name_clean('v')} AS name_clean "
                           f"FROM (SELECT c_custkey, {_SQL_PADDED} AS v FROM customer)")
def name_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    padded = [
        F.concat(F.lit("  "), name, F.lit(" ")),
        F.concat(F.lit("\t"), name, F.lit("\n")),
        F.lit(None),
        F.concat(F.lit("\u00a0"), name, F.lit("\u3000")),
    ]
    value = _case(F.col("c_custkey"), padded, name)
    return _customers(spark, sf_dir, value).select("c_custkey", text.name_clean(_v()).alias("name_clean"))


_SQL_PLACES = """SELECT c_custkey, concat(' ', n_name, ',   ', r_name, '  ') AS address, c_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@QUERIES.add("address_clean", f"SELECT c_custkey, {duck.squeeze('v')} AS address_clean FROM (SELECT c_custkey, "
                              f"concat(address, chr(9), chr(10), ' ', c_name) AS v FROM ({_SQL_PLACES}))")
def address_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat(raw_address(), F.lit("\t\n "), F.col("c_name"))
    return customers_with_place(spark, sf_dir).select(
        F.col("ck").alias("c_custkey"), text.address_clean(value).alias("address_clean")
    )


_SQL_DECORATED = _sql_case(
    "c_custkey", ["concat('  ', c_name, ' ')", "upper(c_name)", "replace(c_name, '#', ' # ')"], "lower(c_name)"
)


@QUERIES.add("name_key", f"SELECT c_custkey, {duck.key('v')} AS name_key "
                         f"FROM (SELECT c_custkey, {_SQL_DECORATED} AS v FROM customer)")
def name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = decorated_name(F.col("c_custkey"), F.col("c_name"))
    return _customers(spark, sf_dir, value).select("c_custkey", text.match_key(_v()).alias("name_key"))


@QUERIES.add("address_key", f"SELECT c_custkey, {duck.key(duck.squeeze('address'))} AS address_key "
                            f"FROM ({_SQL_PLACES})")
def address_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_with_place(spark, sf_dir).select(
        F.col("ck").alias("c_custkey"),
        text.match_key(text.address_clean(raw_address())).alias("address_key"),
    )


@QUERIES.add("corporate_id", f"SELECT c_custkey, {duck.corporate_id(duck.key('c_name'), duck.key('address'))} "
                             f"AS corporate_id FROM ({_SQL_PLACES})")
def corporate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = text.corporate_id(text.match_key(F.col("c_name")), text.match_key(text.address_clean(raw_address())))
    return customers_with_place(spark, sf_dir).select(
        F.col("ck").alias("c_custkey"), keyed.alias("corporate_id")
    )


_TOKEN_TEXTS = ["nan", " null ", "none", "  ", "None", "NULL"]
_SQL_TOKENS = _sql_case(
    "c_custkey", [f"'{t}'" for t in _TOKEN_TEXTS] + ["NULL", "concat('nan', c_name)"], "concat(' ', c_name, '  ')"
)


@QUERIES.add("null_tokens", f"SELECT c_custkey, {duck.null_tokens('v')} AS scrubbed "
                            f"FROM (SELECT c_custkey, {_SQL_TOKENS} AS v FROM customer)")
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    shapes = [F.lit(t) for t in _TOKEN_TEXTS] + [F.lit(None), F.concat(F.lit("nan"), name)]
    value = _case(F.col("c_custkey"), shapes, F.concat(F.lit(" "), name, F.lit("  ")))
    return _customers(spark, sf_dir, value).select("c_custkey", text.null_tokens(_v()).alias("scrubbed"))


# --- lists -------------------------------------------------------------------------------------

def _parts(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return parts.select("p_partkey", value.alias("v"))


def _listed(df: DataFrame, key: str, items: Column) -> DataFrame:
    """The cleaned list as text, and its size."""
    return df.select(key, items.alias("c")).select(key, shown(F.col("c")).alias("items"), F.size("c").alias("n"))


def _padded(column: str) -> Column:
    return F.concat(F.lit("  "), F.col(column), F.lit("\t"))


def _items() -> Column:
    key = F.col("p_partkey")
    return F.when(
        key % 11 != 0,
        F.array(
            _padded("p_name"),
            F.col("p_brand"),
            F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, F.lit(" ")).otherwise(F.col("p_type")),
            F.when(key % 7 == 0, F.lit(" NaN")).when(key % 7 == 1, F.lit("None ")).otherwise(F.col("p_brand")),
        ),
    )


_SQL_ITEMS = """CASE WHEN p_partkey%11 <> 0 THEN [concat('  ', p_name, chr(9)), p_brand,
  CASE p_partkey%5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE p_type END,
  CASE p_partkey%7 WHEN 0 THEN ' NaN' WHEN 1 THEN 'None ' ELSE p_brand END] END"""


@QUERIES.add("list_clean_array", f"SELECT p_partkey, {duck.shown('c')} AS items, CAST(len(c) AS INTEGER) AS n "
                                 f"FROM (SELECT p_partkey, {duck.list_array('v')} AS c "
                                 f"FROM (SELECT p_partkey, {_SQL_ITEMS} AS v FROM part))")
def list_clean_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_parts(spark, sf_dir, _items()), "p_partkey", lists.list_clean_array(_v()))


def _piece(separator: str) -> Column:
    return F.concat_ws(separator, "p_name", "p_brand", "p_type")


def _delimited() -> Column:
    key = F.col("p_partkey")
    return _case(
        key,
        [
            F.concat(F.lit(" "), _piece("; "), F.lit(" ;")),
            _piece(";;"),
            F.lit(None),
            F.lit(" ; ;"),
            F.concat(_piece("\t;\n"), F.lit("; nan")),
            F.lit("  "),
            F.lit(" None"),
            F.concat(F.lit("['"), _piece("' '"), F.lit("']")),
        ],
        F.col("p_name"),
    )


_SQL_DELIMITED = _sql_case(
    "p_partkey",
    [
        "concat(' ', concat_ws('; ', p_name, p_brand, p_type), ' ;')",
        "concat_ws(';;', p_name, p_brand, p_type)",
        "NULL",
        "' ; ;'",
        "concat(concat_ws(chr(9) || ';' || chr(10), p_name, p_brand, p_type), '; nan')",
        "'  '",
        "' None'",
        "concat('[''', concat_ws(''' ''', p_name, p_brand, p_type), ''']')",
    ],
    "p_name",
)
_SQL_DELIMITED_PARTS = f"(SELECT p_partkey, {_SQL_DELIMITED} AS v FROM part)"


@QUERIES.add("list_clean_delim", f"SELECT p_partkey, {duck.shown('c')} AS items, CAST(len(c) AS INTEGER) AS n "
                                 f"FROM (SELECT p_partkey, {duck.list_delim('v')} AS c FROM {_SQL_DELIMITED_PARTS})")
def list_clean_delim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_parts(spark, sf_dir, _delimited()), "p_partkey", lists.list_clean_delim(_v()))


@QUERIES.add("list_clean_scalar", """SELECT p_partkey, coalesce(CAST(v AS VARCHAR), '') AS items,
  CAST(v IS NOT NULL AS INTEGER) AS n FROM (SELECT p_partkey, CASE WHEN p_partkey%11 <> 0 THEN p_size END AS v FROM part)""")
def list_clean_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size"))
    return _listed(_parts(spark, sf_dir, value), "p_partkey", lists.list_clean_scalar(_v()))


def _customer_items() -> Column:
    key = F.col("p_partkey")
    return F.when(
        key % 11 != 0,
        F.array(
            _padded("p_name"),
            F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, F.lit(" ")).otherwise(F.col("p_type")),
            F.when(key % 3 == 0, F.concat(F.lit(" ['"), F.col("p_brand"), F.lit("', ' "), F.col("p_type"), F.lit(" ']")))
            .when(key % 3 == 1, F.concat(F.lit('["'), F.col("p_brand"), F.lit('" "'), F.col("p_name"), F.lit('"]')))
            .otherwise(F.concat(F.lit("["), F.col("p_brand"), F.lit("]"))),
        ),
    )


_SQL_CUSTOMER_ITEMS = """CASE WHEN p_partkey%11 <> 0 THEN [concat('  ', p_name, chr(9)),
  CASE p_partkey%5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE p_type END,
  CASE p_partkey%3 WHEN 0 THEN concat(' [''', p_brand, ''', '' ', p_type, ' '']')
                   WHEN 1 THEN concat('["', p_brand, '" "', p_name, '"]') ELSE concat('[', p_brand, ']') END] END"""


@QUERIES.add("customers_array", f"SELECT p_partkey, {duck.shown('c')} AS items, CAST(len(c) AS INTEGER) AS n "
                                f"FROM (SELECT p_partkey, {duck.customers_array('v')} AS c "
                                f"FROM (SELECT p_partkey, {_SQL_CUSTOMER_ITEMS} AS v FROM part))")
def customers_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_parts(spark, sf_dir, _customer_items()), "p_partkey", lists.customers_array(_v()))


def _free_text() -> Column:
    """Whole document texts, as they are and rewritten with other separators."""
    key, text_column = F.col("doc_id"), F.col("text")
    bare = F.translate(text_column, "'\"", "")
    return _case(
        key,
        [
            F.replace(text_column, F.lit(" "), F.lit("; ")),
            F.translate(text_column, ",;|\n", "    "),
            F.concat(F.lit("['"), F.replace(bare, F.lit(" "), F.lit("' '")), F.lit("'] ")),
            F.concat(F.lit(' ["'), F.replace(bare, F.lit(" "), F.lit('", "')), F.lit('"]')),
            F.translate(text_column, " ,;|\n", "_"),
            F.lit(None),
            F.replace(F.translate(text_column, ",;|\n", ""), F.lit(" "), F.lit("  ")),
            F.replace(text_column, F.lit(" "), F.lit("|")),
        ],
        text_column,
    )


_SQL_BARE = """translate(text, '''"', '')"""
_SQL_FREE_TEXT = _sql_case(
    "doc_id",
    [
        "replace(text, ' ', '; ')",
        "translate(text, ',;|' || chr(10), '    ')",
        f"concat('[''', replace({_SQL_BARE}, ' ', ''' '''), '''] ')",
        f"""concat(' ["', replace({_SQL_BARE}, ' ', '", "'), '"]')""",
        "translate(text, ' ,;|' || chr(10), '_')",
        "NULL",
        "replace(translate(text, ',;|' || chr(10), ''), ' ', '  ')",
        "replace(text, ' ', '|')",
    ],
    "text",
)


@QUERIES.add("customers_string", f"SELECT doc_id, {duck.shown('c')} AS items, CAST(len(c) AS INTEGER) AS n "
                                 f"FROM (SELECT doc_id, {duck.customers_string('v')} AS c "
                                 f"FROM (SELECT doc_id, {_SQL_FREE_TEXT} AS v FROM documents))")
def customers_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", _free_text().alias("v"))
    return _listed(texts, "doc_id", lists.customers_string(_v()))


@QUERIES.add("list_join", f"SELECT p_partkey, {duck.join_array('a')} AS from_list, {duck.join_text('v')} AS from_text "
                          f"FROM (SELECT p_partkey, {_SQL_ITEMS} AS a, {_SQL_DELIMITED} AS v FROM part)")
def list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.struct(_items().alias("items"), _delimited().alias("text"))
    return _parts(spark, sf_dir, both).select(
        "p_partkey",
        lists.list_join(F.col("v.items"), T.ArrayType(T.StringType())).alias("from_list"),
        lists.list_join(F.col("v.text"), T.StringType()).alias("from_text"),
    )


@QUERIES.add("list_count", f"SELECT p_partkey, {duck.count_items('v')} AS n FROM {_SQL_DELIMITED_PARTS}")
def list_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, _delimited()).select("p_partkey", lists.list_count(_v()).alias("n"))


@QUERIES.add("parse_list_column", f"SELECT p_partkey, {duck.count_items_unstripped('v')} AS items_count "
                                  f"FROM {_SQL_DELIMITED_PARTS}")
def parse_list_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir, _delimited()).withColumnRenamed("v", "items")
    return lists.parse_list_column(parts, "items").drop("items")


# --- numbers -----------------------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return orders.select("o_orderkey", "o_totalprice", value.alias("v"))


_BAD_NUMBERS = ["nan", "1d", "1_000", "1e400", "True", "", "0x1p3", "1 2"]
_SQL_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_SQL_NUMBER_TEXT = _sql_case(
    "o_orderkey",
    [
        f"concat('  ', {_SQL_PRICE}, chr(9))",
        f"concat({_SQL_PRICE}, 'e-2')",
        f"concat('-', {_SQL_PRICE})",
        f"concat('+', {_SQL_PRICE}, 'E1')",
        f"replace({_SQL_PRICE}, '.', ',')",
        "NULL",
        "'-Infinity'",
        *[f"'{bad}'" for bad in _BAD_NUMBERS],
    ],
    _SQL_PRICE,
)


@QUERIES.add("to_number", f"SELECT o_orderkey, {duck.to_number('v')} AS number "
                          f"FROM (SELECT o_orderkey, {_SQL_NUMBER_TEXT} AS v FROM orders)")
def to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = (hundredths("o_totalprice").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").cast("string")
    shapes = [
        F.concat(F.lit("  "), price, F.lit("\t")),
        F.concat(price, F.lit("e-2")),
        F.concat(F.lit("-"), price),
        F.concat(F.lit("+"), price, F.lit("E1")),
        F.replace(price, F.lit("."), F.lit(",")),
        F.lit(None),
        F.lit("-Infinity"),
        *[F.lit(bad) for bad in _BAD_NUMBERS],
    ]
    value = _case(F.col("o_orderkey"), shapes, price)
    return _orders(spark, sf_dir, value).select("o_orderkey", numbers.to_number(_v(), T.StringType()).alias("number"))


def _revenue() -> Column:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return _case(key, [F.lit(0.0), -price, F.lit(None).cast("double"), price / 100, price / 1000], price / 10000)


_SQL_REVENUE = _sql_case(
    "o_orderkey",
    ["0.0::DOUBLE", "-o_totalprice", "NULL::DOUBLE", "o_totalprice / 100::DOUBLE", "o_totalprice / 1000::DOUBLE"],
    "o_totalprice / 10000::DOUBLE",
)
_SQL_REVENUES = f"(SELECT o_orderkey, o_totalprice, {_SQL_REVENUE} AS r FROM orders)"


@QUERIES.add("profit_margin", f"SELECT o_orderkey, {duck.margin('r', 'p')} AS profit_margin FROM (SELECT *, "
                              f"CASE WHEN o_orderkey%13 <> 0 THEN o_totalprice / 7::DOUBLE END AS p FROM {_SQL_REVENUES})")
def profit_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    profit = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_totalprice") / 7)
    return _orders(spark, sf_dir, _revenue()).select(
        "o_orderkey", numbers.profit_margin(_v(), profit).alias("profit_margin")
    )


@QUERIES.add("revenue_category", f"SELECT o_orderkey, {duck.category('r')} AS revenue_category FROM {_SQL_REVENUES}")
def revenue_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _revenue()).select(
        "o_orderkey", numbers.revenue_category(_v()).alias("revenue_category")
    )


@QUERIES.add("revenue_log", f"SELECT o_orderkey, CASE WHEN r > -1 THEN round(ln(r + 1), 6) END AS revenue_log "
                            f"FROM {_SQL_REVENUES}")
def revenue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _revenue()).select(
        "o_orderkey", F.round(numbers.revenue_log(_v()), 6).alias("revenue_log")
    )


@QUERIES.add("margin_norm", f"SELECT o_orderkey, coalesce(r / 100::DOUBLE, 0.0) AS profit_margin_normalized "
                            f"FROM {_SQL_REVENUES}")
def margin_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _revenue()).select(
        "o_orderkey", numbers.margin_normalized(_v()).alias("profit_margin_normalized")
    )


@QUERIES.add("sup_cust_ratio", """SELECT p_partkey, CASE WHEN c > 0 THEN s / c::DOUBLE ELSE 0.0 END AS ratio
FROM (SELECT p_partkey, p_size::DOUBLE AS s, CASE WHEN p_partkey%9 <> 0 THEN CAST(p_partkey%5 AS INTEGER) END AS c FROM part)""")
def sup_cust_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    customers = F.when(key % 9 != 0, (key % 5).cast("int"))
    counts = F.struct(F.col("p_size").alias("suppliers"), customers.alias("customers"))
    ratio = numbers.supplier_customer_ratio(F.col("v.suppliers"), F.col("v.customers"))
    return _parts(spark, sf_dir, counts).select("p_partkey", ratio.alias("ratio"))


@QUERIES.add("processed_date", f"SELECT c_custkey, '{DATE}' AS processed_date FROM customer")
def processed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, F.col("c_name")).select("c_custkey", numbers.load_date(DATE).alias("processed_date"))
