"""Single-value rules: hand-written expectations, then random text against a few lines of Python."""

import hashlib
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions import lists, numbers, text

STRING, ARRAY = T.StringType(), T.ArrayType(T.StringType())


def test_whitespace_is_what_python_strips():
    every = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(text.WHITESPACE) == every


def test_whitespace_class_matches_the_same_characters(column):
    points = [chr(i) for i in range(1, 0x3100)]
    found = column(lambda v: v.rlike(f"{text.UNICODE}[{text.WS}]"), points)
    assert {c for c, hit in zip(points, found) if hit} == set(text.WHITESPACE)


def test_name_clean(column):
    assert column(text.name_clean, [None, "", " a ", "\t\x1cA b　\n"]) == ["", "", "a", "A b"]


def test_address_clean(column):
    assert column(text.address_clean, [None, "  1  Main\n\tSt ", "a  b"]) == ["", "1 Main St", "a b"]


def test_match_key(column):
    values = [None, "A.C. Me, É 12", "İstanbul", "Kelvin", "  "]
    assert column(text.match_key, values) == ["", "acme12", "istanbul", "kelvin", ""]


def test_corporate_id(column):
    expected = hashlib.sha256(b"acme_1mainst").hexdigest()[:16]
    assert expected == "719525f3c64e9b43"
    assert column(lambda v: text.corporate_id(v, F.lit("1mainst")), ["acme"]) == [expected]


def test_null_tokens(column):
    values = ["nan", " null ", "none", "  ", None, "None", "NULL", "nanx", " a "]
    assert column(text.null_tokens, values) == [None] * 5 + ["None", "NULL", "nanx", "a"]


def test_list_clean_array(column):
    values = [[" a ", ""], None, ["x", None]]
    assert column(lists.list_clean_array, values, "array<string>") == [["a", ""], [], ["x", "None"]]


def test_list_clean_delim(column):
    assert column(lists.list_clean_delim, ["a; b ;;c", None, " ; "]) == [["a", "b", "c"], [], []]


def test_list_clean_scalar(column):
    assert column(lists.list_clean_scalar, [3, None], "int") == [["3"], []]


CUSTOMER_TEXTS = {
    "['A' 'B']": ["A", "B"],
    '["A" "B"]': ["A", "B"],
    "a;b, c|d": ["a", "b", "c", "d"],
    "x  y z": ["x", "y z"],
    "x y z": ["x", "y", "z"],
    "[a]": ["[a]"],
    "": [],
    "  ": [],
    "a\nb": ["a", "b"],
    "['']": [],
    "[' ' 'b']": ["b"],
    "a\tb c": ["a\tb", "c"],
}


def test_customers_string(column):
    assert column(lists.customers_string, [*CUSTOMER_TEXTS, None]) == [*CUSTOMER_TEXTS.values(), []]


def test_customers_array(column):
    values = [[" A ", None, "", "['B', 'C']"], None, ["[x]"], []]
    assert column(lists.customers_array, values, "array<string>") == [["A", "B", "C"], [], ["[x]"], []]


def test_list_join(column):
    arrays = [["a", "NaN", "None", " b "], [], None, [None, " "]]
    assert column(lambda v: lists.list_join(v, ARRAY), arrays, "array<string>") == ["a; b", None, None, None]
    texts = ["NULL", "['A' 'B']", " a ", None, "[' ']"]
    assert column(lambda v: lists.list_join(v, STRING), texts) == [None, "A; B", "a", None, None]


COUNTED = {None: 0, "None": 0, "a": 1, "a; ;b;": 2, ";": 0, "": 0, "nan; b": 2, "NULL": 0}


def test_list_count(column):
    values = [*COUNTED, " ", " nan "]
    assert column(lists.list_count, values) == [*COUNTED.values(), 0, 0]
    assert column(lists.list_count_unstripped, values) == [*COUNTED.values(), 1, 1]


def test_parse_list_column_names_the_count(spark):
    df = spark.createDataFrame([("a; b",), (None,)], "items string")
    assert [r.items_count for r in lists.parse_list_column(df, "items").collect()] == [2, 0]


NUMBERS = {
    "12": 12.0, " 12 ": 12.0, "1e3": 1000.0, "-5": -5.0, ".5": 0.5, "1.": 1.0, "+5": 5.0, "1E5": 1e5,
    "1,000": 0.0, "1_000": 0.0, "1d": 0.0, "1f": 0.0, "nan": 0.0, "abc": 0.0, "True": 0.0, "": 0.0, None: 0.0,
    "0x10": 0.0, "1e": 0.0, ".": 0.0, "1 2": 0.0, "1e400": 0.0, " 12": 0.0, "- 5": 0.0,
    "inf": math.inf, "-Infinity": -math.inf, " inf": 0.0,
}


def test_to_number(column):
    assert column(lambda v: numbers.to_number(v, STRING), list(NUMBERS)) == list(NUMBERS.values())


def test_to_number_of_numbers(column):
    values = [1.5, None, math.nan, math.inf]
    assert column(lambda v: numbers.to_number(v, T.DoubleType()), values, "double") == [1.5, 0.0, 0.0, math.inf]


def test_profit_margin(spark):
    rows = [(200.0, 20.0), (0.0, 5.0), (-1.0, 5.0), (None, 5.0), (5.0, None), (math.nan, 1.0), (5.0, math.nan)]
    df = spark.createDataFrame(rows, "r double, p double")
    assert [r[0] for r in df.select(numbers.profit_margin(df.r, df.p)).collect()] == [10.0] + [0.0] * 6


def test_revenue_category(column):
    values = [99.99, 100.0, 999.99, 1000.0, 4999.99, 5000.0, None, math.nan, -1.0]
    names = ["Small", "Medium", "Medium", "Large", "Large", "Enterprise", "Unknown", "Unknown", "Small"]
    assert column(numbers.revenue_category, values, "double") == names


def test_high_profit(column):
    assert column(numbers.high_profit, [100.0, 99.99, None], "double") == [1.0, 0.0, 0.0]


def test_revenue_log(column):
    assert column(numbers.revenue_log, [0.0, math.e - 1, -1.0, -2.0], "double") == [0.0, 1.0, None, None]


def test_supplier_customer_ratio(spark):
    df = spark.createDataFrame([(6, 4), (3, 0), (3, None)], "s int, c int")
    assert [r[0] for r in df.select(numbers.supplier_customer_ratio(df.s, df.c)).collect()] == [1.5, 0.0, 0.0]


def test_margin_normalized(column):
    assert column(numbers.margin_normalized, [50.0, None], "double") == [0.5, 0.0]


def test_load_date(spark):
    row = spark.range(1).select(numbers.load_date("2026-01-15").alias("a"), numbers.load_date().alias("b")).first()
    assert row.a == "2026-01-15" and re.fullmatch(r"\d{4}-\d\d-\d\d", row.b)


# --- random text -------------------------------------------------------------------------------

TEXTS = st.lists(st.text(alphabet="aB1 ;,|[]'\"\n\t nul", max_size=14), min_size=60, max_size=60)
BATCHES = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def quoted(s):
    found = re.findall("'([^']+)'", s) or re.findall('"([^"]+)"', s)
    return [t.strip() for t in found if t.strip()]


def is_list_text(s):
    return s[:1] == "[" and s[-1:] == "]" and any(q in s for q in "'\"")


def tokens(value):
    s = value.strip()
    if is_list_text(s):
        return quoted(s)
    s = s.replace("\n", " ")
    for pattern in ("[;,|]", r"\s{2,}", " "):
        parts = re.split(pattern, s)
        if len(parts) > 1:
            break
    return [p.strip() for p in parts if p.strip()]


@BATCHES
@given(TEXTS)
def test_customers_string_random(column, values):
    assert column(lists.customers_string, values) == [tokens(v) for v in values]


def joined(value):
    s = value.strip()
    if s.lower() in ("", "nan", "none", "null"):
        return None
    if is_list_text(s):
        return "; ".join(quoted(s)) or None
    return s


@BATCHES
@given(TEXTS)
def test_list_join_random(column, values):
    assert column(lambda v: lists.list_join(v, STRING), values) == [joined(v) for v in values]


def pieces(value):
    return len([p for p in value.split(";") if p.strip()])


@BATCHES
@given(TEXTS)
def test_list_count_random(column, values):
    expected = [0 if v.strip().lower() in ("nan", "none", "null") else pieces(v) for v in values]
    assert column(lists.list_count, values) == expected


@BATCHES
@given(TEXTS)
def test_list_clean_delim_random(column, values):
    assert column(lists.list_clean_delim, values) == [[p.strip() for p in v.split(";") if p.strip()] for v in values]


@BATCHES
@given(st.lists(st.text(max_size=12).filter(lambda s: "\x00" not in s), min_size=40, max_size=40))
def test_address_clean_random(column, values):
    assert column(text.address_clean, values) == [" ".join(v.split()) for v in values]


@BATCHES
@given(st.lists(st.text(max_size=12).filter(lambda s: "\x00" not in s), min_size=40, max_size=40))
def test_match_key_random(column, values):
    assert column(text.match_key, values) == [re.sub("[^a-z0-9]", "", v.lower()) for v in values]


@BATCHES
@given(st.lists(st.text(alphabet="0123456789.eE+-_ dfxina", max_size=8), min_size=60, max_size=60))
def test_to_number_random(column, values):
    pd = pytest.importorskip("pandas")
    # The leading text keeps the column from being all numbers, which pandas reads another way.
    expected = pd.to_numeric(pd.Series(["x", *values], dtype=object), errors="coerce").fillna(0.0).tolist()[1:]
    assert column(lambda v: numbers.to_number(v, STRING), values) == pytest.approx(expected, rel=1e-14)
