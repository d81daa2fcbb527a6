"""Every query against its SQL in DuckDB, as the driver does it, at the smallest scale."""

import os
import sys

import pytest

from tests.support import ROOT, SF_DIR

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_point  # noqa: E402
from check import differences, duck  # noqa: E402

QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    found = (df.columns, [tuple(r) for r in df.collect()])
    assert found[1]
    if name in ORACLE:
        cursor = con.execute(ORACLE[name])
        expected = ([d[0] for d in cursor.description], cursor.fetchall())
        assert differences(found, expected) in ("", "(close, not exact)")


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
