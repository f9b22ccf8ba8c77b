"""Every registered query runs on the smallest tables and agrees with its SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import TABLES, rows_of  # noqa: E402
from tidemark.suite import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    if name in ORACLES:
        assert rows_of(got) == rows_of(duck.sql(ORACLES[name]).to_arrow_table())
    else:
        assert got.num_rows > 0
