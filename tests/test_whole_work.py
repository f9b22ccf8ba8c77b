"""Queries that fit or chain stages take every row of their tables and let every stage count, on tables of our own."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import rows_of  # noqa: E402
from tidemark.operators import models  # noqa: E402
from tidemark.suite import ORACLES, QUERIES, learning, views  # noqa: E402


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    root, i = str(tmp_path_factory.mktemp("tables")), F.col("id")

    def one_of(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))

    made = {
        "customer": (20, {"c_custkey": i, "c_acctbal": i * 100.5, "c_mktsegment": one_of("MACHINERY", "BUILDING", "FURNITURE")}),
        "orders": (200, {"o_orderkey": i, "o_custkey": i % 20, "o_orderdate": F.lit("1997-01-05").cast("timestamp"), "o_orderpriority": one_of(*views.LOAN_NAMES)}),
        "lineitem": (600, {
            "l_orderkey": i % 200, "l_linenumber": F.floor(i / 200).cast("int") + 5, "l_partkey": i, "l_quantity": (i * 7 % 50 + 1).cast("double"),
            "l_extendedprice": i * 10.0, "l_tax": i % 5 / 100, "l_discount": i % 10 / 100, "l_returnflag": one_of("R", "A", "N"), "l_linestatus": one_of("F", "O"),
            "l_shipdate": F.when(F.floor(i / 2) % 2 == 0, "1997-07-15").otherwise("1997-08-15").cast("timestamp"),
        }),
        "events": (300, {"user_id": i % 25, "ts": F.lit("2024-01-05 10:00:00").cast("timestamp"), "value": i * 1.5, "props": F.format_string('{"k": %d}', i % 10)}),
    }
    for name, (n, columns) in made.items():
        spark.range(n).select(*[c.alias(k) for k, c in columns.items()]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


class Called(Exception):
    """Ends a query at the search that it calls."""


@pytest.fixture
def searched(monkeypatch):
    """(rows, settings) of the searches called; of fits that read a draw of the rows it has about ten."""
    calls = []

    def search(rows, *args, **settings):
        calls.append((rows.count(), settings))
        raise Called

    monkeypatch.setattr(learning, "FIT_ROWS", 10)
    for name in ("tune_boosted", "tune_multiclass"):
        monkeypatch.setattr(models, name, search)
    return calls


@pytest.mark.parametrize("name", ["m14_trials", "m14_tuned_boosted"])
def test_searches_read_every_labelled_row(spark, sf, searched, name):
    with pytest.raises(Called):
        QUERIES[name](spark, sf)
    assert searched[0][0] == 600


@pytest.mark.parametrize("name", ["m15_multiclass_report", "m15_multiclass_search"])
def test_grade_searches_read_every_row(spark, sf, searched, name):
    with pytest.raises(Called):
        QUERIES[name](spark, sf)
    assert searched[0][0] == 600 and searched[0][1].get("sample_share") == 1.0


def test_every_silver_table_reaches_both_gold_tables(spark, sf):
    got = QUERIES["m05_bronze_to_gold"](spark, sf).toArrow()
    duck = duckdb.connect()
    for name in ("customer", "orders", "lineitem", "events"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet/*.parquet'")
    assert rows_of(got) == rows_of(duck.sql(ORACLES["m05_bronze_to_gold"]).to_arrow_table())
    rows = got.to_pylist()
    assert len(rows) == 4 and all(r["clicked"] > 0 and r["ages"] > 0 and r["autos"] > 0 for r in rows)
    # a month takes the clicks of that month alone
    clicks = {r["snapshot_date"].month: r["clicks"] for r in rows if r["variant"] == "retrofit"}
    assert clicks[7] != clicks[8]
