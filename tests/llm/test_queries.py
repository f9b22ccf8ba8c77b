"""The registered queries beside their SQL, and the pipeline, over the smallest tables."""

import os
import sys

import duckdb
import pytest
from edge_rows import CLASHING, edge  # noqa: F401
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check import TABLES, rows_of  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import language_id, ngram_join  # noqa: E402
from tidemark.llm.common import Scratch  # noqa: E402
from tidemark.llm.mixing import NEW  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    if name in ORACLES:
        assert rows_of(got) == rows_of(duck.sql(ORACLES[name]).to_arrow_table())
    else:
        assert got.num_rows > 0


def test_entry_names():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages(spark):
    docs, scratch, kept = spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark, "test"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, scratch.write(stage(spark, docs, SF), name)
        if name != "mixing":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            pairs = ngram_join.ngram_components(docs, 5, 80)
            assert pairs.where("doc_id <> component_id").count() == 0
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    mixed = docs.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 128 for r in mixed)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "mixing"]


def test_stages_on_odd_rows(spark, edge):
    """Nulls, blanks, repeated rows, long texts and clashing columns go through every stage."""
    docs, scratch = edge, Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        own = stage(spark, edge, SF)
        assert name == "mixing" or own.columns == edge.columns
        kept = {c: r[c] for r in own.collect() for c in CLASHING if c not in NEW or name != "mixing"}
        assert kept == {c: f"kept-{c}" for c in kept} and len(kept) >= len(CLASHING) - len(NEW)
        assert stage(spark, edge.limit(0), SF).count() == 0
        docs = scratch.write(stage(spark, docs, SF), name)
    ids = [r["doc_id"] for r in docs.collect()]
    assert 2 not in ids and 5 not in ids and not {6, 7} <= set(ids)


def test_rejected_languages(spark, edge):
    kept = corpus_pipeline.language_id(spark, edge, SF)
    assert kept.where(~language_id.has_letters(F.col("text"))).count() == 0
