"""Languages that the pipeline rejects, and documents that it keeps."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.language_gate import Gate, fit_gate

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark):
    """The documents of the table, then texts of an unseen script and of letter noise."""
    rng = random.Random(7)

    def words(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))

    odd = [words("абвгдежзийклмнопрстуфхцчшщ", 80) for _ in range(20)] + ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200)) for _ in range(20)]
    noise = [words("bcdfghjklmnpqrstvwxyzaeiou", 200) for _ in range(20)]
    rows = [(10**9 + i, text, None, "odd" if i < len(odd) else "noise", len(text)) for i, text in enumerate(odd + noise)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_language_stage(spark, planted):
    kept = corpus_pipeline.language_id(spark, planted, SF).select("doc_id", "source", "text").toPandas()
    assert not (kept["source"] == "odd").any()
    assert (kept["source"] == "noise").sum() <= 10
    clean = planted.where("doc_id < 1000000000").where(F.col("text").rlike(r"\p{L}"))
    assert (kept["doc_id"] < 10**9).sum() >= 0.995 * clean.count()


def test_gate_by_letters_and_scores(spark):
    df = spark.createDataFrame([("abc def", "en", 0.9), ("abc def", "en", 0.2), ("где кто", "en", 0.9), ("abc где", "en", 0.9), ("12", "und", 0.0), (None, "und", 0.0), ("a" * 5000, "en", 0.5)], "text string, lang string, score double")
    gate = Gate({2: 0.4, 8: 0.6}, "abcdef")
    got = df.select(F.coalesce(gate.accepts(F.col("text"), F.col("lang"), F.col("score")), F.lit(False)).alias("k")).collect()
    assert [r["k"] for r in got] == [True, False, False, True, False, False, False]
    empty = fit_gate(None, df.limit(0), df.limit(0))
    assert empty == Gate({}, "")


def test_many_shards_of_a_source(spark, monkeypatch):
    """Shards beyond one group get the same words in all."""
    monkeypatch.setattr(mixing, "SHARD_DOCS", 5)
    rows = [(i, "w " * (1 + i * 7 % 50), "a" if i % 3 else "b") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = mixing.mix_sources(df).toPandas().merge(df.select("doc_id", "source").toPandas(), on="doc_id")
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 16)
    two = mixing.mix_sources(df).toPandas().merge(df.select("doc_id", "source").toPandas(), on="doc_id")
    for got in (one, two):
        by = got.groupby("source").agg({"taken": "sum", "target": "first"})
        assert (abs(by["taken"] - by["target"]) <= 2 * mixing.BLOCK_WORDS).all() and (got["taken"] <= 3 * got["size"]).all()
