"""The language model is the same however its texts are dealt, and every position is a target once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm_score

SF = "/root/testdata/sf0.001"


def test_model_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one, eight = (lm_score.fit_lm(docs.repartition(n), part_words=20_000) for n in (1, 8))
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(one.weights, eight.weights))
    told = [lm_score.score_texts(docs, m).select("doc_id", "mean_log_prob").toPandas().set_index("doc_id")["mean_log_prob"] for m in (one, eight)]
    assert abs(told[0] - told[1]).max() == pytest.approx(0, abs=1e-4)


def test_every_position_is_a_target_once(monkeypatch):
    texts = pa.array([" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 7, 900)] + [None, ""], pa.string())
    seen = []
    monkeypatch.setattr(lm_score, "_learn", lambda trainer, waiting, least: sum(seen.append(c.copy()) or len(t) for c, t in waiting) + (waiting.clear() or 0))

    class Shared:
        value = (lm_score.new_weights(), np.zeros(lm_score.VOCABULARY, np.int64))

    for round_ in range(2):
        list(lm_score._train(Shared, 2, 0.05, round_)(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    assert sum(len(c) for c in seen) == 910


def test_counts_by_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    assert np.array_equal(lm_score.word_counts(docs.repartition(9)), lm_score.word_counts(docs.coalesce(1)))
    assert lm_score.word_counts(docs.where(F.lit(False))).sum() == 0
