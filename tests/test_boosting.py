"""Boosted trees against plain versions, their stopping, and how they are dealt out."""

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import rows as sorted_rows
from pyspark.sql import functions as F

from tidemark.operators import boosting, evaluation, models


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 4)).round(2)
    y = (rng.random(1500) < 1 / (1 + np.exp(-(2 * x[:, 0] + x[:, 1] * x[:, 2])))).astype(int)
    data = [(i, *map(float, x[i]), int(y[i]), int(np.digitize(x[i, 0], [-0.7, 0.1, 0.9]))) for i in range(1500)]
    return spark.createDataFrame(data, "loan_id long, a double, b double, c double, d double, label int, grade int")


def plain_tree(x, g, h, depth, rate):
    """Every cut of every feature at every node, without bins; returns the value of each row."""
    out = np.zeros(len(x))

    def split(rows, left):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (boosting.LEAST_GAIN, None)
        for f in range(x.shape[1]) if left else ():
            for cut in np.unique(x[rows, f])[:-1]:
                low = rows[x[rows, f] <= cut]
                gl, hl = g[low].sum(), h[low].sum()
                if hl >= 1 and hs - hl >= 1:
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut))
        if best[1] is None:
            out[rows] = -rate * gs / (hs + 1)
            return
        f, cut = best[1]
        split(rows[x[rows, f] <= cut], left - 1)
        split(rows[x[rows, f] > cut], left - 1)

    split(np.arange(len(x)), depth)
    return out


def test_against_plain_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (300, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 3) ^ (rng.random(300) < 0.2)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, label int")
    model = boosting.fit(df, ["a", "b", "c"], n_estimators=6, max_depth=3, learning_rate=0.3)
    margin = np.full(300, math.log((y.sum() + 0.5) / (300 - y.sum() + 0.5)))
    for _ in range(6):
        p = 1 / (1 + np.exp(-margin))
        margin += plain_tree(x, p - y, p * (1 - p), 3, 0.3)
    assert model.probabilities(x)[:, 1] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-5)


def test_growth_ends_after_the_best_round(noisy):
    held = F.col("loan_id") % 4 == 0
    settings = {"n_estimators": 600, "learning_rate": 0.3, "key": ["loan_id"]}
    model = boosting.fit(noisy, "abcd", validation=held, patience=30, **settings)
    best = int(np.argmin(model.losses)) + 1
    assert len(model.rounds) == best and model.fitted_rounds == len(model.losses) == best + 30 < 600
    short = boosting.fit(noisy, "abcd", validation=held, patience=7, **settings)
    assert short.fitted_rounds == len(short.rounds) + 7
    whole = boosting.fit(noisy, "abcd", validation=held, **{**settings, "n_estimators": 60})
    assert whole.fitted_rounds == 60 and whole.losses[: len(model.losses)] == model.losses and len(whole.rounds) == int(np.argmin(whole.losses)) + 1
    # the loss of the model returned is the one that was measured while it grew
    scored = models.score_rows(model, noisy.where(held), list("abcd"), ["label"]).toPandas()
    said = np.where(scored["label"] == 1, scored["score"], 1 - scored["score"])
    assert -np.log(said).mean() == pytest.approx(model.losses[best - 1], abs=1e-7)


@pytest.mark.parametrize("classes,label", [(2, "label"), (4, "grade")])
def test_same_model_however_rows_are_dealt(spark, noisy, monkeypatch, classes, label):
    """In one task or spread, a level a job; margins staged on the way, many batches to a task."""
    held, settings = F.col("loan_id") % 4 == 0, {"n_estimators": 5, "max_depth": 3, "subsample": 0.7, "colsample": 0.6, "key": ["loan_id"]}
    alone = boosting.fit(noisy, "abcd", label, held, classes, **settings)
    monkeypatch.setattr(boosting, "TASK_ROWS", 400)
    monkeypatch.setattr(boosting, "STAGED_ROUNDS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 70)
    try:
        spread = boosting.fit(noisy.repartition(5), "abcd", label, held, classes, **settings)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert alone.losses == spread.losses and len(alone.rounds) == len(spread.rounds) > 0
    for one, other in zip(alone.rounds, spread.rounds):
        for t, u in zip(one, other):
            assert t.depth == u.depth and all((np.nan_to_num(getattr(t, c), nan=-9) == np.nan_to_num(getattr(u, c), nan=-9)).all() for c in boosting.TREE if c != "depth")


def test_chunks_go_on_from_a_fitted_model(noisy, monkeypatch):
    once = boosting.fit(noisy, "abcd", n_estimators=9, key=["loan_id"])
    monkeypatch.setattr(boosting, "CHUNK_ROUNDS", 4)
    parts = boosting.fit(noisy, "abcd", n_estimators=9, key=["loan_id"])
    x = np.random.default_rng(2).normal(size=(50, 4))
    assert (once.probabilities(x) == parts.probabilities(x)).all() and len(parts.rounds) == 9


def test_several_classes(noisy):
    model = boosting.fit(noisy, "abcd", "grade", classes=4, n_estimators=40, key=["loan_id"])
    said = boosting.score_many([model, replace(model, rounds=())], noisy, ["loan_id", "grade"]).toPandas()
    first, empty = (said[said["model"] == i] for i in (0, 1))
    shares = np.stack(first["scores"])
    assert shares.sum(1) == pytest.approx(1) and (shares.argmax(1) == first["grade"]).mean() > 0.99
    assert len({tuple(s) for s in empty["scores"]}) == 1
    auc = evaluation.one_vs_rest_auc(boosting.score_many([model], noisy, ["grade"]), "grade", "scores").collect()
    assert all(r["roc_auc"] > 0.999 for r in auc) and len(auc) == 4


def test_odd_rows(spark, noisy):
    odd = spark.createDataFrame([(None, 1.0, 1), (float("nan"), None, 0), (3.0, 2.0, None)] * 3, "a double, b double, label int")
    model = boosting.fit(odd, ["a", "b"], n_estimators=2)
    scored = models.score_rows(model, odd, ["a", "b"], [])
    assert scored.count() == 9 and scored.where("score is null or score < 0 or score > 1").count() == 0
    none = boosting.fit(odd.limit(0), ["a", "b"], n_estimators=2)
    assert none.rounds == () and models.score_rows(none, odd, ["a", "b"], []).where("abs(score - 0.5) > 1e-9").count() == 0
    one = boosting.fit(noisy.where("label = 1"), "abcd", n_estimators=3)
    assert (one.probabilities(np.zeros((1, 4)))[0, 1] > 0.99) and one.featureImportances.toArray().sum() in (0, pytest.approx(1))
    assert model.trees(spark).where("left = node and feature is not null").count() == 0


def test_search_table(noisy):
    ranges = {**models.SEARCH_RANGES, "n_estimators": (20, 40, 10), "max_depth": (2, 4)}
    found = models.tune_boosted(noisy, list("abcd"), trials=3, ranges=ranges, patience=5)
    table = found.trials.toPandas().set_index("trial")
    assert len(table) == 3 and (table["n"] == 300).sum() + (abs(table["n"] - 300) <= 2).sum() >= 3
    best = table["loss"].idxmin()
    assert found.settings["max_depth"] == table["max_depth"][best] and len(found.model.rounds) == table["n_estimators"][best]
    for trial, row in table.iterrows():
        report = evaluation.loan_default_report(found.scored.where(F.col("trial") == trial)).first()
        for c in ("roc_auc", "ks_statistic", "gini_coefficient", "lift_at_10_percentile"):
            assert row[c] == pytest.approx(report[c])
        assert row["loss"] == pytest.approx(1 - report["roc_auc"])


def test_grouped_metrics(spark):
    data = [("m", i, i % 2, float(i % 5)) for i in range(40)] + [("n", i, 1, 0.5) for i in range(5)] + [("m", 99, None, 1.0)]
    df = spark.createDataFrame(data, "g string, key int, label int, score double")
    got = {r["g"]: r for r in evaluation.ranking_by_group(df, "g").collect()}
    want = evaluation.loan_default_report(df.where("g = 'm' and label is not null")).first()
    assert got["m"]["n"] == 40 and got["m"]["lift_at_10_percentile"] == pytest.approx(want["lift_at_10_percentile"])
    assert got["m"]["roc_auc"] == pytest.approx(want["roc_auc"]) and got["m"]["ks_statistic"] == pytest.approx(want["ks_statistic"])
    assert got["n"]["roc_auc"] is None and got["n"]["positives"] == 5
    f1 = spark.createDataFrame([("x", 0, 0), ("x", 0, 1), ("x", 1, 1), ("x", None, 2), ("y", 1, 2)], "g string, label int, prediction int")
    assert sorted_rows(evaluation.macro_f1_by_group(f1, ["g"]), "g", "n", "macro_f1") == [("x", 3, pytest.approx(2 / 3)), ("y", 1, 0.0)]


@pytest.mark.parametrize("depth, classes, label", [(4, 4, "grade"), (9, 2, "label")])
def test_scores_by_leaf_bits(spark, noisy, depth, classes, label):
    """Scoring by leaf bits, and the walk of trees with more than 64 leaves, give what node-by-node descent gives, to the last bit."""
    features = ["a", "b", "c", "d"]
    model = boosting.fit(noisy, features, label, classes=classes, n_estimators=8, max_depth=depth, learning_rate=0.5, min_child_weight=0.0)
    leaves = [int((t.feature < 0).sum()) for trees in model.rounds for t in trees]
    assert (max(leaves) > 64) == (classes == 2)
    values = np.vstack([np.array([r[1:5] for r in sorted_rows(noisy, "loan_id", *features)]), [[np.inf, -np.inf, 0, 1e300]], [[c[0] for c in model.cuts]]])

    def descent(tree, row):
        node = 0
        while tree.feature[node] >= 0:
            node = (tree.left if row[tree.feature[node]] <= tree.cut[node] else tree.right)[node]
        return tree.value[node]

    margins = np.tile(np.array(model.priors), (len(values), 1))
    for trees in model.rounds:
        for k, tree in enumerate(trees):
            margins[:, k] += [descent(tree, row) for row in values]
    assert (model.probabilities(values) == boosting.class_shares(margins)).all()
    assert [t.masks([len(c) + 1 for c in model.cuts]) is None for trees in model.rounds for t in trees] == [n > 64 for n in leaves]
    scored = models.score_rows(model, noisy, features, ["loan_id"]).join(boosting.score_many([model], noisy, ["loan_id"]), "loan_id")
    assert scored.where((F.col("score") != F.col("scores")[1]) | (F.size("scores") != classes)).isEmpty() and scored.count() == 1500
