"""Evaluation, quantiles and drift against brute force and known cases."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import drift, evaluation as ev
from tidemark.operators.ordered import exact_quantiles, row_numbers, running_totals

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def scored(spark, pairs):
    data = [(i, int(y), float(s)) for i, (y, s) in enumerate(pairs)]
    return spark.createDataFrame(data, "key long, label int, score double").repartition(4)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ks(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    cuts = {s for _, s in pairs}
    return max([0.0] + [sum(s >= c for s in pos) / len(pos) - sum(s >= c for s in neg) / len(neg) for c in cuts])


PAIRS = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda v: v / 6)), min_size=2, max_size=60)


@SLOW
@given(pairs=PAIRS)
def test_ranking_matches_brute_force(spark, pairs):
    got = ev.ranking_metrics(scored(spark, pairs)).first()
    want = brute_auc(pairs)
    if want is None:
        assert got.roc_auc is None and got.ks_statistic is None
    else:
        assert got.roc_auc == pytest.approx(want)
        assert got.gini_coefficient == pytest.approx(2 * want - 1)
        assert got.ks_statistic == pytest.approx(brute_ks(pairs))
        assert 0 <= got.ks_statistic <= 1


@pytest.mark.parametrize("pairs, auc, ks", [
    ([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], 1.0, 1.0),
    ([(1, 0.5), (0, 0.5), (0, 0.5)], 0.5, 0.0),
    ([(0, 0.9), (1, 0.1)], 0.0, 0.0),
])
def test_ranking_known_cases(spark, pairs, auc, ks):
    got = ev.ranking_metrics(scored(spark, pairs)).first()
    assert (got.roc_auc, got.ks_statistic) == (pytest.approx(auc), pytest.approx(ks))


def test_pr_area_is_the_trapezoid_from_recall_zero(spark):
    pairs = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)]
    # points (0, 1) (0.5, 1) (0.5, 0.5) (1, 2/3) (1, 0.5)
    assert ev.ranking_metrics(scored(spark, pairs)).first().pr_auc == pytest.approx(0.5 + 0.5 * (0.5 + 2 / 3) / 2)


def brute_lift(pairs, p):
    ordered = sorted(((-s, i, y) for i, (y, s) in enumerate(pairs)))
    n = int(len(pairs) * p / 100)
    rate = sum(y for y, _ in pairs) / len(pairs)
    if rate == 0:
        return 0.0
    if n == 0:
        return None
    return sum(y for _, _, y in ordered[:n]) / n / rate


@SLOW
@given(pairs=PAIRS)
def test_lift_matches_brute_force(spark, pairs):
    got = {r.percentile: r.lift for r in ev.lift(scored(spark, pairs), (3, 10, 20, 50, 100)).collect()}
    assert len(got) == 5
    for p, value in got.items():
        want = brute_lift(pairs, p)
        assert value == (want if want is None else pytest.approx(want))


def test_lift_edges(spark):
    five = [(1, 0.9), (0, 0.8), (0, 0.7), (0, 0.6), (1, 0.5)]
    assert ev.lift(scored(spark, five), (10,)).first().lift is None
    chart = {r.percentile: r.lift for r in ev.lift_chart(scored(spark, five)).collect()}
    assert len(chart) == 100 and chart[19] == 0.0 and chart[100] == pytest.approx(1.0)
    assert ev.lift(scored(spark, [(0, 0.5)] * 20), (10,)).first().lift == 0.0


def test_confusion_and_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    cells = ev.confusion(df)
    assert tuple(cells.first()) == (1, 0, 2, 0)
    assert tuple(ev.binary_rates(cells).first()) == (0.0, 0.0, 0.0)
    assert ev.business_metrics(df).first().total_cost == 2000


def test_class_report_counts_classes_of_both_sides(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), ("C", "B"), ("C", "D")], "label string, prediction string")
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support) for r in ev.class_report(df).collect()}
    assert got == {"A": (1.0, 0.5, pytest.approx(2 / 3), 2), "B": (0.0, 0.0, 0.0, 0), "C": (0.0, 0.0, 0.0, 2), "D": (0.0, 0.0, 0.0, 0)}
    mean = ev.averaged_metrics(ev.class_report(df)).first()
    assert mean.macro_f1 == pytest.approx((2 / 3) / 4) and mean.accuracy == 0.25 and mean.total_samples == 4
    named = rows(ev.f1_by_class(ev.class_report(df), {"A": "good"}), "grade")
    assert named == [("Unknown_B",), ("Unknown_C",), ("Unknown_D",), ("good",)]


def test_full_report_agrees_with_its_parts(spark):
    pairs = [(i % 3 == 0, (i * 7 % 50) / 50) for i in range(200)]
    df = scored(spark, pairs)
    row = ev.loan_default_report(df).first()
    with_prediction = df.withColumn("prediction", ev.predict(F.col("score")))
    other = ev.loan_default_report(with_prediction, prediction="prediction").first()
    assert row.asDict() == pytest.approx(other.asDict())
    cells = ev.confusion(with_prediction).first()
    assert (row.true_negatives, row.false_positives, row.false_negatives, row.true_positives) == tuple(cells)
    assert row.roc_auc == pytest.approx(brute_auc(pairs))
    assert row.total_loans == 200 and row.threshold == 0.5


def test_monthly_report_without_score(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "label int, prediction int")
    row = ev.monthly_report(df, score=None).first()
    assert row.auc is None and row.predictions_distribution == {"0": 1, "1": 2}
    assert set(row.f1_by_grade) == {"0", "1"}


def test_histogram(spark):
    df = scored(spark, [(0, 0.0), (0, 1.0), (0, 0.5), (1, 0.3)])
    got = ev.score_histogram(df).collect()
    assert len(got) == 100
    filled = {(r.label, r.bin): r.n for r in got if r.n}
    assert filled == {(0, 0): 1, (0, 25): 1, (0, 49): 1, (1, 25): 1}  # one value: its range is widened by 0.5


# --- running totals and quantiles --------------------------------------------
def test_running_totals_over_many_ranges(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_totals(df, [F.col("id").desc()], ["v"])
        assert got.count() == 1000
        table = {r.id: (r.v_before, r.v_through) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = 0
    for i in range(999, -1, -1):
        assert table[i] == (total, total + i % 7)
        total += i % 7


def test_running_totals_within_groups(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 3).alias("g"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_totals(df, [F.col("id").asc()], ["v"], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(r.v_through == r.id // 3 + 1 for r in got) and len(got) == 300


def test_row_numbers(spark):
    got = row_numbers(spark.range(50), [F.col("id").desc()]).collect()
    assert {r.id: r.rn for r in got} == {i: 50 - i for i in range(50)}


@SLOW
@given(values=st.lists(st.integers(-5, 30), min_size=1, max_size=40))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = [i / 10 for i in range(11)]
    got = exact_quantiles(df, "x", probs).first().quantiles
    assert got == pytest.approx(list(np.percentile(values, [p * 100 for p in probs])))
    reached = exact_quantiles(df, "x", [0.97], interpolate=False).first().quantiles[0]
    ordered = sorted(values)
    assert reached == ordered[max(math.ceil(0.97 * len(values)) - 1, 0)]


def test_quantiles_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", None)], "g string, x double")
    assert rows(exact_quantiles(df, "x", [0.5], within=["g"]), "g", "quantiles") == [("a", [2.0]), ("b", [5.0])]


# --- drift -------------------------------------------------------------------
def brute_psi(expected, actual, buckets=10):
    breaks = np.unique(np.percentile(expected, [i * 100 / buckets for i in range(buckets + 1)]))

    def shares(values):
        bins = [int(np.searchsorted(breaks, v, side="left")) for v in values]
        kept = [b for b in bins if 1 <= b < len(breaks)]
        return {b: kept.count(b) / len(kept) for b in set(kept)}

    e, a = shares(expected), shares(actual)
    return sum((a.get(b, 0.0001) - e.get(b, 0.0001)) * math.log(a.get(b, 0.0001) / e.get(b, 0.0001)) for b in set(e) | set(a))


@pytest.mark.parametrize("expected, actual", [
    (list(range(100)), list(range(100))),
    (list(range(100)), [v // 2 for v in range(100)]),
    ([v % 4 for v in range(80)], [v % 3 for v in range(50)]),
    (list(range(20)), [-5, 99, 3, 4, 5, 0]),
])
def test_psi(spark, expected, actual):
    e = spark.createDataFrame([(float(v),) for v in expected], "x double")
    a = spark.createDataFrame([(float(v),) for v in actual], "x double")
    got = drift.psi(e, a, "x").first().psi
    assert got == pytest.approx(brute_psi(expected, actual), abs=1e-12)


def test_psi_sketch_is_close(spark):
    e = spark.range(5000).select(F.col("id").cast("double").alias("x"))
    a = spark.range(5000).select((F.col("id") * F.col("id") / 5000).alias("x"))  # every bin is filled
    assert drift.psi(e, a, "x", exact=False).first().psi == pytest.approx(drift.psi(e, a, "x").first().psi, abs=0.01)


def test_out_of_time_keys(spark):
    df = scored(spark, [(i % 2, (i % 10) / 10) for i in range(100)])
    assert drift.out_of_time_report(df, df).columns == [
        "oot_roc_auc", "oot_ks_statistic", "oot_gini_coefficient", "oot_lift_at_10", "oot_score_psi",
    ]
    assert drift.out_of_time_report(df, df).first().oot_score_psi == pytest.approx(0)


def test_fractional_percentiles(spark):
    df = scored(spark, [(i % 4 == 0, 1 - i / 400) for i in range(400)])
    got = {r.percentile: (r.n_top, r.lift) for r in ev.lift(df, (0.5, 2.5, 10)).collect()}
    assert got[0.5] == (2, pytest.approx(2.0)) and got[2.5] == (10, pytest.approx(1.2)) and got[10.0][0] == 40
    assert [r.percentile for r in ev.lift(df, (10, 20)).orderBy("percentile").collect()] == [10, 20]


def test_labels_must_be_binary(spark):
    with pytest.raises(Exception, match="not a binary label"):
        ev.ranking_metrics(spark.createDataFrame([(1, 2, 0.5), (2, 0, 0.1)], "key long, label int, score double")).collect()


def test_rows_without_score_are_counted(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, None), (3, None, 0.2), (4, 0, 0.1)], "key long, label int, score double")
    got = ev.loan_default_report(df).first()
    assert (got.total_loans, got.unscored_loans, got.roc_auc) == (2, 2, 1.0)


def test_one_vs_rest_auc(spark):
    rng = np.random.default_rng(3)
    data = [(int(y), (np.round(rng.dirichlet(np.ones(3)) + 0.3 * np.eye(3)[y], 1)).tolist()) for y in rng.integers(0, 3, 60)]
    df = spark.createDataFrame([(y, int(np.argmax(p)), p) for y, p in data], "label int, prediction int, scores array<double>")
    want = {c: brute_auc([(int(y == c), p[c]) for y, p in data]) for c in range(3)}
    got = {r["class"]: r.roc_auc for r in ev.one_vs_rest_auc(df).collect()}
    assert got == {c: pytest.approx(v) for c, v in want.items()}
    assert ev.monthly_report(df, score="scores").first().auc == pytest.approx(sum(want.values()) / 3)
