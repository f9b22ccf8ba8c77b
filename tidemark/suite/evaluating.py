"""Model evaluation and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import drift, evaluation as ev
from tidemark.operators.ordered import row_numbers
from tidemark.session import scratch_path
from tidemark.sources import committed
from tidemark.suite import views
from tidemark.suite.registry import query, r6
from tidemark.suite.views import sql

# cumulative counts per distinct score, best first
_CURVE = """SELECT s, sum(p) OVER w AS tp, sum(n) OVER w AS fp, p, n, sum(p) OVER () AS pos, sum(n) OVER () AS neg
    FROM (SELECT {s} AS s, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY 1) WINDOW w AS (ORDER BY s DESC)"""
_AUC = "sum(CAST(n AS DOUBLE) / neg * (CAST(tp AS DOUBLE) / pos + CAST(tp - p AS DOUBLE) / pos) / 2)"
_PR = """sum(CAST(p AS DOUBLE) / pos * (CAST(tp AS DOUBLE) / (tp + fp)
    + CASE WHEN tp + fp - p - n = 0 THEN 1 ELSE CAST(tp - p AS DOUBLE) / (tp + fp - p - n) END) / 2)"""
_KS = "max(CAST(tp AS DOUBLE) / pos - CAST(fp AS DOUBLE) / neg)"


def _curve(column: str = "score") -> dict[str, str]:
    return {"curve": _CURVE.format(s=column)}


def _tied(spark, sf):
    return views.scored(spark, sf).drop("score").withColumnRenamed("tied", "score")


@query("e01_roc_points", sql(
    "SELECT s AS threshold, round(CAST(fp AS DOUBLE) / neg, 6) AS fpr, round(CAST(tp AS DOUBLE) / pos, 6) AS tpr FROM curve",
    "scored", **_curve()))
def _(spark, sf):
    return ev.roc_points(views.scored(spark, sf)).select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("e02_roc_auc", sql(f"SELECT round({_AUC}, 6) AS roc_auc FROM curve", "scored", **_curve()))
def _(spark, sf):
    return ev.ranking_metrics(views.scored(spark, sf)).select(r6("roc_auc").alias("roc_auc"))


@query("e02_roc_auc_ties", sql(f"SELECT round({_AUC}, 6) AS roc_auc FROM curve", "scored", **_curve("tied")))
def _(spark, sf):
    return ev.ranking_metrics(_tied(spark, sf)).select(r6("roc_auc").alias("roc_auc"))


@query("e03_gini", sql(f"SELECT round(2 * {_AUC} - 1, 6) AS gini FROM curve", "scored", **_curve()))
def _(spark, sf):
    return ev.ranking_metrics(views.scored(spark, sf)).select(r6("gini_coefficient").alias("gini"))


@query("e04_ks", sql(f"SELECT round({_KS}, 6) AS ks FROM curve", "scored", **_curve()))
def _(spark, sf):
    return ev.ranking_metrics(views.scored(spark, sf)).select(r6("ks_statistic").alias("ks"))


@query("e05_pr_area", sql(f"SELECT round({_PR}, 6) AS pr_auc FROM curve", "scored", **_curve()))
def _(spark, sf):
    return ev.ranking_metrics(views.scored(spark, sf)).select(r6("pr_auc").alias("pr_auc"))


@query("e05_pr_points", sql(
    """SELECT s AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, round(CAST(tp AS DOUBLE) / pos, 6) AS recall
    FROM curve""", "scored", **_curve("tied")))
def _(spark, sf):
    return ev.pr_points(_tied(spark, sf)).select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


_TOP = """SELECT p AS percentile, CAST(floor(c * p / 100.0) AS BIGINT) AS n_top, c, pos FROM (SELECT unnest({ps}) AS p),
    (SELECT count(*) AS c, sum(label) AS pos FROM scored)"""
_RANKED = "SELECT label, row_number() OVER (ORDER BY {s} DESC, key, label DESC) AS rn FROM scored"
_LIFT = """SELECT percentile, n_top, round(coalesce((SELECT sum(label) FROM ranked WHERE rn <= n_top) / CAST(nullif(n_top, 0) AS DOUBLE)
    / (pos / CAST(c AS DOUBLE)), 0), 6) AS lift FROM tops"""


def _lift_sql(ps: str, column: str) -> str:
    return sql(_LIFT, "scored", tops=_TOP.format(ps=ps), ranked=_RANKED.format(s=column))


def _lift_rows(df):
    return df.select(F.col("percentile"), "n_top", r6("lift").alias("lift"))


@query("e06_lift", _lift_sql("[10, 20]", "score"))
def _(spark, sf):
    return _lift_rows(ev.lift(views.scored(spark, sf), (10, 20)))


@query("e06_lift_fractional", _lift_sql("[CAST(0.5 AS DOUBLE), 2.5, 33.3]", "score"))
def _(spark, sf):
    return _lift_rows(ev.lift(views.scored(spark, sf), (0.5, 2.5, 33.3)))


@query("e06_lift_ties", _lift_sql("[10, 20]", "tied"))
def _(spark, sf):
    return _lift_rows(ev.lift(_tied(spark, sf), (10, 20)))


@query("e07_lift_chart", sql(
    """SELECT percentile, n_top, round(coalesce(top_pos / CAST(nullif(n_top, 0) AS DOUBLE) / (pos / CAST(c AS DOUBLE)), 0), 6) AS lift
    FROM tops LEFT JOIN (SELECT rn, sum(label) OVER (ORDER BY rn) AS top_pos FROM ranked) ON rn = n_top""",
    "scored", tops=_TOP.format(ps="CAST(range(1, 101) AS INTEGER[])"), ranked=_RANKED.format(s="tied")))
def _(spark, sf):
    return _lift_rows(ev.lift_chart(_tied(spark, sf)))


@query("e08_score_histogram", sql(
    """SELECT g.label, CAST(g.b AS INTEGER) AS bin, round(lo + (hi - lo) / 50 * g.b, 6) AS bin_from, round(lo + (hi - lo) / 50 * (g.b + 1), 6) AS bin_to,
    count(s.score) AS n FROM (SELECT label, lo, hi, unnest(range(0, 50)) AS b FROM edges) g
    LEFT JOIN (SELECT scored.label, score, least(floor((score - lo) / (hi - lo) * 50), 49) AS b FROM scored JOIN edges USING (label)) s
    ON g.label = s.label AND g.b = s.b GROUP BY ALL""",
    "scored", edges="SELECT label, min(score) AS lo, max(score) AS hi FROM scored GROUP BY label"))
def _(spark, sf):
    return ev.score_histogram(views.scored(spark, sf)).select(
        "label", "bin", r6("bin_from").alias("bin_from"), r6("bin_to").alias("bin_to"), "n"
    )


_CELLS = """SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5) AS true_negatives,
    count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS false_positives,
    count(*) FILTER (WHERE label = 1 AND score < 0.5) AS false_negatives,
    count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS true_positives FROM scored"""


def _predicted(spark, sf):
    return views.scored(spark, sf).withColumn("prediction", ev.predict(F.col("score")))


@query("e09_confusion", sql(_CELLS, "scored"))
def _(spark, sf):
    return ev.confusion(_predicted(spark, sf))


@query("e10_binary_rates", sql(
    """SELECT round(true_positives / CAST(true_positives + false_positives AS DOUBLE), 6) AS precision,
    round(true_positives / CAST(true_positives + false_negatives AS DOUBLE), 6) AS recall,
    round(2.0 * true_positives / CAST(2 * true_positives + false_positives + false_negatives AS DOUBLE), 6) AS f1_score FROM cells""",
    "scored", cells=_CELLS))
def _(spark, sf):
    rates = ev.binary_rates(ev.confusion(_predicted(spark, sf)))
    return rates.select(*[r6(c).alias(c) for c in rates.columns])


_REPORT = """SELECT class, tp, support, predicted, coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS precision,
    coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall, 2 * tp / CAST(support + predicted AS DOUBLE) AS f1_score
    FROM (SELECT class, (SELECT count(*) FROM graded WHERE label = class AND prediction = class) AS tp,
    (SELECT count(*) FROM graded WHERE label = class) AS support, (SELECT count(*) FROM graded WHERE prediction = class) AS predicted
    FROM (SELECT label AS class FROM graded UNION SELECT prediction FROM graded))"""
_AVERAGES = """round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision,
    round(sum(recall * support) / sum(support), 6) AS recall, round(avg(f1_score), 6) AS macro_f1,
    round(sum(f1_score * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS total_samples"""


@query("e11_averaged_metrics", sql(f"SELECT {_AVERAGES} FROM report", "graded", report=_REPORT))
def _(spark, sf):
    row = ev.averaged_metrics(ev.class_report(views.graded(spark, sf)))
    return row.select(*[r6(c).alias(c) for c in row.columns if c != "total_samples"], "total_samples")


@query("e12_class_f1", sql(
    "SELECT CASE class WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' ELSE 'Unknown_' || class END AS grade, round(f1_score, 6) AS f1_score FROM report",
    "graded", report=_REPORT))
def _(spark, sf):
    named = ev.f1_by_class(ev.class_report(views.graded(spark, sf)), {"1-URGENT": "A", "2-HIGH": "B"})
    return named.select("grade", r6("f1_score").alias("f1_score"))


@query("e13_business_metrics", sql(
    """SELECT count(*) AS total_loans, round(avg(label), 6) AS default_rate, round(avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END), 6) AS approval_rate,
    count(*) FILTER (WHERE label = 0 AND score >= 0.5) * 100 + count(*) FILTER (WHERE label = 1 AND score < 0.5) * 1000 AS total_cost
    FROM scored""", "scored"))
def _(spark, sf):
    row = ev.business_metrics(_predicted(spark, sf))
    return row.select("total_loans", r6("default_rate").alias("default_rate"), r6("approval_rate").alias("approval_rate"), "total_cost")


_LIFT_AT = """(SELECT round((SELECT sum(label) FROM ranked WHERE rn <= n_top) / CAST(n_top AS DOUBLE) / (pos / CAST(c AS DOUBLE)), 6)
    FROM tops WHERE percentile = {})"""


@query("e14_default_report", sql(
    f"""SELECT round(true_positives / CAST(true_positives + false_positives AS DOUBLE), 6) AS precision,
    round(true_positives / CAST(true_positives + false_negatives AS DOUBLE), 6) AS recall,
    round(2.0 * true_positives / CAST(2 * true_positives + false_positives + false_negatives AS DOUBLE), 6) AS f1_score,
    roc_auc, pr_auc, ks_statistic, gini_coefficient, {_LIFT_AT.format(10)} AS lift_at_10_percentile, {_LIFT_AT.format(20)} AS lift_at_20_percentile,
    true_negatives, false_positives, false_negatives, true_positives,
    true_negatives + false_positives + false_negatives + true_positives AS total_loans,
    (SELECT round(avg(label), 6) FROM scored) AS default_rate,
    (SELECT round(avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END), 6) FROM scored) AS approval_rate,
    false_positives * 100 + false_negatives * 1000 AS total_cost, CAST(0.5 AS DOUBLE) AS threshold,
    (SELECT count(*) FROM scored WHERE score IS NULL OR label IS NULL) AS unscored_loans
    FROM cells, (SELECT round({_AUC}, 6) AS roc_auc, round({_PR}, 6) AS pr_auc, round({_KS}, 6) AS ks_statistic,
    round(2 * {_AUC} - 1, 6) AS gini_coefficient FROM curve)""",
    "scored", cells=_CELLS, tops=_TOP.format(ps="[10, 20]"), ranked=_RANKED.format(s="score"), **_curve()))
def _(spark, sf):
    row = ev.loan_default_report(views.scored(spark, sf))
    doubles = {c for c, kind in row.dtypes if kind == "double"}
    return row.select(*[r6(c).alias(c) if c in doubles else F.col(c) for c in row.columns])


_BINARY = """SELECT class, tp, support, predicted, coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS precision,
    coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall, 2 * tp / CAST(support + predicted AS DOUBLE) AS f1_score
    FROM (SELECT class, count(*) FILTER (WHERE label = class AND said = class) AS tp, count(*) FILTER (WHERE label = class) AS support,
    count(*) FILTER (WHERE said = class) AS predicted
    FROM (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS said FROM scored), (SELECT unnest([0, 1]) AS class) GROUP BY class)"""


@query("e15_monthly_report", sql(
    f"""SELECT {_AVERAGES}, (SELECT round({_AUC}, 6) FROM curve) AS auc,
    round(max(f1_score) FILTER (WHERE class = 0), 6) AS f1_class_0, round(max(f1_score) FILTER (WHERE class = 1), 6) AS f1_class_1,
    max(predicted) FILTER (WHERE class = 0) AS predicted_0, max(predicted) FILTER (WHERE class = 1) AS predicted_1 FROM report""",
    "scored", report=_BINARY, **_curve()))
def _(spark, sf):
    row = ev.monthly_report(_predicted(spark, sf))
    averages = ("accuracy", "precision", "recall", "macro_f1", "weighted_f1", "auc")
    return row.select(
        *[r6(c).alias(c) for c in averages], "total_samples",
        *[r6(F.try_element_at("f1_by_grade", F.lit(k))).alias(f"f1_class_{k}") for k in "01"],
        *[F.try_element_at("predictions_distribution", F.lit(k)).alias(f"predicted_{k}") for k in "01"],
    )


@query("a09_prediction_distribution", sql("SELECT prediction, count(*) AS n FROM graded GROUP BY prediction", "graded"))
def _(spark, sf):
    return ev.distribution(views.graded(spark, sf))


@query("w03_cumulative_counts", sql(
    "SELECT s AS score, CAST(tp AS BIGINT) AS pos_through, CAST(fp AS BIGINT) AS neg_through FROM curve", "scored", **_curve()))
def _(spark, sf):
    return ev.score_curve(views.scored(spark, sf)).select("score", "pos_through", "neg_through")


@query("w04_top_rows", sql(
    """SELECT percentile, n_top, CAST((SELECT sum(label) FROM ranked WHERE rn <= n_top) AS BIGINT) AS top_pos, CAST(pos AS BIGINT) AS total_pos, c AS total_n
    FROM tops""", "scored", tops=_TOP.format(ps="[5, 10, 33, 100]"), ranked=_RANKED.format(s="tied")))
def _(spark, sf):
    return ev.top_rows(_tied(spark, sf), (5, 10, 33, 100))


@query("w04_row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders")
def _(spark, sf):
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return row_numbers(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).select("o_orderkey", "rn")


# --- drift -------------------------------------------------------------------
_EARLY = "SELECT {s} AS x FROM scored WHERE snapshot_date < DATE '1998-01-01'"
_LATE = "SELECT {s} AS x FROM scored WHERE snapshot_date >= DATE '1998-01-01'"
_BREAKS = """SELECT list_sort(list_distinct(quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS bps FROM expected"""
_BIN = "len(list_filter(bps, lambda b: b < x))"
_SHARES = f"""SELECT coalesce(e.bin, a.bin) AS bin, coalesce(e.share, 0.0001) AS expected, coalesce(a.share, 0.0001) AS actual FROM
    (SELECT {_BIN} AS bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM expected, breaks WHERE {_BIN} BETWEEN 1 AND len(bps) - 1 GROUP BY 1) e
    FULL JOIN (SELECT {_BIN} AS bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM actual, breaks
    WHERE {_BIN} BETWEEN 1 AND len(bps) - 1 GROUP BY 1) a ON e.bin = a.bin"""


def _drift(column: str) -> dict[str, str]:
    return {"expected": _EARLY.format(s=column), "actual": _LATE.format(s=column), "breaks": _BREAKS, "shares": _SHARES}


def _halves(spark, sf):
    df = views.scored(spark, sf)
    cut = F.lit("1998-01-01").cast("date")
    return df.where(F.col("snapshot_date") < cut), df.where(F.col("snapshot_date") >= cut)


@query("q01_psi", sql("SELECT round(sum((actual - expected) * ln(actual / expected)), 6) AS psi FROM shares", "scored", **_drift("score")))
def _(spark, sf):
    early, late = _halves(spark, sf)
    return drift.psi(early, late, "score").select(r6("psi").alias("psi"))


@query("q01_psi_bins", sql(
    "SELECT CAST(bin AS INTEGER) AS bin, round(expected, 6) AS expected, round(actual, 6) AS actual FROM shares", "scored", **_drift("tied")))
def _(spark, sf):
    early, late = _halves(spark, sf)
    return drift.psi_table(early, late, "tied").select("bin", r6("expected").alias("expected"), r6("actual").alias("actual"))


@query("q02_out_of_time", sql(
    f"""SELECT (SELECT round({_AUC}, 6) FROM curve) AS oot_roc_auc, (SELECT round({_KS}, 6) FROM curve) AS oot_ks_statistic,
    (SELECT round(2 * {_AUC} - 1, 6) FROM curve) AS oot_gini_coefficient, {_LIFT_AT.format(10)} AS oot_lift_at_10,
    (SELECT round(sum((actual - expected) * ln(actual / expected)), 6) FROM shares) AS oot_score_psi""",
    "scored", **_drift("score"),
    **{k: v.replace("FROM scored", "FROM (SELECT * FROM scored WHERE snapshot_date >= DATE '1998-01-01')") for k, v in (
        ("curve", _CURVE.format(s="score")), ("tops", _TOP.format(ps="[10]")), ("ranked", _RANKED.format(s="score")))}))
def _(spark, sf):
    early, late = _halves(spark, sf)
    row = drift.out_of_time_report(late, early)
    return row.select(*[r6(c).alias(c) for c in row.columns])


@query("q02_stored_summaries", sql(
    f"""SELECT (SELECT round({_AUC}, 6) FROM curve) AS roc_auc, (SELECT round({_KS}, 6) FROM curve) AS ks_statistic, (SELECT round(2 * {_AUC} - 1, 6) FROM curve) AS gini_coefficient,
    (SELECT count(*) FROM scored WHERE snapshot_date >= DATE '1998-01-01') AS n,
    (SELECT round(sum((actual - expected) * ln(actual / expected)), 6) FROM shares) AS score_psi""",
    "scored", **_drift("score"),
    **{"curve": _CURVE.format(s="score").replace("FROM scored", "FROM (SELECT * FROM scored WHERE snapshot_date >= DATE '1998-01-01')")}))
def _(spark, sf):
    """Months are summed up once, as they come; later months are then held against earlier ones from the summaries alone."""
    path = scratch_path(spark, "summaries")
    early, late = _halves(spark, sf)
    for part in (early, late, late.where("snapshot_date >= date '1998-06-01'")):  # some months come once more
        drift.store_summaries(part, path)
    months = [committed.part_value(n, "snapshot_date") for n in committed.read_manifest(spark, path).parts]
    found = drift.monitor(spark, path, [m for m in months if m >= "1998-01-01"], [m for m in months if m < "1998-01-01"])
    return found.select("n", *[r6(c).alias(c) for c in ("roc_auc", "ks_statistic", "gini_coefficient", "score_psi")])
