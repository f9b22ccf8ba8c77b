"""Model evaluation over ``(key, label, score[, prediction])`` rows.

Everything starts from one reduction of the rows to distinct scores, so ties are
exact and a hot score is a single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from tidemark import fixed_values as fv
from tidemark.operators.ordered import running_totals
from tidemark.session import staged


CELLS = ("true_negatives", "false_positives", "false_negatives", "true_positives")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 when the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def predict(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def score_counts(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(by, score, pos, neg): how many positives and negatives have each score. Such counts of several months add up.

    Labels are 0 or 1; any other value is an error. Rows without a label or score are left out.
    """
    zero_one = F.when(F.col(label).isNull() | F.col(label).isin(0, 1), F.col(label).cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("not a binary label: "), F.col(label).cast("string"))).cast("long")
    )
    known = scored.select(*by, F.col(score).cast("double").alias("score"), zero_one.alias("label")).where(F.col("score").isNotNull() & F.col("label").isNotNull())
    return known.groupBy(*by, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))


def curve_of_counts(counts: DataFrame) -> DataFrame:
    """Distinct scores, best first, with positives and negatives before and through each."""
    curve = running_totals(counts, [F.col("score").desc()], ["pos", "neg"])
    return curve.withColumn("totals", curve.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar())


def score_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``curve_of_counts`` of rows."""
    return curve_of_counts(score_counts(scored, label, score))


def _rates(curve: DataFrame) -> DataFrame:
    total = F.col("totals")
    positives, negatives = total["pos"].cast("double"), total["neg"].cast("double")
    seen_before = F.col("pos_before") + F.col("neg_before")
    return curve.select(
        "score", "pos", "neg", "pos_before", "pos_through", "neg_before", "neg_through", "totals",
        F.try_divide(F.col("pos_before"), positives).alias("tpr_before"),
        F.try_divide(F.col("pos_through"), positives).alias("tpr"),
        F.try_divide(F.col("neg_before"), negatives).alias("fpr_before"),
        F.try_divide(F.col("neg_through"), negatives).alias("fpr"),
        F.coalesce(F.try_divide(F.col("pos_before").cast("double"), seen_before), F.lit(1.0)).alias("precision_before"),
        (F.col("pos_through") / (F.col("pos_through") + F.col("neg_through"))).alias("precision"),
    )


def roc_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score; the curve starts at (0, 0)."""
    return _rates(score_curve(scored, label, score)).select(F.col("score").alias("threshold"), "fpr", "tpr")


def pr_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score; the curve starts at recall 0, precision 1."""
    return _rates(score_curve(scored, label, score)).select(
        F.col("score").alias("threshold"), "precision", F.col("tpr").alias("recall")
    )


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """roc_auc, gini_coefficient, ks_statistic and pr_auc in one row; NULL for a single class."""
    return _ranking(_rates(score_curve(scored, label, score)))


def _ranking_columns() -> list[Column]:
    auc = F.sum((F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2)
    area = F.sum((F.col("tpr") - F.col("tpr_before")) * (F.col("precision") + F.col("precision_before")) / 2)
    return [
        auc.alias("roc_auc"), (2 * auc - 1).alias("gini_coefficient"),
        F.greatest(F.max(F.col("tpr") - F.col("fpr")), F.lit(0.0) * auc).alias("ks_statistic"), area.alias("pr_auc"),
    ]


def _ranking(rates: DataFrame) -> DataFrame:
    return rates.agg(*_ranking_columns())


def ranking_of_counts(counts: DataFrame, top: float = 10) -> DataFrame:
    """roc_auc, gini_coefficient, ks_statistic, pr_auc, n, positives and the lift of the top ``top`` % from (score, pos, neg) counts.

    Rows cannot be told apart in counts, so at the cut of the top a share of the tied score's positives counts.
    """
    rates = _rates(curve_of_counts(counts.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))))
    total_n, total_pos = F.col("totals.pos") + F.col("totals.neg"), F.col("totals.pos")
    n_top = F.floor(total_n * F.lit(top) / 100)
    taken = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (n_top - F.col("pos_before") - F.col("neg_before")) / (F.col("pos") + F.col("neg"))))
    found = rates.agg(*_ranking_columns(), F.max(total_n).alias("n"), F.max(total_pos).alias("positives"), F.max(n_top).alias("_top"), F.sum(taken * F.col("pos")).alias("_pos"))
    lifted = F.try_divide(F.try_divide(F.col("_pos"), F.col("_top")), F.try_divide(F.col("positives"), F.col("n")))
    return found.withColumn(f"lift_at_{top:g}_percentile", lifted).drop("_top", "_pos")


def ranking_by_group(scored: DataFrame, group: str, key: str = "key", label: str = "label", score: str = "score", top: float = 10) -> DataFrame:
    """Per group (say, a model) n, positives, roc_auc, gini_coefficient, ks_statistic and the lift of the top ``top`` % of rows.

    Ties are exact; at the cut of the top, tied rows are taken in key order. Rows without a label or score are left out. One pass for all groups.
    """
    known = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        F.col(group).alias("_g"), F.col(key).alias("key"), F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("label")
    )
    rows = known.groupBy("_g", "score", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    rows = staged(running_totals(rows, [F.col("score").desc(), F.col("key").asc()], ["n", "pos"], ["_g"]), "ranked")
    curve = rows.groupBy("_g", "score").agg(F.max("n_through").alias("n"), F.max("pos_through").alias("pos"), F.min("n_before").alias("n0"), F.min("pos_before").alias("pos0"))
    size = rows.groupBy("_g").agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    size = staged(size, "sizes").withColumnRenamed("_g", "_s")
    neg, neg0, all_neg = F.col("n") - F.col("pos"), F.col("n0") - F.col("pos0"), F.col("all_n") - F.col("all_pos")
    area = F.sum((neg - neg0) * (F.col("pos") + F.col("pos0")) / 2)
    ranking = curve.join(size, F.col("_g") == F.col("_s")).groupBy("_g", "all_n", "all_pos").agg(
        F.try_divide(area, F.col("all_pos").cast("double") * all_neg).alias("roc_auc"),
        F.max(F.try_divide(F.col("pos"), F.col("all_pos")) - F.try_divide(neg, all_neg)).alias("ks"),
    )
    n_top = F.floor(F.col("all_n") * F.lit(top) / 100)
    inside = F.greatest(F.lit(0), F.least(F.col("n"), n_top - F.col("n_before")))
    taken = rows.join(size, F.col("_g") == F.col("_s")).groupBy("_g").agg(F.max(n_top).alias("n_top"), F.sum(F.least(F.col("pos"), inside)).alias("top_pos"))
    lifted = F.try_divide(F.try_divide(F.col("top_pos"), F.col("n_top")), F.try_divide(F.col("all_pos"), F.col("all_n")))
    return ranking.join(taken, "_g").select(
        F.col("_g").alias(group), F.col("all_n").alias("n"), F.col("all_pos").alias("positives"), "roc_auc", (2 * F.col("roc_auc") - 1).alias("gini_coefficient"),
        F.greatest(F.col("ks"), F.lit(0.0) * F.col("roc_auc")).alias("ks_statistic"), lifted.alias(f"lift_at_{top:g}_percentile"),
    )


def _plain(percentiles: Sequence[float]) -> list[int] | list[float]:
    """All whole or all doubles, so that they make one column."""
    numbers = list(percentiles)
    return [int(p) for p in numbers] if all(float(p).is_integer() for p in numbers) else [float(p) for p in numbers]


def top_rows(
    scored: DataFrame,
    percentiles: Sequence[float],
    key: str = "key",
    label: str = "label",
    score: str = "score",
    curve: DataFrame | None = None,
) -> DataFrame:
    """Size of the top p % of rows by score, its positives, and the totals, per percentile.

    A percentile may be any number; ``floor(n * p / 100)`` rows are the top. Ties at the cut are taken in key order. Only the scores at a cut, at most one per
    percentile, are looked at row by row, and those rows are first reduced to keys.
    """
    curve = curve if curve is not None else score_curve(scored, label, score)
    total = F.col("totals")
    row_count = total["pos"] + total["neg"]
    cuts = F.array(
        *[
            F.struct(F.lit(p).alias("percentile"), F.floor(row_count * F.lit(p) / 100).alias("n_top"))
            for p in _plain(percentiles)
        ]
    )
    before = F.col("pos_before") + F.col("neg_before")
    through = F.col("pos_through") + F.col("neg_through")
    first = before == 0
    # few scores are at a cut: those where the number of tops that fit grows
    ends = F.exists(cuts, lambda c: (c["n_top"] > before) & (c["n_top"] <= through))
    at_cut = curve.where(ends | first).select(
        "score", "pos_before", "pos_through", "totals", before.alias("before"), through.alias("through"),
        F.explode(
            F.filter(
                cuts,
                lambda c: ((c["n_top"] > before) & (c["n_top"] <= through)) | ((c["n_top"] == 0) & first),
            )
        ).alias("cut"),
    ).select(
        "cut.percentile", "cut.n_top", "score", "pos_before", "pos_through", "totals", "through",
        (F.col("cut.n_top") - F.col("before")).alias("need"),
    )
    at_cut = staged(at_cut, "cuts")  # one row per percentile

    split = at_cut.where((F.col("need") > 0) & (F.col("n_top") < F.col("through")))
    needs = split.groupBy("score").agg(F.collect_list(F.struct("percentile", "need")).alias("needs"))
    tied = (
        scored.select(
            F.col(score).cast("double").alias("score"), F.col(key).alias("key"), F.col(label).cast("long").alias("label")
        )
        .where(F.col("label").isNotNull())
        .join(F.broadcast(needs.select("score")), "score", "left_semi")
        .groupBy("score", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    )
    ranked = running_totals(tied, [F.col("key").asc()], ["n", "pos"], ["score"]).join(F.broadcast(needs), "score")
    inside = ranked.select(
        "n_before", "pos", "pos_before",
        F.explode(
            F.filter("needs", lambda x: (x["need"] > F.col("n_before")) & (x["need"] <= F.col("n_through")))
        ).alias("cut"),
    ).select(
        "cut.percentile",
        (F.col("pos_before") + F.least(F.col("pos"), F.col("cut.need") - F.col("n_before"))).alias("tied_pos"),
    )
    return at_cut.join(inside, "percentile", "left").select(
        "percentile",
        "n_top",
        F.when(F.col("need") == 0, F.lit(0))
        .when(F.col("n_top") == F.col("through"), F.col("pos_through"))
        .otherwise(F.col("pos_before") + F.col("tied_pos"))
        .cast("long").alias("top_pos"),
        F.col("totals")["pos"].alias("total_pos"),
        row_count.alias("total_n"),
    )


def lift(
    scored: DataFrame,
    percentiles: Sequence[float] = (10, 20),
    empty_is_zero: bool = False,
    curve: DataFrame | None = None,
    **names: str,
) -> DataFrame:
    """Default rate in the top p % over the overall rate.

    No positives at all gives 0. An empty top gives NULL, or 0 with ``empty_is_zero``
    as in the lift chart.
    """
    tops = top_rows(scored, percentiles, curve=curve, **names)
    rate = F.try_divide(
        F.try_divide(F.col("top_pos").cast("double"), F.col("n_top")),
        F.col("total_pos") / F.col("total_n"),
    )
    empty = F.lit(0.0) if empty_is_zero else F.lit(None).cast("double")
    return tops.select(
        "percentile", "n_top",
        F.when(F.col("total_pos") == 0, F.lit(0.0)).when(F.col("n_top") == 0, empty).otherwise(rate).alias("lift"),
    )


def lift_chart(scored: DataFrame, **names: str) -> DataFrame:
    return lift(scored, range(1, 101), empty_is_zero=True, **names)


def score_histogram(scored: DataFrame, bins: int = 50, label: str = "label", score: str = "score") -> DataFrame:
    """Equal-width histogram per class over that class's own range, empty bins included."""
    rows = scored.select(F.col(label).alias("label"), F.col(score).cast("double").alias("score")).na.drop()
    edges = rows.groupBy("label").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        "label",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    edges = staged(edges, "class-edges")
    counts = (
        # distinct scores first, so neither a hot class nor a hot score fills one task
        rows.groupBy("label", "score").agg(F.count(F.lit(1)).alias("n"))
        .join(edges, "label")
        .withColumn(
            "bin",
            F.least(F.floor((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"), F.lit(bins - 1)),
        )
        .groupBy("label", "bin").agg(F.sum("n").alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["label", "bin"], "left").select(
        "label", "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_from"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def confusion(rows: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)

    def cell(truth: int, said: int) -> Column:
        return F.count_if((y == truth) & (p == said))

    return rows.agg(
        cell(0, 0).alias("true_negatives"), cell(0, 1).alias("false_positives"),
        cell(1, 0).alias("false_negatives"), cell(1, 1).alias("true_positives"),
    )


def binary_rates(cells: DataFrame, *keep: str) -> DataFrame:
    """Precision, recall and F1 of class 1 from the confusion cells; 0/0 is 0."""
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    return cells.select(
        *keep, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def business_metrics(
    rows: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    fp_cost: int = fv.FALSE_POSITIVE_COST,
    fn_cost: int = fv.FALSE_NEGATIVE_COST,
) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return rows.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.avg(y).alias("default_rate"),
        F.avg(p).alias("approval_rate"),
        (F.count_if((y == 0) & (p == 1)) * fp_cost + F.count_if((y == 1) & (p == 0)) * fn_cost).alias("total_cost"),
    )


def class_report(rows: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    cells = rows.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        "n", (F.col("y") == F.col("p")).alias("hit"),
        F.explode(F.array(F.struct(F.col("y").alias("class"), F.lit(1).alias("truth")),
                          F.struct(F.col("p").alias("class"), F.lit(0).alias("truth")))).alias("s"),
    ).select("n", "hit", "s.class", "s.truth")
    per_class = sides.groupBy("class").agg(
        F.coalesce(F.sum(F.when(F.col("hit") & (F.col("truth") == 1), F.col("n"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(F.col("truth") == 1, F.col("n"))), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(F.col("truth") == 0, F.col("n"))), F.lit(0)).alias("predicted"),
    )
    return per_class.select(
        "class", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support", "predicted", "tp",
    )


def averaged_metrics(report: DataFrame) -> DataFrame:
    """Accuracy, weighted precision / recall / F1 and macro F1 from a class report."""
    weight = F.sum("support")

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * F.col("support")), weight)

    return report.agg(
        F.try_divide(F.sum("tp").cast("double"), weight).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        F.avg("f1_score").alias("macro_f1"),
        weighted("f1_score").alias("weighted_f1"),
        weight.alias("total_samples"),
    )


def f1_by_class(report: DataFrame, grades: Mapping | None = None) -> DataFrame:
    """F1 per class, named by the decoded grade; an index without a grade is ``Unknown_<index>``."""
    name = F.col("class").cast("string")
    if grades is not None:
        known = F.create_map(*[F.lit(x) for i, g in grades.items() for x in (str(i), g)])
        name = F.coalesce(F.try_element_at(known, name), F.concat(F.lit("Unknown_"), name))
    return report.select(name.alias("grade"), F.col("f1_score"))


def distribution(rows: DataFrame, column: str = "prediction") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def as_map(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Few rows (one per class) to one key-sorted map."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))))
    return df.agg(F.map_from_entries(pairs).alias(name))


def loan_default_report(
    scored: DataFrame, threshold: float = 0.5, key: str = "key", label: str = "label", score: str = "score",
    prediction: str | None = None,
) -> DataFrame:
    """The full metric row of a binary default model.

    Without an own prediction column the confusion cells follow from the score
    table, so the rows are read once for it and once for ties at the lift cuts. Rows without
    a label or score take no part; ``unscored_loans`` counts them.
    """
    curve = staged(score_curve(scored, label, score), "curve")
    said = F.col("score") >= threshold
    cells = _rates(curve).agg(
        *_ranking_columns(),
        *[
            F.coalesce(F.sum(F.when(cond, F.col(side))), F.lit(0)).alias(name)
            for name, cond, side in (
                ("true_negatives", ~said, "neg"), ("false_positives", said, "neg"),
                ("false_negatives", ~said, "pos"), ("true_positives", said, "pos"),
            )
        ],
    )
    if prediction is not None:
        own = confusion(scored, label, prediction).withColumnsRenamed({c: f"_{c}" for c in CELLS})
        cells = cells.drop(*CELLS).withColumn("_c", own.select(F.struct("*").alias("s")).scalar()).select("*", *[F.col(f"_c._{c}").alias(c) for c in CELLS]).drop("_c")
    tn, fp, fn, tp = (
        F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")
    )
    lifts = lift(scored, (10, 20), curve=curve, key=key, label=label, score=score)
    lift_row = lifts.agg(*[
        F.max(F.when(F.col("percentile") == p, F.col("lift"))).alias(f"lift_at_{p}_percentile") for p in (10, 20)
    ])

    def one(frame: DataFrame) -> Column:
        return frame.select(F.struct("*").alias("s")).scalar()

    unscored = scored.agg(F.count_if(F.col(label).isNull() | F.col(score).isNull()).alias("n"))
    row = cells.withColumns({"_l": one(lift_row), "_u": one(unscored)})
    rates = binary_rates(row, "*")
    total = tn + fp + fn + tp
    return rates.select(
        "precision", "recall", "f1_score", "roc_auc", "pr_auc", "ks_statistic", "gini_coefficient",
        "_l.lift_at_10_percentile", "_l.lift_at_20_percentile",
        "true_negatives", "false_positives", "false_negatives", "true_positives",
        total.alias("total_loans"), ((tp + fn) / total).alias("default_rate"), ((tp + fp) / total).alias("approval_rate"),
        (fp * fv.FALSE_POSITIVE_COST + fn * fv.FALSE_NEGATIVE_COST).alias("total_cost"),
        F.lit(float(threshold)).alias("threshold"), F.col("_u.n").alias("unscored_loans"),
    )


def macro_f1_by_group(rows: DataFrame, group: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(group, n, macro_f1): the mean F1 over the classes that a group's labels or predictions hold; rows without a label are left out."""
    cells = rows.where(F.col(label).isNotNull()).groupBy(*group, F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("n")).otherwise(0)
    sides = cells.select(*group, F.explode(F.array(
        F.struct(F.col("_l").alias("c"), F.col("n").alias("seen"), hit.alias("hit")),
        F.struct(F.col("_p").alias("c"), F.col("n").alias("seen"), F.lit(0).cast("long").alias("hit")),
    )).alias("s")).where(F.col("s.c").isNotNull())
    each = sides.groupBy(*group, "s.c").agg((2 * F.sum("s.hit") / F.sum("s.seen")).alias("f1"))
    n = cells.groupBy(*group).agg(F.sum("n").alias("n"))
    return n.join(each.groupBy(*group).agg(F.avg("f1").alias("macro_f1")), list(group))


def one_vs_rest_auc(rows: DataFrame, label: str = "label", scores: str = "scores") -> DataFrame:
    """(class, roc_auc) for rows with a class number and the array of class probabilities.

    Each class against all others, ties exact; NULL for a class that has no rows or all of them.
    The mean over the classes is the macro one-vs-rest AUC.
    """
    each = rows.where(F.col(label).isNotNull() & F.col(scores).isNotNull()).select(
        F.col(label).cast("int").alias("label"), F.posexplode(scores).alias("class", "score")
    )
    hit = (F.col("label") == F.col("class")).cast("long")
    counts = each.groupBy("class", F.col("score").cast("double").alias("score")).agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    curve = running_totals(counts, [F.col("score").desc()], ["pos", "neg"], ["class"])
    area = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos_through")) / 2)
    return curve.groupBy("class").agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def monthly_report(
    rows: DataFrame, label: str = "label", prediction: str = "prediction", score: str | None = "score"
) -> DataFrame:
    """One metric row: averages, AUC when there is a score, F1 per class and prediction counts.

    ``score`` is the probability of class 1, or the array of the probabilities of all classes; more than two of them
    give the mean one-vs-rest AUC. The two maps have an entry per class.
    """
    report = staged(class_report(rows, label, prediction), "classes")
    out = averaged_metrics(report)
    if score is None:
        auc = F.lit(None).cast("double")
    elif isinstance(rows.schema[score].dataType, ArrayType):
        # classes that never occur have no AUC and make the mean undefined, as it is for a single class
        each = one_vs_rest_auc(rows, label, score)
        auc = each.agg(F.when(F.count_if(F.col("roc_auc").isNull()) == 0, F.avg("roc_auc")).alias("auc")).scalar()
    else:
        auc = ranking_metrics(rows, label, score).select("roc_auc").scalar()
    return out.select(
        "accuracy", "precision", "recall", "macro_f1", "weighted_f1", auc.alias("auc"), "total_samples",
        as_map(report.where("support > 0 or predicted > 0"), "class", "f1_score", "m").scalar().alias("f1_by_grade"),
        as_map(report.where("predicted > 0"), "class", "predicted", "m").scalar().alias("predictions_distribution"),
    )
