"""Label and feature stores, feature preparation, training, scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark import fixed_values as fv
from tidemark.operators import boosting, evaluation, features as feats, models, registry as runs
from tidemark.plans import bronze, gold, lifecycle, silver
from tidemark.session import scratch_path, staged
from tidemark.sources import snapshots
from tidemark.suite import cleaning, views
from tidemark.suite.registry import query, r6
from tidemark.suite.views import sql, table


# --- stores ------------------------------------------------------------------
@query("m04_label_rates", sql(
    """SELECT snapshot_date, label_def, count(*) AS loans, CAST(sum(label) AS BIGINT) AS defaults, round(avg(label), 6) AS default_rate
    FROM label_store GROUP BY 1, 2""", "label_store"))
def _(spark, sf):
    return gold.label_store(views.lms(spark, sf)).groupBy("snapshot_date", "label_def").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("label").alias("defaults"), r6(F.avg("label")).alias("default_rate")
    )


@query("m04_label_store", sql("SELECT * FROM label_store", "label_store"))
def _(spark, sf):
    return gold.label_store(views.lms(spark, sf))


def _main_store(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.raw_financials(spark, sf)
    return gold.feature_store_main(
        silver.attributes_main(views.raw_attributes(spark, sf)), silver.financials_main(raw, clip_method="exact"),
        silver.loan_types(raw), silver.clickstream_main(views.raw_clicks(spark, sf)), views.lms(spark, sf),
    )


_OCCUPATIONS = ("automobile", "building", "furniture", "household")
#: columns of the main store by what becomes of them; every one is compared
_KEYS = ("loan_id", "customer_id", "snapshot_date", "loan_start_date", "first_missed_date")
_WHOLE = ("tenure", "installment_num", "mob", "installments_missed", "dpd", "age", "delay_from_due_date", "credit_history_age_month", *cleaning.TYPE_COLUMNS)
_DECIMAL = ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance", *cleaning.FLOATS, *fv.CLIPPED)
_ENCODED = {"occupation": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"), "payment_of_min_amount": ("Yes", "No", "NM"), "credit_mix": ("Good", "Bad", "Standard"),
            "payment_behaviour_spent": ("High", "Low"), "payment_behaviour_value": ("Small", "Medium", "Large")}
_JOINED = """SELECT l.*, a.age, a.occupation, f.* EXCLUDE (customer_id, snapshot_date, credit_history_age, credit_history_age_year, credit_history_age_month),
    f.credit_history_age_year * 12 + f.credit_history_age_month AS credit_history_age_month, t.* EXCLUDE (customer_id)
    FROM (SELECT * FROM lms WHERE mob = 6) l LEFT JOIN attr a ON l.customer_id = a.customer_id LEFT JOIN fin f ON l.customer_id = f.customer_id LEFT JOIN types t ON l.customer_id = t.customer_id"""
_MAIN_SQL = (
    "SELECT " + ", ".join(f"j.{c}" for c in _KEYS) + ", "
    + ", ".join(f'CAST(coalesce("{c}", trunc(avg("{c}") OVER ())) AS INTEGER) AS "{c}"' for c in _WHOLE) + ", "
    + ", ".join(f"round(CAST(CAST(coalesce({c}, avg(CAST({c} AS DOUBLE)) OVER ()) AS {'DOUBLE' if c in fv.CLIPPED else 'FLOAT'}) AS DOUBLE), 2) AS {c}" for c in _DECIMAL) + ", "
    + ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v.lower()}" for c, vs in _ENCODED.items() for v in vs) + ", "
    + ", ".join(f"round({c}, 2) AS avg_{c}" for c in fv.CLICK_FEATURES)
    + " FROM joined j LEFT JOIN (SELECT customer_id AS k, " + ", ".join(f"avg({c}) AS {c}" for c in fv.CLICK_FEATURES)
    + " FROM raw_click GROUP BY customer_id, snapshot_date) c ON j.customer_id = c.k"
)


def _rounded(df: DataFrame) -> DataFrame:
    """All columns, fractions to two places."""
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), 2).alias(c) if kind in ("float", "double") else F.col(f"`{c}`") for c, kind in df.dtypes])


@query("m05_feature_store_main", sql(_MAIN_SQL, "lms", "raw_attr", "raw_fin", "raw_click", n=cleaning.CLEAN, attr=cleaning.MAIN_ATTRIBUTES, fin=cleaning.MAIN_FIN,
       names=cleaning.NAMES, types=cleaning.LOAN_TYPES, joined=_JOINED))
def _(spark, sf):
    """Every column of the wide, imputed and encoded store."""
    return _rounded(_main_store(spark, sf))


@query("m06_feature_store_retrofit", sql(
    """SELECT l.loan_id, a.* EXCLUDE (customer_id, snapshot_date, occupation), f.* EXCLUDE (customer_id, snapshot_date, credit_mix, payment_behaviour) REPLACE ("""
    + ", ".join(f"round(CAST(f.{c} AS DOUBLE), 2) AS {c}" for c in ("annual_income", *fv.RETROFIT_FLOATS)) + """), c.* EXCLUDE (customer_id, snapshot_date)
    FROM (SELECT loan_id, customer_id FROM lms WHERE mob = 6) l LEFT JOIN attr a ON l.customer_id = a.customer_id LEFT JOIN fin f ON l.customer_id = f.customer_id
    LEFT JOIN raw_click c ON l.customer_id = c.customer_id""", "lms", "raw_attr", "raw_fin", "raw_click", attr=cleaning.RETROFIT_ATTRIBUTES, fin=cleaning.RETROFIT_FIN))
def _(spark, sf):
    """Every column of the store without imputation; a customer's click rows multiply their loans."""
    return _rounded(gold.feature_store_retrofit(
        silver.attributes_retrofit(views.raw_attributes(spark, sf)), silver.financials_retrofit(views.raw_financials(spark, sf)),
        silver.clickstream_retrofit(views.raw_clicks(spark, sf)), views.lms(spark, sf),
    ))


@query("m06_features_by_loan", sql(
    """SELECT l.loan_id, count(*) AS n, CAST(sum(c.fe_1) AS BIGINT) AS fe_1, max(CAST(f.total_emi_per_month AS INTEGER)) AS emi,
    max(CASE WHEN contains(f.type_of_loan, 'Auto Loan') THEN 1 ELSE 0 END) AS auto_loan FROM lms l LEFT JOIN raw_fin f ON l.customer_id = f.customer_id
    LEFT JOIN raw_click c ON l.customer_id = c.customer_id WHERE l.mob = 6 GROUP BY l.loan_id""", "lms", "raw_fin", "raw_click"))
def _(spark, sf):
    wide = gold.feature_store_retrofit(
        silver.attributes_retrofit(views.raw_attributes(spark, sf)), silver.financials_retrofit(views.raw_financials(spark, sf)),
        silver.clickstream_retrofit(views.raw_clicks(spark, sf)), views.lms(spark, sf),
    )
    return wide.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fe_1").alias("fe_1"), F.max(F.col("total_emi_per_month").cast("int")).alias("emi"),
        F.max("auto_loan").alias("auto_loan"),
    )


_FLOW_DAYS = ("1997-07-01", "1997-08-01")
_FLOW_SUMS = """CAST(sum(age) AS BIGINT) AS ages, CAST(sum(auto_loan) AS BIGINT) AS autos, count(fe_1) AS clicked, round(CAST(sum(fe_1) AS DOUBLE), 2) AS clicks"""
_FLOW = f"""SELECT 'main' AS variant, snapshot_date, loans, defaults, feature_rows, filled, total, ages, autos, clicked, clicks FROM labels JOIN (
    SELECT snapshot_date, count(*) AS feature_rows, count(mob) AS filled, CAST(sum(mob) AS BIGINT) AS total, {_FLOW_SUMS} FROM main_store GROUP BY 1) USING (snapshot_date)
    UNION ALL SELECT 'retrofit', snapshot_date, loans, defaults, feature_rows, filled, total, ages, autos, clicked, clicks FROM labels JOIN (
    SELECT snapshot_date, count(*) AS feature_rows, count(auto_loan) AS filled, CAST(sum(auto_loan) AS BIGINT) AS total, {_FLOW_SUMS} FROM retrofit_store GROUP BY 1) USING (snapshot_date)"""
_FLOW_VIEWS = {
    "names": cleaning.NAMES, "types": cleaning.LOAN_TYPES, "main_attr": cleaning.MAIN_ATTRIBUTES, "retrofit_attr": cleaning.RETROFIT_ATTRIBUTES,
    "loans": f"SELECT * FROM lms WHERE mob = 6 AND snapshot_date IN (DATE '{_FLOW_DAYS[0]}', DATE '{_FLOW_DAYS[1]}')",
    "clicks": f"SELECT * REPLACE (CASE WHEN fe_1 % 2 = 1 THEN DATE '{_FLOW_DAYS[1]}' ELSE DATE '{_FLOW_DAYS[0]}' END AS snapshot_date) FROM raw_click",
    "labels": "SELECT snapshot_date, count(*) AS loans, CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS defaults FROM loans GROUP BY 1",
    "joined": """SELECT l.customer_id, l.snapshot_date, l.mob, a.age, t.auto_loan FROM loans l LEFT JOIN main_attr a ON l.customer_id = a.customer_id
        LEFT JOIN raw_fin f ON l.customer_id = f.customer_id LEFT JOIN types t ON l.customer_id = t.customer_id""",
    "main_store": """SELECT j.snapshot_date, j.mob, c.fe_1, CAST(coalesce(j.age, trunc(avg(j.age) OVER w)) AS INTEGER) AS age,
        CAST(coalesce(j.auto_loan, trunc(avg(j.auto_loan) OVER w)) AS INTEGER) AS auto_loan FROM joined j
        LEFT JOIN (SELECT customer_id, snapshot_date, avg(fe_1) AS fe_1 FROM clicks GROUP BY ALL) c ON j.customer_id = c.customer_id AND j.snapshot_date = c.snapshot_date
        WINDOW w AS (PARTITION BY j.snapshot_date)""",
    "retrofit_store": """SELECT l.snapshot_date, a.age, c.fe_1, CASE WHEN contains(f.type_of_loan, 'Auto Loan') THEN 1 WHEN f.type_of_loan IS NOT NULL THEN 0 END AS auto_loan
        FROM loans l LEFT JOIN retrofit_attr a ON l.customer_id = a.customer_id LEFT JOIN raw_fin f ON l.customer_id = f.customer_id
        LEFT JOIN clicks c ON l.customer_id = c.customer_id AND l.snapshot_date = c.snapshot_date""",
}


@query("m05_bronze_to_gold", sql(_FLOW, "lms", "raw_attr", "raw_fin", "raw_click", **_FLOW_VIEWS))
def _(spark, sf):
    """Two months of all tables from bronze through silver to both gold tables, in both variants.

    The tables have no clicks in any month with loans, so every click is dated to one of the two months, by its first feature.
    """
    root = scratch_path(spark, "flow")
    first, second = (F.lit(d).cast("date") for d in _FLOW_DAYS)
    bronze.ingest_all(views.raw_lms(spark, sf).where(F.col("snapshot_date").isin(first, second)), f"{root}/bronze/lms")
    clicks = views.raw_clicks(spark, sf).withColumn("snapshot_date", F.when(F.col("fe_1") % 2 == 1, second).otherwise(first))
    bronze.ingest_all(clicks, f"{root}/bronze/clickstream")
    bronze.ingest_static(views.raw_attributes(spark, sf), f"{root}/bronze/attributes")
    bronze.ingest_static(views.raw_financials(spark, sf), f"{root}/bronze/financials")
    out = None
    for variant, column, click in (("main", "mob", "avg_fe_1"), ("retrofit", "auto_loan", "fe_1")):
        here = f"{root}/{variant}"
        for day in _FLOW_DAYS:
            for name in gold.NEEDED:
                silver.write_silver(spark, f"{root}/bronze", f"{here}/silver", name, day, variant)
            gold.write_gold(spark, f"{here}/silver", f"{here}/gold", day, variant)
        labels = snapshots.read_table(spark, f"{here}/gold/label_store").groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("loans"), F.sum("label").alias("defaults")
        )
        features = snapshots.read_table(spark, f"{here}/gold/feature_store").groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("feature_rows"), F.count(column).alias("filled"), F.sum(F.col(column).cast("long")).alias("total"),
            F.sum(F.col("age").cast("long")).alias("ages"), F.sum(F.col("auto_loan").cast("long")).alias("autos"),
            F.count(click).alias("clicked"), F.round(F.sum(click).cast("double"), 2).alias("clicks"),
        )
        part = labels.join(features, "snapshot_date").select(F.lit(variant).alias("variant"), "snapshot_date", *labels.columns[1:], *features.columns[1:])
        out = part if out is None else out.unionByName(part)
    return out


# --- preparation -------------------------------------------------------------
@query("m01_mean_imputation", sql(
    """SELECT customer_id, CAST(coalesce(fe_2, (SELECT trunc(avg(fe_2)) FROM raw_click)) AS INTEGER) AS fe_2,
    CAST(coalesce(fe_3, (SELECT trunc(avg(fe_3)) FROM raw_click)) AS INTEGER) AS fe_3, CAST(NULL AS DOUBLE) AS never FROM raw_click""", "raw_click"))
def _(spark, sf):
    df = views.raw_clicks(spark, sf).select("customer_id", "fe_2", "fe_3", F.lit(None).cast("double").alias("never"))
    return feats.impute_means(df)


@query("m02_one_hot", sql(
    "SELECT customer_id, " + ", ".join(f"CASE WHEN lower(nullif(occupation, '_______')) = '{o}' THEN 1 ELSE 0 END AS occupation_{o}" for o in _OCCUPATIONS)
    + " FROM raw_attr", "raw_attr"))
def _(spark, sf):
    df = silver.attributes_main(views.raw_attributes(spark, sf)).select("customer_id", "occupation")
    return feats.one_hot(df, feats.category_labels(df, ["occupation"]))


_FIN_LABELS = {"credit_mix": ("Good", "Bad", "Standard"), "payment_of_min_amount": ("Yes", "No", "NM"),
               "payment_behaviour_spent": ("High", "Low"), "payment_behaviour_value": ("Small", "Medium", "Large")}
_FIN_COLUMNS = """SELECT customer_id, nullif(credit_mix, '_') AS credit_mix, payment_of_min_amount,
    nullif(regexp_extract(payment_behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 1), '') AS payment_behaviour_spent,
    nullif(regexp_extract(payment_behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 2), '') AS payment_behaviour_value FROM raw_fin"""


@query("m03_one_hot_all", sql(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v.lower()}" for c, vs in _FIN_LABELS.items() for v in vs) + " FROM cats",
    "raw_fin", cats=_FIN_COLUMNS))
def _(spark, sf):
    df = silver.financials_main(views.raw_financials(spark, sf)).select("customer_id", *_FIN_LABELS)
    return feats.one_hot(df, feats.category_labels(df, list(_FIN_LABELS)))


_BUCKET = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % {}"


@query("m09_split_by_key", f"""SELECT o_orderkey, CASE WHEN {_BUCKET.format("CAST(o_orderkey AS VARCHAR)", 100)} < 80 THEN 'train' ELSE 'test' END AS part FROM orders""")
def _(spark, sf):
    return feats.split_by_key(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("m09_split_by_text_key", sql(
    f"SELECT loan_id, CASE WHEN {_BUCKET.format('loan_id', 100)} < 80 THEN 'train' ELSE 'test' END AS part FROM lms", "lms"))
def _(spark, sf):
    return feats.split_by_key(views.lms(spark, sf).select("loan_id"), "loan_id")


@query("m10_stratified_split", """SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM
    (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_orderkey * 7919) % 1000003, o_orderkey) AS rn,
    count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    order = [F.col("o_orderkey") * 7919 % 1000003, F.col("o_orderkey")]
    return feats.stratified_split(orders, "o_orderkey", "o_orderpriority", 0.8, order)


_SAMPLED = _BUCKET.format("'42:' || CAST(o_orderkey AS VARCHAR)", feats.SAMPLE_PARTS)


@query("m10_tuning_sample", f"""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN {tuple(views.LOAN_NAMES)} AND {_SAMPLED} < {feats.SAMPLE_PARTS // 10}""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return feats.stratified_sample(orders, "o_orderpriority", {p: 0.1 for p in views.LOAN_NAMES}, "o_orderkey")


@query("m11_random_sample", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_SAMPLED} < {feats.SAMPLE_PARTS // 10}")
def _(spark, sf):
    return feats.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 0.1, 42)


# --- training and scoring ----------------------------------------------------
#: labelled rows that a fit reads at most, drawn by a hash of the key; scoring covers all rows
FIT_ROWS = 5_000
_MODEL_FEATURES = ("tenure", "loan_amt", "due_amt", "balance", "mob", "paid_amt")
#: with the days past due, which decide the label, what a good learner predicts is known for every row
_TELLING = (*_MODEL_FEATURES, "dpd")
_DUE = f"CASE WHEN dpd >= {fv.LABEL_DPD} THEN 1 ELSE 0 END"


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    lms = views.lms(spark, sf)
    label = F.when(F.col("dpd") >= fv.LABEL_DPD, 1).otherwise(0).alias("label")
    return lms.select("loan_id", "customer_id", "snapshot_date", *_TELLING, label)


def _fit_rows(rows: DataFrame, key: str = "loan_id") -> DataFrame:
    return staged(feats.sample_rows(rows, key, min(1.0, FIT_ROWS / max(1, rows.count()))), "fit")


def _drawn_sql(key: str, view: str) -> str:
    """The rows of ``view`` that a fit reads."""
    hashed = _BUCKET.format(f"'42:' || {key}", feats.SAMPLE_PARTS)
    return f"SELECT * FROM {view} WHERE {hashed} < round(least(1.0, {FIT_ROWS}::DOUBLE / (SELECT count(*) FROM {view})) * {feats.SAMPLE_PARTS})"


_SCORED = sql(f"SELECT loan_id, {_DUE} AS prediction, true AS score_in_range FROM lms", "lms")


def _checked(model, rows: DataFrame) -> DataFrame:
    """Every row scored, the rows that no fit has seen included."""
    scored = models.score_rows(model, rows, _TELLING, ["loan_id"])
    return scored.select("loan_id", "prediction", F.col("score").between(0, 1).alias("score_in_range"))


@query("m12_boosted_trees", _SCORED)
def _(spark, sf):
    rows = _training_rows(spark, sf)
    return _checked(models.train_boosted(_fit_rows(rows), _TELLING), rows)


def _held_out():
    return feats.hash_bucket(F.col("loan_id"), 5) == 0


@query("m13_boosted_early_stop", _SCORED)
def _(spark, sf):
    rows = _training_rows(spark, sf)
    return _checked(models.train_boosted_early_stop(_fit_rows(rows), _TELLING, _held_out()), rows)


@query("m13_stopped_growth", sql(
    f"""SELECT count(*) AS fit_rows, count(*) FILTER (held) AS held_rows, CAST(sum(label) FILTER (held) AS BIGINT) AS held_positives,
    true AS ended_in_time, true AS cut_at_best, true AS loss_agrees
    FROM (SELECT *, {_BUCKET.format('loan_id', 5)} = 0 AS held, {_DUE} AS label FROM drawn)""", "lms", drawn=_drawn_sql("loan_id", "lms")))
def _(spark, sf):
    """Without the days past due the validation loss turns: growth ends 30 rounds after its lowest point, which is the loss of the model returned."""
    rows = _fit_rows(_training_rows(spark, sf))
    model = models.train_boosted_early_stop(rows, _MODEL_FEATURES, _held_out(), learning_rate=0.3, n_estimators=400)
    best = min(range(len(model.losses)), key=model.losses.__getitem__) + 1
    scored = models.score_rows(model, rows.where(_held_out()), _MODEL_FEATURES, ["label"])
    loss = F.avg(-F.log(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))))
    facts = rows.agg(
        F.count(F.lit(1)).alias("fit_rows"), F.count_if(_held_out()).alias("held_rows"), F.sum(F.when(_held_out(), F.col("label"))).alias("held_positives")
    )
    return facts.select(
        "*", F.lit(model.fitted_rounds == best + models.PATIENCE < 400).alias("ended_in_time"), F.lit(len(model.rounds) == best).alias("cut_at_best"),
        (F.abs(scored.agg(loss.alias("l")).scalar() - F.lit(model.losses[best - 1])) < 1e-6).alias("loss_agrees"),
    )


@query("m13_first_round", sql(
    f"""SELECT loan_id, round(1 / (1 + exp(-(prior + CASE WHEN v <= cut THEN 0.1 * gl / (hl + 1) ELSE 0.1 * (g - gl) / (h - hl + 1) END))), 4) AS score
    FROM (SELECT loan_id, mob AS v FROM lms), best, total""", "lms", drawn=_drawn_sql("loan_id", "lms"),
    total=f"""SELECT ln((p + 0.5) / (n - p + 0.5)) AS prior, 1 / (1 + exp(-prior)) AS share, p - n * share AS g, n * share * (1 - share) AS h
        FROM (SELECT count(*)::DOUBLE AS n, sum({_DUE})::DOUBLE AS p FROM drawn)""",
    cuts=f"""SELECT mob AS cut, sum(count(*)) OVER w AS n, sum(sum({_DUE})) OVER w AS p FROM drawn GROUP BY mob WINDOW w AS (ORDER BY mob)""",
    best="""SELECT cut, p - n * share AS gl, n * share * (1 - share) AS hl FROM cuts, total WHERE h - n * share * (1 - share) >= 1 AND n * share * (1 - share) >= 1
        ORDER BY power(p - n * share, 2) / (n * share * (1 - share) + 1) + power(g - p + n * share, 2) / (h - n * share * (1 - share) + 1) DESC, cut LIMIT 1"""))
def _(spark, sf):
    """One round of one split: prior, histogram, gain, leaf values and scores can all be written out."""
    rows = _training_rows(spark, sf)
    model = models.train_boosted(_fit_rows(rows), ["mob"], n_estimators=1, max_depth=1, subsample=1.0, colsample=1.0)
    return models.score_rows(model, rows, ["mob"], ["loan_id"]).select("loan_id", F.round("score", 4).alias("score"))


@query("m14_tuned_boosted", _SCORED)
def _(spark, sf):
    """20 draws of 100 to 1000 rounds, each fitted and measured on all labelled rows; the best one's settings fitted on them once more."""
    rows = staged(_training_rows(spark, sf), "fit")
    return _checked(models.tune_boosted(rows, _TELLING).model, rows)


@query("m14_trials", sql(
    f"""SELECT trial::INTEGER AS trial, n, positives, true AS in_range, true AS ended_in_time, true AS auc_agrees, true AS loss_agrees FROM
    (SELECT unnest(range(20)) AS trial), (SELECT sum(n - floor(n * 0.8))::BIGINT AS n, sum(label * (n - floor(n * 0.8)))::BIGINT AS positives
        FROM (SELECT {_DUE} AS label, count(*) AS n FROM lms GROUP BY 1))""", "lms"))
def _(spark, sf):
    """The stored trials over all labelled rows: each measured on a fifth of every class, its growth ended in time, and its AUC the share of pairs in order."""
    found = models.tune_boosted(staged(_training_rows(spark, sf), "fit"), _MODEL_FEATURES)
    ranges, best = models.SEARCH_RANGES, found.trials
    # the area once more, as the share of (positive, negative) pairs in order, from the ranks of the stored predictions
    rank = F.avg("r").over(Window.partitionBy("trial", "score"))
    ranked = found.scored.withColumn("r", F.row_number().over(Window.partitionBy("trial").orderBy("score"))).withColumn("r", rank)
    pos = F.sum("label")
    pairs = (F.sum(F.col("label") * F.col("r")) - pos * (pos + 1) / 2) / (pos * (F.count(F.lit(1)) - pos))
    again = ranked.groupBy("trial").agg(pairs.alias("pairs"))
    rounds = F.col("n_estimators").between(*ranges["n_estimators"][:2]) & (F.col("n_estimators") % ranges["n_estimators"][2] == 0)
    drawn = rounds & F.col("max_depth").between(*ranges["max_depth"]) & F.col("subsample").between(*ranges["subsample"]) & F.col("colsample").between(*ranges["colsample"])
    stopped = F.col("fitted_rounds") == F.least(F.col("n_estimators"), F.col("rounds") + models.PATIENCE)
    return best.join(again, "trial").select(
        "trial", "n", "positives", drawn.alias("in_range"), stopped.alias("ended_in_time"), (F.abs(F.col("pairs") - F.col("roc_auc")) < 1e-9).alias("auc_agrees"),
        (F.abs(F.col("loss") + F.col("pairs") - 1) < 1e-9).alias("loss_agrees"),
    )


_GRADE = "CAST(floor((l_quantity - 1) / 8) AS INTEGER)"
_GRADE_FEATURES = ["l_quantity", "l_extendedprice", "l_tax", "l_discount", "day"]


def _grade_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with one of seven grades, by quantity."""
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_discount", F.unix_date(F.col("l_shipdate").cast("date")).alias("day"),
        F.floor((F.col("l_quantity") - 1) / 8).cast("int").alias("label"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
    )


def _search_grades(rows: DataFrame, sample_share: float = 1.0) -> models.Search:
    return models.tune_multiclass(rows, _GRADE_FEATURES, 7, key="key", sample_share=sample_share)


@query("m15_multiclass_search", f"SELECT l_orderkey, l_linenumber, {_GRADE} AS grade FROM lineitem")
def _(spark, sf):
    rows = _grade_rows(spark, sf)
    said = boosting.score_many([_search_grades(rows).model], rows, ["l_orderkey", "l_linenumber"])
    return said.select("l_orderkey", "l_linenumber", (F.array_position("scores", F.array_max("scores")) - 1).cast("int").alias("grade"))


@query("m15_multiclass_report", f"""SELECT count(*) AS total_samples, CAST(1 AS DOUBLE) AS macro_f1, CAST(1 AS DOUBLE) AS auc, count(DISTINCT {_GRADE}) AS classes,
    true AS shares_add_up FROM lineitem""")
def _(spark, sf):
    """The month's metric row over the stored probabilities: macro F1, and the mean one-vs-rest AUC of the seven grades."""
    rows = _grade_rows(spark, sf)
    model = _search_grades(rows).model
    said = staged(boosting.score_many([model], rows, ["label"]).withColumn("prediction", (F.array_position("scores", F.array_max("scores")) - 1).cast("int")), "grades")
    report = evaluation.monthly_report(said, score="scores")
    off = F.abs(F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9
    return report.select(
        F.col("total_samples").cast("long").alias("total_samples"), r6("macro_f1").alias("macro_f1"), r6("auc").alias("auc"),
        F.size("f1_by_grade").cast("long").alias("classes"), (said.agg(F.count_if(off).alias("n")).scalar() == 0).alias("shares_add_up"),
    )


@query("m15_trials", f"""SELECT trial::INTEGER AS trial, n AS rows, CAST(1 AS DOUBLE) AS macro_f1 FROM (SELECT unnest(range(5)) AS trial),
    (SELECT count(*) AS n FROM ({_drawn_sql("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", "lineitem")})
    WHERE {_BUCKET.format("'42:' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", feats.SAMPLE_PARTS)} < {feats.SAMPLE_PARTS * 4 // 10})""")
def _(spark, sf):
    """Every draw of the grid predicts each fold of the tuning sample from the two others."""
    return _search_grades(_fit_rows(_grade_rows(spark, sf), "key"), 0.4).trials.select("trial", "rows", r6("macro_f1").alias("macro_f1"))


_MONTH_ROWS = f"""SELECT loan_id, customer_id, snapshot_date, 'credit_scoring_model' AS model_name, '1' AS model_version, 'run-1' AS mlflow_run_id,
    '1998_03_01' AS month_partition, 'monthly_inference' AS execution_context, {_DUE} AS predicted_default FROM lms WHERE snapshot_date = DATE '1998-03-01'"""


def _month(spark: SparkSession, sf: str, model, features) -> DataFrame:
    rows = _training_rows(spark, sf).where("snapshot_date = date '1998-03-01'")
    inference, _metrics = lifecycle.monthly_inference(model, rows, features, "1998_03_01", "1", "run-1")
    return inference.drop("inference_date", "default_probability")


@query("m16_monthly_inference", sql(_MONTH_ROWS, "lms"))
def _(spark, sf):
    model = models.train_boosted(_fit_rows(_training_rows(spark, sf)), _TELLING)
    return _month(spark, sf, model, _TELLING)


@query("m16_inference_after_drift", sql(_MONTH_ROWS, "lms"))
def _(spark, sf):
    """Trained with an indicator column that the scored month does not have."""
    rows = _fit_rows(_training_rows(spark, sf)).withColumn("loan_type_auto", (F.col("loan_amt") > 30_000).cast("int"))
    features = [*_TELLING, "loan_type_auto"]
    return _month(spark, sf, models.train_boosted(rows, features), features)


@query("m17_champion_version", """SELECT 'credit_scoring_model' AS name, v AS version, 'Production' AS stage, 'catboost-42' AS run_id, 'CatBoost' AS model_type,
    '1998-03-01' AS last_retraining_date, v AS model_version, CAST(1 AS DOUBLE) AS macro_f1_score FROM (SELECT CAST(max(o_orderkey) + 1 AS VARCHAR) AS v FROM orders)""")
def _(spark, sf):
    """Both families tell all defaults apart, so the first one is not strictly better; the champion's version beside its tracker row."""
    _fitted, scores = lifecycle.train_candidates(_fit_rows(_training_rows(spark, sf)), _TELLING)
    champion = staged(runs.choose_champion(scores, "auc"), "champion")
    versions = table(spark, sf, "orders").select(
        F.lit("credit_scoring_model").alias("name"), F.col("o_orderkey").cast("string").alias("version"), F.lit("Archived").alias("stage"),
        F.col("o_orderkey").cast("string").alias("run_id"),
    )
    made = staged(runs.next_version(versions, "credit_scoring_model", champion), "version")
    tracker = runs.tracker_row(champion, made.select("version").scalar(), F.lit("1998-03-01").cast("date"), "auc", "credit_scoring_model")
    return made.join(tracker, F.col("name") == F.col("model_name")).drop("model_name", "registration_date").withColumn("macro_f1_score", r6("macro_f1_score"))


_SEPARATES = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, coalesce(max({f}) FILTER (dpd < {fv.LABEL_DPD}) < min({f}) FILTER (dpd >= {fv.LABEL_DPD}), false) AS is_first, count(DISTINCT {f}) = 1 AS is_unused FROM lms"
    for f in _TELLING
)


@query("t08_top_importances", sql(_SEPARATES, "lms"))
def _(spark, sf):
    """The feature that parts the classes ranks first, and one that never varies has no gain."""
    model = models.train_boosted(_fit_rows(_training_rows(spark, sf)), _TELLING)
    top = models.feature_importances(spark, model, _TELLING, 20)
    most = top.agg(F.max("importance")).scalar()
    return top.select("feature", (F.col("importance") == most).alias("is_first"), (F.col("importance") == 0).alias("is_unused"))


@query("x04_batch_scoring", """SELECT l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-(0.05 * l_quantity - 20 * l_discount + 3 * l_tax))), 6) AS score FROM lineitem""")
def _(spark, sf):
    def logistic(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(x @ np.array([0.05, -20.0, 3.0]))))

    lines = table(spark, sf, "lineitem")
    scored = models.score_with(lines, ["l_quantity", "l_discount", "l_tax"], ["l_orderkey", "l_linenumber", "l_partkey"], logistic)
    return scored.withColumn("score", r6("score"))


@query("x02_probability_vector", """SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 5) AS first, len(embedding) AS size FROM embeddings""")
def _(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    unpacked = vectors.select("vec_id", vector_to_array("v").alias("a"))
    return unpacked.select("vec_id", F.round(F.col("a")[0], 5).alias("first"), F.size("a").cast("long").alias("size"))
