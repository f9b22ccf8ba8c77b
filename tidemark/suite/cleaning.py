"""Projections, scalar functions, calendars and the silver recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import calendar, loans, text
from tidemark.operators import columns as cols, indicators
from tidemark.operators import registry as runs
from tidemark.operators.ordered import exact_quantiles
from tidemark.operators.quality import shared_name_counts
from tidemark.plans import silver
from tidemark.suite import views
from tidemark.suite.registry import query, r6
from tidemark.suite.views import sql, table


# --- projections and predicates ----------------------------------------------
@query("p01_lower_names", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    upper = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C_Name"), F.col("c_mktsegment").alias("c_MktSegment")
    )
    return cols.lower_names(upper)


@query("p02_lenient_casts", sql(
    """SELECT customer_id, TRY_CAST(age AS INTEGER) AS age, TRY_CAST(ssn AS DATE) AS ssn, snapshot_date FROM raw_attr""", "raw_attr"))
def _(spark, sf):
    raw = views.raw_attributes(spark, sf).select("customer_id", "age", "ssn", "snapshot_date")
    return cols.cast_columns(raw, {"customer_id": "string", "age": "int", "ssn": "date", "snapshot_date": "date"})


@query("p03_on_snapshot", sql(
    "SELECT loan_id, customer_id, installment_num FROM raw_lms WHERE snapshot_date = DATE '1997-07-01'", "raw_lms"))
def _(spark, sf):
    return cols.on_snapshot(views.raw_lms(spark, sf), "1997-07-01").select("loan_id", "customer_id", "installment_num")


@query("p04_month_on_book", sql("SELECT mob, count(*) AS n, sum(installments_missed)::BIGINT AS missed FROM lms WHERE mob = 6 GROUP BY mob", "lms"))
def _(spark, sf):
    at = cols.at_mob(views.lms(spark, sf), 6)
    return at.groupBy("mob").agg(F.count(F.lit(1)).alias("n"), F.sum("installments_missed").alias("missed"))


@query("p05_drop_null_keys", sql(
    "SELECT customer_id, snapshot_date, fe_1, fe_2 FROM raw_click WHERE customer_id IS NOT NULL AND snapshot_date IS NOT NULL", "raw_click"))
def _(spark, sf):
    return cols.drop_null_keys(views.raw_clicks(spark, sf), ["customer_id", "snapshot_date"]).select(
        "customer_id", "snapshot_date", "fe_1", "fe_2"
    )


@query("p06_not_null", sql("SELECT customer_id, type_of_loan FROM raw_fin WHERE type_of_loan IS NOT NULL", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).where(F.col("type_of_loan").isNotNull()).select("customer_id", "type_of_loan")


@query("p07_not_matching", sql(
    """SELECT piece, count(*) AS n FROM (SELECT trim(unnest(string_split(type_of_loan, ','))) AS piece FROM raw_fin)
    WHERE NOT regexp_matches(piece, '(?i)^and\\b.*') GROUP BY piece""", "raw_fin"))
def _(spark, sf):
    pieces = views.raw_financials(spark, sf).select(F.explode(text.listed_loans(F.col("type_of_loan"))).alias("piece"))
    return pieces.where(~F.col("piece").rlike(fv.LEADING_AND)).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


@query("p08_drop_columns", sql("SELECT customer_id, occupation, snapshot_date FROM raw_attr", "raw_attr"))
def _(spark, sf):
    return views.raw_attributes(spark, sf).drop("name", "ssn", "age", "no_such_column")


@query("p09_select_rename", sql("SELECT loan_id AS id, customer_id FROM lms WHERE mob = 6", "lms"))
def _(spark, sf):
    return cols.at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id").withColumnRenamed("loan_id", "id")


@query("p10_label_definition", "SELECT n_nationkey, '30dpd_6mob' AS label_def FROM nation")
def _(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", loans.label_definition().alias("label_def"))


@query("p11_feature_columns", sql("SELECT mob, tenure, installments_missed, dpd FROM lms", "lms"))
def _(spark, sf):
    df = views.lms(spark, sf)
    left_out = [*fv.SCORING_EXCLUDES, "not_there", "loan_start_date", "first_missed_date", "installment_num",
                "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
    return df.select(cols.feature_columns(df, left_out))


@query("p12_align_features", sql("SELECT loan_id, 0 AS unseen, dpd, mob FROM lms", "lms"))
def _(spark, sf):
    return cols.align_features(views.lms(spark, sf), ["unseen", "dpd", "mob"], keep=["loan_id"])


@query("p13_numeric_columns",
       """SELECT sum(l_orderkey)::BIGINT AS l_orderkey, sum(l_partkey)::BIGINT AS l_partkey, sum(l_suppkey)::BIGINT AS l_suppkey,
       sum(l_linenumber)::BIGINT AS l_linenumber, sum(l_quantity)::BIGINT AS l_quantity, sum(round(l_extendedprice * 100))::BIGINT AS l_extendedprice,
       sum(round(l_discount * 100))::BIGINT AS l_discount, sum(round(l_tax * 100))::BIGINT AS l_tax FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    cents = {"l_extendedprice", "l_discount", "l_tax"}
    return df.agg(*[
        F.sum(F.round(F.col(c) * (100 if c in cents else 1)).cast("long")).alias(c) for c in cols.numeric_columns(df)
    ])


@query("p14_lookup", sql("SELECT loan_id, installment_num, snapshot_date FROM raw_lms WHERE customer_id = '42'", "raw_lms"))
def _(spark, sf):
    return cols.lookup(views.raw_lms(spark, sf), "42").select("loan_id", "installment_num", "snapshot_date")



def _order_months(spark, sf, shift_months: int):
    month = F.add_months(F.trunc(F.col("o_orderdate").cast("date"), "month"), shift_months)
    return table(spark, sf, "orders").select(month.alias("day")).distinct()


@query("p15_lifecycle_phase", """SELECT day, CASE WHEN day < DATE '2024-06-01' THEN 'skip_run' WHEN day = DATE '2024-06-01'
    THEN 'run_initial_training_flow' ELSE 'run_monthly_lifecycle_flow' END AS phase,
    CASE WHEN day IN (DATE '2024-06-01', DATE '2024-09-01', DATE '2024-12-01') THEN 'trigger_retraining' ELSE 'skip_retraining' END AS retrain,
    CASE WHEN day = DATE '2023-01-01' THEN 1 ELSE 0 END AS loads_static
    FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) + INTERVAL 300 MONTH AS DATE) AS day FROM orders)""")
def _(spark, sf):
    day = F.col("day")
    return _order_months(spark, sf, 300).select(
        day, calendar.lifecycle_phase(day).alias("phase"), calendar.retraining_decision(day).alias("retrain"),
        calendar.loads_static(day).alias("loads_static"),
    )


# --- numbers and text --------------------------------------------------------
_NUM = "nullif(regexp_extract({}, '([-+]?\\d*\\.?\\d+)', 1), '')"


@query("f01_first_number", sql(
    f"""SELECT customer_id, CAST(CAST({_NUM.format('annual_income')} AS FLOAT) AS DOUBLE) AS income,
    CAST({_NUM.format('num_of_loan')} AS INTEGER) AS loans, CAST({_NUM.format('num_of_delayed_payment')} AS INTEGER) AS delayed
    FROM raw_fin""", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select(
        "customer_id", text.first_number(F.col("annual_income")).cast("double").alias("income"),
        text.first_number(F.col("num_of_loan"), "int").alias("loans"),
        text.first_number(F.col("num_of_delayed_payment"), "int").alias("delayed"),
    )


@query("f02_digits_only", sql(
    """SELECT customer_id, CAST(CAST(regexp_replace(annual_income, '[^0-9.]', '', 'g') AS FLOAT) AS DOUBLE) AS income,
    TRY_CAST(regexp_replace(amount_invested_monthly, '[^0-9.]', '', 'g') AS INTEGER) AS invested FROM raw_fin""", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select(
        "customer_id", text.digits_only(F.col("annual_income")).cast("double").alias("income"),
        text.digits_only(F.col("amount_invested_monthly"), "int").alias("invested"),
    )


@query("f03_age_range", sql(
    f"""SELECT customer_id, CASE WHEN a BETWEEN 0 AND 120 THEN a END AS age
    FROM (SELECT customer_id, CAST({_NUM.format('age')} AS INTEGER) AS a FROM raw_attr)""", "raw_attr"))
def _(spark, sf):
    age = text.first_number(F.col("age"), "int")
    return views.raw_attributes(spark, sf).select(
        "customer_id", text.keep_between(age, fv.AGE_MIN, fv.AGE_MAX).alias("age")
    )


@query("f04_negatives_out", sql(
    f"""SELECT customer_id, CASE WHEN a >= 0 THEN a END AS num_of_loan, CASE WHEN b >= 0 THEN b END AS delay_from_due_date
    FROM (SELECT customer_id, CAST({_NUM.format('num_of_loan')} AS INTEGER) AS a,
    CAST({_NUM.format('delay_from_due_date')} AS INTEGER) AS b FROM raw_fin)""", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select(
        "customer_id",
        *[text.keep_at_least(text.first_number(F.col(c), "int")).alias(c) for c in ("num_of_loan", "delay_from_due_date")],
    )


def _cap(column: str, source: str = "n") -> str:
    return f"""(SELECT min(v) FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) AS rn, count(*) OVER () AS c
        FROM {source} WHERE {column} IS NOT NULL) WHERE rn >= ceil(CAST(0.97 AS DOUBLE) * c))"""


_NUMBERS = ", ".join(f"CAST({_NUM.format(c)} AS {'FLOAT' if k == 'float' else 'INTEGER'}) AS {c}" for c, k in fv.FINANCIAL_TYPES.items())
_KEPT = ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in fv.NON_NEGATIVE)
CLEAN = f"SELECT * REPLACE ({_KEPT}) FROM (SELECT * REPLACE ({_NUMBERS}) FROM raw_fin)"


@query("f05_clip_upper", sql(
    f"""SELECT customer_id, CAST(CASE WHEN interest_rate > {_cap('interest_rate')} THEN {_cap('interest_rate')} ELSE interest_rate END AS DOUBLE)
    AS interest_rate, CAST(CASE WHEN num_bank_accounts > {_cap('num_bank_accounts')} THEN {_cap('num_bank_accounts')}
    ELSE num_bank_accounts END AS DOUBLE) AS num_bank_accounts FROM n""", "raw_fin", n=CLEAN))
def _(spark, sf):
    clipped = silver.financials_main(views.raw_financials(spark, sf), clip_method="exact")
    return clipped.select("customer_id", "interest_rate", "num_bank_accounts")


@query("f06_ssn_format", sql(
    "SELECT customer_id, CASE WHEN regexp_matches(ssn, '^\\d{3}-\\d{2}-\\d{4}$') THEN ssn END AS ssn FROM raw_attr", "raw_attr"))
def _(spark, sf):
    return views.raw_attributes(spark, sf).select("customer_id", text.keep_matching(F.col("ssn"), fv.SSN).alias("ssn"))


@query("f07_validity_flags", sql(
    """SELECT customer_id, CASE WHEN regexp_matches(ssn, '^\\d{3}-\\d{2}-\\d{4}$') THEN 1 ELSE 0 END AS ssn_valid,
    CASE WHEN nullif(nullif(trim(occupation), '_______'), '') IS NULL THEN 0 ELSE 1 END AS occupation_known,
    CASE WHEN TRY_CAST(age AS INTEGER) >= 15 THEN 1 ELSE 0 END AS age_valid FROM raw_attr""", "raw_attr"))
def _(spark, sf):
    return silver.attributes_retrofit(views.raw_attributes(spark, sf)).select(
        "customer_id", "ssn_valid", "occupation_known", "age_valid"
    )


@query("f08_sentinels", sql(
    """SELECT customer_id, nullif(credit_mix, '_') AS credit_mix, CASE WHEN type_of_loan IN ('NULL', 'Not Specified') THEN NULL
    ELSE type_of_loan END AS type_of_loan FROM raw_fin""", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select(
        "customer_id", text.null_if_in(F.col("credit_mix"), [fv.NO_CREDIT_MIX]).alias("credit_mix"),
        text.null_if_in(F.col("type_of_loan"), fv.NO_LOAN_TYPE).alias("type_of_loan"),
    )


@query("f09_trim", sql("SELECT customer_id, trim(name) AS name FROM raw_attr", "raw_attr"))
def _(spark, sf):
    return views.raw_attributes(spark, sf).select("customer_id", F.trim("name").alias("name"))


def _part(pattern: str) -> str:
    return f"CAST(nullif(regexp_extract(credit_history_age, '{pattern}', 1), '') AS INTEGER)"


_DURATIONS = (
    f"SELECT customer_id, {_part('(\\d+)\\s+Year')} AS years, {_part('(\\d+)\\s+Month')} AS months, "
    f"{_part('(\\d+) Years')} AS years_plural, {_part('(\\d+) Months')} AS months_plural FROM raw_fin"
)


def _durations(spark, sf):
    age = F.col("credit_history_age")
    return views.raw_financials(spark, sf).select(
        "customer_id",
        *[text.duration_part(age, p).alias(n) for n, p in (
            ("years", fv.YEARS_ANY), ("months", fv.MONTHS_ANY),
            ("years_plural", fv.YEARS_PLURAL), ("months_plural", fv.MONTHS_PLURAL))],
    )


@query("f10_duration_parts", sql(_DURATIONS, "raw_fin"))
def _(spark, sf):
    return _durations(spark, sf)


@query("f11_total_months", sql(
    "SELECT customer_id, years * 12 + months AS main_months, years_plural * 12 + coalesce(months_plural, 0) AS retrofit_months FROM d",
    "raw_fin", d=_DURATIONS))
def _(spark, sf):
    return _durations(spark, sf).select(
        "customer_id", text.total_months(F.col("years"), F.col("months")).alias("main_months"),
        text.total_months(F.col("years_plural"), F.col("months_plural"), True).alias("retrofit_months"),
    )


@query("f12_behaviour_split", sql(
    """SELECT customer_id, nullif(regexp_extract(payment_behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 1), '') AS spent,
    nullif(regexp_extract(payment_behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 2), '') AS worth FROM raw_fin""", "raw_fin"))
def _(spark, sf):
    b = F.col("payment_behaviour")
    return views.raw_financials(spark, sf).select(
        "customer_id", text.behaviour_spent(b).alias("spent"), text.behaviour_value(b).alias("worth")
    )


@query("f13_yes_flag", sql(
    "SELECT customer_id, CASE WHEN payment_of_min_amount = 'Yes' THEN 1 ELSE 0 END AS pays_min FROM raw_fin", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select("customer_id", text.flag(F.col("payment_of_min_amount") == "Yes").alias("pays_min"))


@query("f14_behaviour_code", sql(
    """SELECT customer_id, CASE WHEN lower(payment_behaviour) = '!@9#%8' THEN '0' ELSE lower(payment_behaviour) END AS code
    FROM raw_fin""", "raw_fin"))
def _(spark, sf):
    return views.raw_financials(spark, sf).select("customer_id", text.behaviour_code(F.col("payment_behaviour")).alias("code"))


NAMES = """SELECT customer_id, lower(replace(trim(unnest(string_split(replace(type_of_loan, ' and ', ','), ','))), ' ', '_')) AS name FROM raw_fin"""


@query("f15_loan_type_counts", sql(
    "SELECT customer_id, name, CAST(count(*) AS INTEGER) AS n FROM names WHERE name <> '' GROUP BY ALL", "raw_fin", names=NAMES))
def _(spark, sf):
    counts = text.loan_type_counts(F.col("type_of_loan"))
    return views.raw_financials(spark, sf).select("customer_id", F.explode(counts).alias("name", "n"))


TYPE_COLUMNS = ["auto_loan", "credit-builder_loan", "home_equity_loan", "not_specified", "personal_loan"]


LOAN_TYPES = "SELECT customer_id, " + ", ".join(
    f"CAST((SELECT count(*) FROM names WHERE names.customer_id = f.customer_id AND name = '{n}') AS INTEGER) AS \"{n}\"" for n in TYPE_COLUMNS) + " FROM raw_fin f"


@query("f16_loan_type_columns", sql(LOAN_TYPES, "raw_fin", names=NAMES))
def _(spark, sf):
    return silver.loan_types(views.raw_financials(spark, sf)).drop("snapshot_date", "type_of_loan")


@query("f16_sparse_loan_types", sql(
    """SELECT customer_id, name AS value, CAST(dense_rank() OVER (ORDER BY name) - 1 AS INTEGER) AS code, CAST(n AS DOUBLE) AS times
    FROM (SELECT customer_id, name, count(*) AS n FROM names WHERE name <> '' GROUP BY ALL)""", "raw_fin", names=NAMES))
def _(spark, sf):
    """The counts of the wide form in one sparse vector per customer, whatever the number of names; read back through the dictionary."""
    raw = views.raw_financials(spark, sf).select("customer_id", "type_of_loan")
    vectors, codes = indicators.sparse_indicators(raw, {"loan": text.loan_type_names(F.col("type_of_loan"))}, counts=True)
    return indicators.places_of(vectors, codes, ["customer_id"], keep_code=True).drop("column")


@query("x03_sparse_many", """SELECT o_orderkey, "column", value, CAST(dense_rank() OVER (ORDER BY "column", value) - 1 AS INTEGER) AS code FROM (
    SELECT o_orderkey, 'clerk' AS "column", o_orderpriority AS value FROM orders UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS VARCHAR) FROM orders
    UNION ALL SELECT o_orderkey, 'order', CAST(o_orderkey AS VARCHAR) FROM orders)""")
def _(spark, sf):
    """As many names as there are orders, with no name on the driver."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    values = {"clerk": F.array("o_orderpriority"), "customer": F.array(F.col("o_custkey").cast("string")), "order": F.array(F.col("o_orderkey").cast("string"))}
    vectors, codes = indicators.sparse_indicators(orders, values)
    return indicators.places_of(vectors, codes, ["o_orderkey"], keep_code=True).drop("times")


_FLAGS = {"auto_loan": "Auto Loan", "credit_builder_loan": "Credit-Builder Loan", "home_equity_loan": "Home Equity Loan",
          "not_specified": "Not Specified", "personal_loan": "Personal Loan"}


@query("f17_loan_indicators", sql(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN contains(type_of_loan, '{n}') THEN 1 ELSE 0 END AS {c}" for c, n in _FLAGS.items()) + " FROM raw_fin", "raw_fin"))
def _(spark, sf):
    raw = views.raw_financials(spark, sf)
    names = silver.retrofit_loan_names(raw)
    return silver.financials_retrofit(raw, loan_names=names, behaviours=[]).select(
        "customer_id", *[text.column_name(n) for n in names]
    )


_PB = ["0", "high_spent_large_value_payments", "high_spent_small_value_payments", "low_spent_large_value_payments",
       "low_spent_medium_value_payments"]


@query("f18_indicator_columns", sql(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN credit_mix = '{m}' THEN 1 ELSE 0 END AS credit_mix_{m.lower()}" for m in fv.CREDIT_MIXES) + ", " + ", ".join(
        f"CAST(code = '{b}' AS INTEGER) AS pb_{b}" for b in _PB) +
    """ FROM (SELECT *, CASE WHEN lower(payment_behaviour) = '!@9#%8' THEN '0' ELSE lower(payment_behaviour) END AS code FROM raw_fin)""",
    "raw_fin"))
def _(spark, sf):
    raw = views.raw_financials(spark, sf)
    names = silver.retrofit_behaviours(raw)
    return silver.financials_retrofit(raw, loan_names=[], behaviours=names).select(
        "customer_id", *[f"credit_mix_{m.lower()}" for m in fv.CREDIT_MIXES], *[f"pb_{b}" for b in names]
    )


# --- loan arithmetic ---------------------------------------------------------
@query("f19_month_on_book", sql("SELECT mob, count(*) AS n FROM lms GROUP BY mob", "lms"))
def _(spark, sf):
    return views.lms(spark, sf).groupBy("mob").agg(F.count(F.lit(1)).alias("n"))


@query("f20_installments_missed", sql(
    """SELECT installments_missed, count(*) AS n, round(sum(CAST(paid_amt AS DOUBLE)), 4) AS paid FROM lms
    GROUP BY installments_missed""", "lms"))
def _(spark, sf):
    return views.lms(spark, sf).groupBy("installments_missed").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("paid_amt").cast("double")), 4).alias("paid")
    )


@query("f21_first_missed_date", sql("SELECT first_missed_date, count(*) AS n FROM lms GROUP BY first_missed_date", "lms"))
def _(spark, sf):
    return views.lms(spark, sf).groupBy("first_missed_date").agg(F.count(F.lit(1)).alias("n"))


@query("f22_days_past_due", sql("SELECT dpd, count(*) AS n FROM lms GROUP BY dpd", "lms"))
def _(spark, sf):
    return views.lms(spark, sf).groupBy("dpd").agg(F.count(F.lit(1)).alias("n"))


@query("f23_default_label", sql(
    "SELECT CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, count(*) AS n FROM lms GROUP BY 1", "lms"))
def _(spark, sf):
    return views.lms(spark, sf).groupBy(loans.default_label(F.col("dpd")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("f24_high_risk_grade", """SELECT o_orderkey, CASE WHEN substr('ABCDEFG', CAST(o_custkey % 7 AS INTEGER) + 1, 1) IN ('D','E','F','G')
    THEN 1 ELSE 0 END AS target FROM orders""")
def _(spark, sf):
    grade = F.substring(F.lit("ABCDEFG"), (F.col("o_custkey") % 7 + 1).cast("int"), F.lit(1))
    return table(spark, sf, "orders").select("o_orderkey", loans.high_risk(grade).alias("target"))


@query("f25_label_codes", sql(
    """SELECT g.key, CAST(codes.i AS INTEGER) AS label_index, coalesce(d.label, 'Unknown') AS shifted_label FROM graded g
    JOIN codes ON g.label = codes.label LEFT JOIN codes d ON d.i = codes.i + 2""",
    "graded", codes="SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM (SELECT DISTINCT label FROM graded)"))
def _(spark, sf):
    from tidemark.operators import features

    df = views.graded(spark, sf).select("key", "label")
    codes = features.label_indexes(df, "label")
    encoded = df.join(codes, "label", "left").withColumn("shifted", (F.col("label_index") + 2).cast("int"))
    return features.decode_labels(encoded, "shifted", codes, "label").select("key", "label_index", "shifted_label")


@query("f26_threshold", sql("SELECT CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n FROM scored GROUP BY 1", "scored"))
def _(spark, sf):
    from tidemark.operators.evaluation import predict

    return views.scored(spark, sf).groupBy(predict(F.col("score")).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("f27_run_facts", sql(
    """SELECT task_id, min_by(run_id, line_no) FILTER (WHERE run_id IS NOT NULL) AS run_id,
    min_by(f1, line_no) FILTER (WHERE f1 IS NOT NULL) AS macro_f1 FROM (SELECT task_id, line_no,
    nullif(regexp_extract(text, '(?i)run_id[:\\s]+([a-f0-9]+)', 1), '') AS run_id,
    TRY_CAST(nullif(regexp_extract(text, '(?i)Macro F1 Score[:\\s]+([0-9.]+)', 1), '') AS DOUBLE) AS f1 FROM log_lines)
    GROUP BY task_id""", "log_lines"))
def _(spark, sf):
    return runs.run_facts(views.log_lines(spark, sf))


@query("f28_json_maps", """SELECT k, count(*) AS n FROM (SELECT CASE WHEN event_type = 'click' THEN NULL
    ELSE json_extract_string(props, '$.k') END AS k FROM events) GROUP BY k""")
def _(spark, sf):
    # clicks get a broken text, which must read as an empty map
    broken = F.when(F.col("event_type") == "click", F.concat(F.lit("[not json "), F.col("props"))).otherwise(F.col("props"))
    k = F.try_element_at(text.json_map(broken), F.lit("k"))
    return table(spark, sf, "events").groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("f29_period_keys", """SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day,
    strftime(date_trunc('month', o_orderdate), '%Y_%m_%d') AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS parsed FROM orders""")
def _(spark, sf):
    keyed = _order_months(spark, sf, 0).withColumn("key", calendar.period_key(F.col("day")))
    path = F.concat(F.lit("gold/feature_store/gold_feature_store_"), F.col("key"), F.lit(".parquet"))
    return keyed.withColumn("parsed", calendar.period_in_path(path))


@query("f30_week_shifts", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) - 7 AS before,
    CAST(o_orderdate AS DATE) + 7 AS after FROM orders""")
def _(spark, sf):
    day = F.col("day")
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(day, calendar.week_before(day).alias("before"), calendar.week_after(day).alias("after"))


# --- calendars ---------------------------------------------------------------
@query("c01_training_window", """SELECT day, CAST(unnest(generate_series(day - INTERVAL 12 MONTH, day - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month
    FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders)""")
def _(spark, sf):
    return _order_months(spark, sf, 0).select("day", F.explode(calendar.training_window(F.col("day"))).alias("month"))


@query("c02_initial_window", """SELECT DISTINCT CAST(date_trunc('month', o_orderdate) + INTERVAL 300 MONTH AS DATE) AS day FROM orders
    WHERE CAST(date_trunc('month', o_orderdate) + INTERVAL 300 MONTH AS DATE) BETWEEN DATE '2023-07-01' AND DATE '2024-06-01'""")
def _(spark, sf):
    from tidemark.sources.snapshots import in_range

    return in_range(_order_months(spark, sf, 300), *fv.INITIAL_WINDOW, by="day")


@query("c03_trailing_weeks", """SELECT day, CAST(unnest(generate_series(day - INTERVAL 14 DAY, CAST(day AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""")
def _(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", F.explode(calendar.trailing_weeks(F.col("day"), 3)).alias("week"))


@query("c04_every_day", """SELECT o_custkey, count(*) AS days FROM (SELECT o_custkey, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
    FROM (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY o_custkey)) GROUP BY o_custkey""")
def _(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("lo"), F.max(F.col("o_orderdate").cast("date")).alias("hi")
    )
    days = spans.select("o_custkey", F.explode(calendar.every_day(F.col("lo"), F.col("hi"))).alias("d"))
    return days.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("days"))


# --- whole recipes -----------------------------------------------------------
MAIN_ATTRIBUTES = f"""SELECT customer_id, name, CASE WHEN a BETWEEN 0 AND 120 THEN a END AS age,
    CASE WHEN regexp_matches(ssn, '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') THEN ssn END AS ssn, nullif(occupation, '_______') AS occupation,
    snapshot_date FROM (SELECT *, CAST({_NUM.format('age')} AS INTEGER) AS a FROM raw_attr)"""


@query("m07_silver_attributes_main", sql(MAIN_ATTRIBUTES, "raw_attr"))
def _(spark, sf):
    return silver.silver_table("attributes", views.raw_attributes(spark, sf), "main")


@query("m07_silver_clickstream_main", sql("SELECT * FROM raw_click", "raw_click"))
def _(spark, sf):
    return silver.silver_table("clickstream", views.raw_clicks(spark, sf), "main")


FLOATS = [c for c, k in fv.FINANCIAL_TYPES.items() if k == "float"]
MAIN_FIN = (
    "SELECT customer_id, snapshot_date, payment_of_min_amount, credit_history_age, nullif(credit_mix, '_') AS credit_mix, "
    + ", ".join(FLOATS) + ", delay_from_due_date, "
    + ", ".join(f"CAST(CASE WHEN {c} > {_cap(c)} THEN {_cap(c)} ELSE {c} END AS DOUBLE) AS {c}" for c in fv.CLIPPED)
    + f", {_part('(\\d+)\\s+Year')} AS credit_history_age_year, {_part('(\\d+)\\s+Month')} AS credit_history_age_month, "
    + ", ".join(
        f"nullif(regexp_extract(payment_behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', {i}), '') AS payment_behaviour_{n}"
        for i, n in ((1, "spent"), (2, "value")))
    + " FROM n"
)


@query("m07_silver_financials_main", sql(MAIN_FIN, "raw_fin", n=CLEAN))
def _(spark, sf):
    return silver.silver_table("financials", views.raw_financials(spark, sf), "main", clip_method="exact")


@query("m07_silver_lms", sql("SELECT * FROM lms", "lms"))
def _(spark, sf):
    return silver.silver_table("lms", views.raw_lms(spark, sf), "main")


RETROFIT_ATTRIBUTES = """SELECT a.* EXCLUDE (name, ssn, age, occupation), TRY_CAST(age AS INTEGER) AS age,
    nullif(nullif(trim(occupation), '_______'), '') AS occupation,
    CASE WHEN regexp_matches(ssn, '^\\d{3}-\\d{2}-\\d{4}$') THEN 1 ELSE 0 END AS ssn_valid,
    CASE WHEN nullif(nullif(trim(occupation), '_______'), '') IS NULL THEN 0 ELSE 1 END AS occupation_known,
    CASE WHEN TRY_CAST(age AS INTEGER) >= 15 THEN 1 ELSE 0 END AS age_valid, c.n AS name_shared_count,
    CASE WHEN c.n > 1 THEN 1 ELSE 0 END AS is_name_shared
    FROM raw_attr a LEFT JOIN (SELECT trim(name) AS name, count(*) AS n FROM raw_attr GROUP BY 1) c ON trim(a.name) = c.name"""


@query("m08_silver_attributes_retrofit", sql(RETROFIT_ATTRIBUTES, "raw_attr"))
def _(spark, sf):
    return silver.silver_table("attributes", views.raw_attributes(spark, sf))


@query("m08_silver_clickstream_retrofit", sql("SELECT * FROM raw_click WHERE customer_id IS NOT NULL", "raw_click"))
def _(spark, sf):
    return silver.silver_table("clickstream", views.raw_clicks(spark, sf))


RETROFIT_FIN = (
    "SELECT customer_id, snapshot_date, CAST(regexp_replace(annual_income, '[^0-9.]', '', 'g') AS FLOAT) AS annual_income, "
    + ", ".join(f"TRY_CAST({c} AS FLOAT) AS {c}" for c in fv.RETROFIT_FLOATS) + ", "
    + ", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in fv.RETROFIT_COUNTS)
    + ", CASE WHEN payment_of_min_amount = 'Yes' THEN 1 ELSE 0 END AS payment_of_min_amount, "
    + f"{_part('(\\d+) Years')} AS credit_history_years, {_part('(\\d+) Months')} AS credit_history_months, "
    + f"{_part('(\\d+) Years')} * 12 + coalesce({_part('(\\d+) Months')}, 0) AS credit_history_total_months, "
    + ", ".join(f"CASE WHEN contains(type_of_loan, '{n}') THEN 1 ELSE 0 END AS {c}" for c, n in _FLAGS.items())
    + ", nullif(credit_mix, '_') AS credit_mix, "
    + ", ".join(f"CASE WHEN credit_mix = '{m}' THEN 1 ELSE 0 END AS credit_mix_{m.lower()}" for m in fv.CREDIT_MIXES)
    + ", CASE WHEN credit_mix IN ('Good', 'Bad', 'Standard') THEN 1 ELSE 0 END AS valid_credit_mix, code AS payment_behaviour, "
    + "CAST(code IS NOT NULL AS INTEGER) AS has_valid_payment_behavior, "
    + ", ".join(f"CAST(code = '{b}' AS INTEGER) AS pb_{b}" for b in _PB)
    + """ FROM (SELECT *, CASE WHEN lower(payment_behaviour) = '!@9#%8' THEN '0' ELSE lower(payment_behaviour) END AS code FROM raw_fin)"""
)


@query("m08_silver_financials_retrofit", sql(RETROFIT_FIN, "raw_fin"))
def _(spark, sf):
    return silver.silver_table("financials", views.raw_financials(spark, sf))


@query("j07_shared_names", sql(
    """SELECT a.customer_id, a.name, c.n AS name_shared_count, CASE WHEN c.n > 1 THEN 1 ELSE 0 END AS is_name_shared
    FROM raw_attr a LEFT JOIN (SELECT name, count(*) AS n FROM raw_attr GROUP BY 1) c ON a.name = c.name""", "raw_attr"))
def _(spark, sf):
    return shared_name_counts(views.raw_attributes(spark, sf).select("customer_id", "name"))


@query("a10_quantiles", """SELECT round(quantile_cont(l_extendedprice, 0.97), 6) AS price_linear,
    CAST((SELECT min(v) FROM (SELECT l_quantity AS v, row_number() OVER (ORDER BY l_quantity) AS rn, count(*) OVER () AS c FROM lineitem)
    WHERE rn >= ceil(CAST(0.97 AS DOUBLE) * c)) AS DOUBLE) AS quantity_reached FROM lineitem""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    linear = exact_quantiles(lines, "l_extendedprice", [0.97])
    reached = exact_quantiles(lines, "l_quantity", [0.97], interpolate=False).select(F.col("quantiles")[0])
    return linear.select(r6(F.col("quantiles")[0]).alias("price_linear"), reached.scalar().alias("quantity_reached"))
