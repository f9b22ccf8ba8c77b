"""Loan-shaped views of the test tables, once as DataFrames and once as SQL.

The raw views carry the faults the cleaning rules exist for: unit marks inside
numbers, sentinels, impossible ages, missing values, repeated names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans import silver

# Loan names per order priority, in column order of the counts.
LOAN_NAMES = {
    "1-URGENT": "Auto Loan", "2-HIGH": "Credit-Builder Loan", "3-MEDIUM": "Personal Loan",
    "4-NOT SPECIFIED": "Not Specified", "5-LOW": "Home Equity Loan",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- loans -------------------------------------------------------------------
def raw_lms(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    overdue = F.when(F.col("l_returnflag") == "R", F.col("l_discount")).otherwise(0.0)
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("loan_start_date"),
        F.lit(10).alias("tenure"),
        F.col("l_linenumber").alias("installment_num"),
        F.col("l_extendedprice").alias("loan_amt"),
        F.col("l_tax").alias("due_amt"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("paid_amt"),
        overdue.alias("overdue_amt"),
        F.col("l_quantity").alias("balance"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("snapshot_date"),
    )


def lms(spark: SparkSession, sf: str) -> DataFrame:
    return silver.lms(raw_lms(spark, sf))


# --- customers ---------------------------------------------------------------
def raw_attributes(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    age = F.floor(F.col("c_acctbal") / 50).cast("string")
    return table(spark, sf, "customer").select(
        key.cast("string").alias("customer_id"),
        F.when(key % 50 != 0, F.concat(F.lit(" Person "), (key % 700).cast("string"))).alias("name"),
        F.when(key % 2 == 0, F.concat(age, F.lit("_"))).otherwise(age).alias("age"),
        F.when(key % 2 == 0, F.concat(F.lit("123-45-"), F.lpad((key % 10000).cast("string"), 4, "0")))
        .otherwise(F.lit("#F%$D@*&8")).alias("ssn"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "_______").otherwise(F.col("c_mktsegment")).alias("occupation"),
        F.lit("2023-01-01").cast("date").alias("snapshot_date"),
    )


def raw_financials(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("o_orderpriority") == p).alias(f"n{i}") for i, p in enumerate(LOAN_NAMES)],
    )
    customers = table(spark, sf, "customer")
    df = customers.join(orders, customers.c_custkey == orders.o_custkey, "left")
    key = F.col("c_custkey")
    cents = F.round(F.col("c_acctbal") * 100).cast("long")

    def txt(c):
        return c.cast("string")

    pieces = [
        F.expr(f"repeat('{name}, ', cast(least(coalesce(n{i}, 0), 3) as int))") for i, name in enumerate(LOAN_NAMES.values())
    ]
    listed = F.concat(*pieces)
    listed = F.substring(listed, F.lit(1), F.greatest(F.length(listed) - 2, F.lit(0)))
    listed = F.regexp_replace(listed, ", ([^,]*)$", ", and $1")
    years, months = txt(F.floor(key / 12) % 30), txt(key % 12)
    return df.select(
        txt(key).alias("customer_id"),
        F.when(key % 3 == 0, F.concat(txt(cents), F.lit("_"))).otherwise(txt(cents)).alias("annual_income"),
        txt(F.floor(cents / 12)).alias("monthly_inhand_salary"),
        txt(F.coalesce("n", F.lit(0))).alias("num_bank_accounts"),
        txt(F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))).alias("num_credit_card"),
        txt(F.when(key % 100 == 0, key + 500).otherwise(key % 35)).alias("interest_rate"),
        F.when(key % 30 == 0, "-100").otherwise(F.concat(txt(F.coalesce("n2", F.lit(0))), F.lit("_"))).alias("num_of_loan"),
        txt(key % 60 - 5).alias("delay_from_due_date"),
        F.when(key % 11 == 0, "").otherwise(F.concat(txt(key % 25), F.when(key % 2 == 0, "_").otherwise(""))).alias(
            "num_of_delayed_payment"
        ),
        F.when(key % 20 == 0, "_").otherwise(F.concat(txt(key % 30), F.lit("."), txt(key % 10))).alias("changed_credit_limit"),
        txt(key % 17).alias("num_credit_inquiries"),
        F.concat(txt(key % 5000), F.lit(".25")).alias("outstanding_debt"),
        F.concat(txt(key % 50), F.lit(".5")).alias("credit_utilization_ratio"),
        txt(key % 400).alias("total_emi_per_month"),
        F.when(key % 40 == 0, "__10000__").otherwise(txt(key % 900)).alias("amount_invested_monthly"),
        F.when(key % 23 != 0, txt(key % 700)).alias("monthly_balance"),
        F.when(key % 4 == 0, F.concat(years, F.lit(" Years and "), months, F.lit(" Months")))
        .when(key % 4 == 1, F.concat(years, F.lit(" Year and "), months, F.lit(" Month")))
        .when(key % 4 == 2, F.concat(years, F.lit(" Years"))).alias("credit_history_age"),
        F.when(key % 7 == 0, "High_spent_Small_value_payments").when(key % 7 == 1, "Low_spent_Large_value_payments")
        .when(key % 7 == 2, "!@9#%8").when(key % 7 == 3, "Low_spent_Medium_value_payments")
        .when(key % 7 == 4, "High_spent_Large_value_payments").alias("payment_behaviour"),
        F.when(key % 5 == 0, "_").when(key % 5 == 1, "Good").when(key % 5 == 2, "Bad").when(key % 5 == 3, "Standard").alias(
            "credit_mix"
        ),
        F.when(key % 6 == 0, "NM").when(key % 6 < 3, "Yes").when(key % 6 < 5, "No").alias("payment_of_min_amount"),
        F.nullif(listed, F.lit("")).alias("type_of_loan"),
        F.lit("2023-01-01").cast("date").alias("snapshot_date"),
    )


def raw_clicks(spark: SparkSession, sf: str) -> DataFrame:
    one = F.floor("value").cast("int")
    two = F.get_json_object("props", "$.k").try_cast("int")
    base = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 50 != 0, F.col("user_id").cast("string")).alias("customer_id"),
        F.trunc(F.col("ts").cast("date"), "month").alias("snapshot_date"),
        one.alias("fe_1"),
        F.when(two != 7, two).alias("fe_2"),
    )
    more = [((F.col("fe_1") * i + F.col("fe_2")) % 100).alias(f"fe_{i}") for i in range(3, 21)]
    return base.select("fe_1", "fe_2", *more, "customer_id", "snapshot_date")


# --- model outputs -----------------------------------------------------------
def scored(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    mixed = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % 1000
    return lines.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (mixed / F.lit(1000.0)).alias("score"),
        F.col("l_discount").alias("tied"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("snapshot_date"),
    )


def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    n = F.count(F.lit(1))

    def mean(column: str, unit: int):
        return F.floor(F.sum(F.round(F.col(column) * unit).cast("long")) * 10000 / (n * 10)) / 10000

    return (
        lines.groupBy(
            F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "month"), "yyyy_MM_dd").alias("week_date"),
            F.col("l_returnflag").alias("model_name"),
        )
        .agg(
            (F.floor(F.sum("l_quantity").cast("long") * 10000 / (n * 50)) / 10000).alias("accuracy"),
            mean("l_discount", 100).alias("macro_f1"),
            mean("l_tax", 100).alias("weighted_f1"),
            n.alias("total_samples"),
            F.max(F.col("l_shipdate").cast("date")).alias("evaluation_date"),
        )
    )


def graded(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(p) for p in [*LOAN_NAMES, "6-OTHER"]])
    said = (F.col("o_orderkey") * 7919 + F.col("o_custkey") * 31) % 6
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("label"),
        F.when(said < 3, F.element_at(names, (said + 1).cast("int")))
        .when(said == 5, F.lit("6-OTHER")).otherwise(F.col("o_orderpriority")).alias("prediction"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    score = F.lpad(((conv * 37 + turn) % 10000).cast("string"), 4, "0")
    note = (
        F.when((conv + turn) % 3 == 1, F.concat(F.lit("\nRun_ID: "), (conv * 7919 + turn).cast("string")))
        .when((conv + turn) % 3 == 2, F.concat(F.lit("\nmacro f1 score: 0."), score))
        .otherwise("")
    )
    return table(spark, sf, "conversations").select(
        conv.cast("string").alias("task_id"), turn.alias("line_no"), F.concat("text", note).alias("text")
    )


# --- the same in SQL ---------------------------------------------------------
_MONTH = "CAST(date_trunc('month', {}) AS DATE)"
_FE = ", ".join(f"(fe_1 * {i} + fe_2) % 100 AS fe_{i}" for i in range(3, 21))
_LOANS = " || ".join(f"repeat('{n}, ', CAST(least(coalesce(n{i}, 0), 3) AS INTEGER))" for i, n in enumerate(LOAN_NAMES.values()))
_COUNTS = ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS n{i}" for i, p in enumerate(LOAN_NAMES))

SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_lms": (
        f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS loan_id,
        CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS DATE) AS loan_start_date, 10 AS tenure,
        l_linenumber AS installment_num, CAST(l_extendedprice AS FLOAT) AS loan_amt, CAST(l_tax AS FLOAT) AS due_amt,
        CAST(CASE WHEN l_linestatus = 'F' THEN l_tax END AS FLOAT) AS paid_amt,
        CAST(CASE WHEN l_returnflag = 'R' THEN l_discount ELSE 0 END AS FLOAT) AS overdue_amt,
        CAST(l_quantity AS FLOAT) AS balance, {_MONTH.format('l_shipdate')} AS snapshot_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "lms": (
        """SELECT * REPLACE (coalesce(paid_amt, 0) AS paid_amt),
        CASE WHEN overdue_amt > 0 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
        FROM (SELECT *, CASE WHEN installments_missed > 0
            THEN CAST(snapshot_date - installments_missed * INTERVAL 1 MONTH AS DATE) END AS first_missed_date
        FROM (SELECT *, installment_num AS mob,
            coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)) AS INTEGER), 0) AS installments_missed
        FROM raw_lms))""",
        ("raw_lms",),
    ),
    "label_store": (
        """SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
        FROM lms WHERE mob = 6""",
        ("lms",),
    ),
    "raw_attr": (
        """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
        CASE WHEN c_custkey % 50 <> 0 THEN ' Person ' || CAST(c_custkey % 700 AS VARCHAR) END AS name,
        CAST(CAST(floor(c_acctbal / 50) AS INTEGER) AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN '_' ELSE '' END AS age,
        CASE WHEN c_custkey % 2 = 0 THEN '123-45-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') ELSE '#F%$D@*&8' END AS ssn,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN '_______' ELSE c_mktsegment END AS occupation,
        DATE '2023-01-01' AS snapshot_date FROM customer""",
        (),
    ),
    "raw_fin": (
        f"""SELECT * EXCLUDE (listed), nullif(regexp_replace(listed, ', ([^,]*)$', ', and \\1'), '') AS type_of_loan FROM (
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
        CAST(cents AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN '_' ELSE '' END AS annual_income,
        CAST(CAST(floor(cents / 12.0) AS BIGINT) AS VARCHAR) AS monthly_inhand_salary,
        CAST(coalesce(n, 0) AS VARCHAR) AS num_bank_accounts,
        CAST(coalesce(n0, 0) + coalesce(n1, 0) AS VARCHAR) AS num_credit_card,
        CAST(CASE WHEN c_custkey % 100 = 0 THEN c_custkey + 500 ELSE c_custkey % 35 END AS VARCHAR) AS interest_rate,
        CASE WHEN c_custkey % 30 = 0 THEN '-100' ELSE CAST(coalesce(n2, 0) AS VARCHAR) || '_' END AS num_of_loan,
        CAST(c_custkey % 60 - 5 AS VARCHAR) AS delay_from_due_date,
        CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(c_custkey % 25 AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN '_' ELSE '' END END
            AS num_of_delayed_payment,
        CASE WHEN c_custkey % 20 = 0 THEN '_' ELSE CAST(c_custkey % 30 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR) END
            AS changed_credit_limit,
        CAST(c_custkey % 17 AS VARCHAR) AS num_credit_inquiries, CAST(c_custkey % 5000 AS VARCHAR) || '.25' AS outstanding_debt,
        CAST(c_custkey % 50 AS VARCHAR) || '.5' AS credit_utilization_ratio, CAST(c_custkey % 400 AS VARCHAR) AS total_emi_per_month,
        CASE WHEN c_custkey % 40 = 0 THEN '__10000__' ELSE CAST(c_custkey % 900 AS VARCHAR) END AS amount_invested_monthly,
        CASE WHEN c_custkey % 23 <> 0 THEN CAST(c_custkey % 700 AS VARCHAR) END AS monthly_balance,
        CASE WHEN c_custkey % 4 = 0 THEN yrs || ' Years and ' || mths || ' Months'
             WHEN c_custkey % 4 = 1 THEN yrs || ' Year and ' || mths || ' Month'
             WHEN c_custkey % 4 = 2 THEN yrs || ' Years' END AS credit_history_age,
        CASE c_custkey % 7 WHEN 0 THEN 'High_spent_Small_value_payments' WHEN 1 THEN 'Low_spent_Large_value_payments'
             WHEN 2 THEN '!@9#%8' WHEN 3 THEN 'Low_spent_Medium_value_payments' WHEN 4 THEN 'High_spent_Large_value_payments' END
            AS payment_behaviour,
        CASE c_custkey % 5 WHEN 0 THEN '_' WHEN 1 THEN 'Good' WHEN 2 THEN 'Bad' WHEN 3 THEN 'Standard' END AS credit_mix,
        CASE WHEN c_custkey % 6 = 0 THEN 'NM' WHEN c_custkey % 6 < 3 THEN 'Yes' WHEN c_custkey % 6 < 5 THEN 'No' END
            AS payment_of_min_amount,
        substr(txt, 1, greatest(length(txt) - 2, 0)) AS listed, DATE '2023-01-01' AS snapshot_date
        FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, {_LOANS} AS txt,
              CAST((c_custkey // 12) % 30 AS VARCHAR) AS yrs, CAST(c_custkey % 12 AS VARCHAR) AS mths
              FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, {_COUNTS} FROM orders GROUP BY o_custkey)
              ON c_custkey = o_custkey))""",
        (),
    ),
    "raw_click": (
        f"""SELECT fe_1, fe_2, {_FE}, customer_id, snapshot_date FROM (
        SELECT CASE WHEN user_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
        {_MONTH.format('ts')} AS snapshot_date, CAST(floor(value) AS INTEGER) AS fe_1,
        nullif(CAST(json_extract_string(props, '$.k') AS INTEGER), 7) AS fe_2 FROM events)""",
        (),
    ),
    "scored": (
        f"""SELECT l_orderkey * 8 + l_linenumber AS key, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
        ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000) / CAST(1000 AS DOUBLE) AS score,
        l_discount AS tied, {_MONTH.format('l_shipdate')} AS snapshot_date FROM lineitem""",
        (),
    ),
    "runs": (
        """SELECT strftime(date_trunc('month', l_shipdate), '%Y_%m_%d') AS week_date, l_returnflag AS model_name,
        floor(CAST(sum(l_quantity) AS BIGINT) * 10000 / (count(*) * 50)) / 10000 AS accuracy,
        floor(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) * 10000 / (count(*) * 10)) / 10000 AS macro_f1,
        floor(CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) * 10000 / (count(*) * 10)) / 10000 AS weighted_f1,
        count(*) AS total_samples, max(CAST(l_shipdate AS DATE)) AS evaluation_date
        FROM lineitem GROUP BY 1, 2""",
        (),
    ),
    "graded": (
        """SELECT o_orderkey AS key, o_orderpriority AS label,
        CASE (o_orderkey * 7919 + o_custkey * 31) % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
        WHEN 5 THEN '6-OTHER' ELSE o_orderpriority END AS prediction FROM orders""",
        (),
    ),
    "log_lines": (
        """SELECT CAST(conv_id AS VARCHAR) AS task_id, turn AS line_no, text || CASE
        WHEN (conv_id + turn) % 3 = 1 THEN chr(10) || 'Run_ID: ' || CAST(conv_id * 7919 + turn AS VARCHAR)
        WHEN (conv_id + turn) % 3 = 2 THEN chr(10) || 'macro f1 score: 0.' || lpad(CAST((conv_id * 37 + turn) % 10000 AS VARCHAR), 4, '0')
        ELSE '' END AS text FROM conversations""",
        (),
    ),
}


def sql(select: str, *views: str, **extra: str) -> str:
    """``select`` behind WITH clauses for the named views, their inputs, and ``extra`` ones."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in SQL[name][1]:
            add(need)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    parts = [f"{v} AS ({SQL[v][0]})" for v in order] + [f"{k} AS ({body})" for k, body in extra.items()]
    return f"WITH {', '.join(parts)} {select}" if parts else select
