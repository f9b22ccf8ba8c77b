"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality, reports
from tidemark.operators.columns import at_mob
from tidemark.operators.skew import left_join_chain
from tidemark.plans import gold, silver
from tidemark.session import scratch_path
from tidemark.sources import snapshots
from tidemark.suite import views
from tidemark.suite.registry import query, r6
from tidemark.suite.views import sql, table

_COLS = ("customer_id", "installment_num", "loan_amt", "paid_amt", "overdue_amt", "snapshot_date")


def _differs(c: str) -> str:
    return f"(count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END > 1)"


@query("q03_duplicate_report", sql(
    "SELECT loan_id, count(*) AS count, concat_ws(',', " + ", ".join(f"CASE WHEN {_differs(c)} THEN '{c}' END" for c in sorted(_COLS))
    + ") AS differing, CAST(NOT (" + " OR ".join(_differs(c) for c in _COLS) + ") AS INTEGER) AS exact_duplicate FROM raw_lms GROUP BY loan_id HAVING count(*) > 1",
    "raw_lms"))
def _(spark, sf):
    loans = views.raw_lms(spark, sf).select("loan_id", *_COLS)
    report = quality.duplicate_report(loans, "loan_id")
    return report.select("loan_id", "count", F.array_join("differing_columns", ",").alias("differing"), "exact_duplicate")


_SEEN = """SELECT id, sum(f) AS f, sum(l) AS l FROM (SELECT o_orderkey AS id, 1 AS f, 0 AS l FROM orders UNION ALL
    SELECT l_orderkey, 0, 1 FROM lineitem) GROUP BY id"""


def _sides(spark, sf):
    return (
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")),
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")),
    )


@query("q04_missing_ids", sql(
    "SELECT id, CASE WHEN l = 0 THEN 'labels' ELSE 'features' END AS missing_in FROM seen WHERE f = 0 OR l = 0", seen=_SEEN))
def _(spark, sf):
    return quality.missing_ids(*_sides(spark, sf), "id")


@query("q04_missing_summary", sql(
    """SELECT CAST(sum(f) AS BIGINT) AS feature_rows, CAST(sum(l) AS BIGINT) AS label_rows, count(*) FILTER (WHERE f > 0) AS feature_ids,
    count(*) FILTER (WHERE l > 0) AS label_ids, count(*) FILTER (WHERE l = 0) AS missing_in_labels,
    count(*) FILTER (WHERE f = 0) AS missing_in_features FROM seen""", seen=_SEEN))
def _(spark, sf):
    return quality.missing_summary(*_sides(spark, sf), "id")


_PROFILED = ("age", "name", "occupation", "ssn")
_MAIN_ATTR = """SELECT customer_id, name, CASE WHEN a BETWEEN 0 AND 120 THEN a END AS age,
    CASE WHEN regexp_matches(ssn, '^\\d{3}-\\d{2}-\\d{4}$') THEN ssn END AS ssn, nullif(occupation, '_______') AS occupation
    FROM (SELECT *, CAST(nullif(regexp_extract(age, '([-+]?\\d*\\.?\\d+)', 1), '') AS INTEGER) AS a FROM raw_attr)"""


@query("q05_null_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total_rows, round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct FROM attr"
    for c in _PROFILED), "raw_attr", attr=_MAIN_ATTR))
def _(spark, sf):
    cleaned = silver.attributes_main(views.raw_attributes(spark, sf))
    return quality.null_profile(cleaned, _PROFILED).withColumn("null_pct", r6("null_pct"))


@query("q06_partition_inventory", sql(
    """SELECT strftime(date_trunc('year', l_shipdate), '%Y_%m_%d') AS period, count(*) AS record_count,
    count(DISTINCT date_trunc('month', l_shipdate)) AS snapshot_dates, 0 AS has_grade, 1 AS has_label FROM lineitem GROUP BY 1"""))
def _(spark, sf):
    rows = views.scored(spark, sf)
    year = F.date_format(F.trunc("snapshot_date", "year"), "yyyy_MM_dd")
    return quality.partition_inventory(rows, year, flags=("grade", "label"))


@query("q07_partition_comparison", """SELECT c.d AS period, c.n AS feature_count, o.n AS label_count, c.n - o.n AS difference,
    CASE WHEN o.n IS NULL THEN 'feature_only' ELSE 'both' END AS presence FROM
    (SELECT strftime(date_trunc('week', l_shipdate), '%Y_%m_%d') AS d, count(*) AS n FROM lineitem GROUP BY 1) c LEFT JOIN
    (SELECT strftime(date_trunc('week', o_orderdate), '%Y_%m_%d') AS d, count(*) AS n FROM orders GROUP BY 1) o ON c.d = o.d
    UNION ALL SELECT d, NULL, n, NULL, 'label_only' FROM (SELECT strftime(date_trunc('week', o_orderdate), '%Y_%m_%d') AS d, count(*) AS n
    FROM orders GROUP BY 1) WHERE d NOT IN (SELECT strftime(date_trunc('week', l_shipdate), '%Y_%m_%d') FROM lineitem)""")
def _(spark, sf):
    def weeks(name: str, column: str):
        week = F.date_format(F.date_trunc("week", F.col(column)), "yyyy_MM_dd")
        return quality.partition_inventory(table(spark, sf, name).select(column), week, snapshot=None)

    return quality.compare_partitions(weeks("lineitem", "l_shipdate"), weeks("orders", "o_orderdate"))


@query("q08_availability", """SELECT period, CAST(1 + CASE WHEN clicks IS NULL THEN 2 ELSE 0 END + CASE WHEN loans IS NULL THEN 2 ELSE 0 END
    + CASE WHEN period > DATE '1996-01-01' THEN 1 ELSE 0 END - 1 AS BIGINT) AS n_missing,
    CASE WHEN clicks IS NOT NULL AND loans IS NOT NULL AND period <= DATE '1996-01-01' THEN 'data_available' ELSE 'data_unavailable' END AS status
    FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders)
    LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS loans FROM lineitem) ON loans = period
    LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS clicks FROM lineitem WHERE l_returnflag = 'A') ON clicks = period""")
def _(spark, sf):
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period")
    lines = table(spark, sf, "lineitem")
    loans = lines.select(month).distinct().withColumn("table", F.lit("lms"))
    clicks = lines.where("l_returnflag = 'A'").select(month).distinct().withColumn("table", F.lit("clickstream"))
    # of the static tables, financials silver is absent
    static = table(spark, sf, "region").agg(F.count(F.lit(1))).select(
        F.explode(F.array(*[F.struct(F.lit(l).alias("layer"), F.lit(t).alias("table")) for l, t in (
            ("bronze", "attributes"), ("silver", "attributes"), ("bronze", "financials"))])).alias("s")
    ).select("s.layer", "s.table", F.lit(None).cast("date").alias("period"))
    monthly = loans.unionByName(clicks).withColumn("layer", F.explode(F.array(F.lit("bronze"), F.lit("silver"))))
    periods = table(spark, sf, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period")).distinct()
    return quality.availability(monthly.unionByName(static), periods, "1996-01-01")


@query("q08_stored_availability", """SELECT period, CAST(CASE WHEN clicks IS NULL THEN 2 ELSE 0 END + CASE WHEN loans IS NULL THEN 2 ELSE 0 END
    + CASE WHEN period > DATE '1996-01-01' THEN 1 ELSE 0 END AS BIGINT) AS n_missing,
    CASE WHEN clicks IS NOT NULL AND loans IS NOT NULL AND period <= DATE '1996-01-01' THEN 'data_available' ELSE 'data_unavailable' END AS status
    FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders)
    LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS loans FROM lineitem) ON loans = period
    LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS clicks FROM lineitem WHERE l_returnflag = 'A') ON clicks = period""")
def _(spark, sf):
    """What is there is read from the stored tables' catalogues; of the static tables, financials silver was never loaded."""
    root = scratch_path(spark, "stored")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("snapshot_date")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", month)
    customers = table(spark, sf, "customer").select("c_custkey")
    for layer in ("bronze", "silver"):
        snapshots.write_snapshots(lines, f"{root}/{layer}/lms")
        snapshots.write_snapshots(lines.where("l_returnflag = 'A'"), f"{root}/{layer}/clickstream")
        for name in ("attributes", "financials") if layer == "bronze" else ("attributes",):
            snapshots.write_once(customers, f"{root}/{layer}/{name}")
    found = snapshots.inventory(spark, {layer: f"{root}/{layer}" for layer in ("bronze", "silver")}, ("lms", "clickstream", "attributes", "financials"))
    periods = table(spark, sf, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period")).distinct()
    return quality.availability(found, periods, "1996-01-01")


@query("q09_join_audit", sql(
    """SELECT 'anchor' AS step, count(*) AS n_rows FROM lms WHERE mob = 6 UNION ALL SELECT 'with_attributes', count(*) FROM lms LEFT JOIN raw_attr USING (customer_id)
    WHERE mob = 6 UNION ALL SELECT 'with_clicks', count(*) FROM lms l LEFT JOIN raw_click c ON l.customer_id = c.customer_id WHERE mob = 6
    UNION ALL SELECT 'click_customers', count(*) FROM (SELECT customer_id FROM lms WHERE mob = 6 INTERSECT SELECT customer_id FROM raw_click)""",
    "lms", "raw_attr", "raw_click"))
def _(spark, sf):
    anchor = at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id")
    attributes = views.raw_attributes(spark, sf).select("customer_id", "occupation")
    clicks = views.raw_clicks(spark, sf).select("customer_id", "fe_1")
    joined = left_join_chain(anchor, [attributes], "customer_id", ["loan_id"])
    # the audit needs only how many click rows a customer has, so they are counted, not joined
    per_customer = clicks.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    rows = left_join_chain(joined, [per_customer], "customer_id", ["loan_id"]).agg(
        F.sum(F.coalesce("n", F.lit(1))).alias("n_rows")).select(F.lit("with_clicks").alias("step"), "n_rows")
    return quality.join_audit({
        "anchor": anchor, "with_attributes": joined,
        "click_customers": quality.key_intersection(anchor, clicks, ["customer_id"]),
    }).unionByName(rows)


@query("q10_gold_check", sql(
    """SELECT 'label' AS column_name, count(*) - count(label) AS null_count, count(*) AS total_rows, 5 AS n_columns FROM label_store UNION ALL
    SELECT 'snapshot_date', count(*) - count(snapshot_date), count(*), 5 FROM label_store""", "label_store"))
def _(spark, sf):
    return quality.gold_check(gold.label_store(views.lms(spark, sf)), ["label", "snapshot_date", "not_there"]).drop("null_pct")


@query("q11_evaluate_production", sql(
    """SELECT day, strftime(day - 7, '%Y_%m_%d') AS prev_week, CASE WHEN day = DATE '1998-03-08' THEN NULL ELSE model_name END AS model_name,
    CASE WHEN day = DATE '1998-03-08' THEN NULL ELSE macro_f1 END AS macro_f1,
    CASE WHEN day = DATE '1998-03-08' THEN 'Week after retraining event, skipping evaluation.' WHEN model_name IS NULL
    THEN 'No metrics for previous week ' || strftime(day - 7, '%Y_%m_%d') ELSE 'success' END AS message
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) LEFT JOIN (SELECT week_date, model_name, macro_f1, row_number() OVER
    (PARTITION BY week_date ORDER BY evaluation_date DESC, model_name) AS rn FROM runs) ON rn = 1 AND week_date = strftime(day - 7, '%Y_%m_%d')""", "runs"))
def _(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    row = reports.evaluate_production(days, views.model_runs(spark, sf), F.lit("1998-03-01").cast("date"))
    return row.select("day", "prev_week", "model_name", "macro_f1", "message")
