"""Sources, sinks and streaming ingest, on tables written under the shared scratch folder."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import calendar
from tidemark.operators import quality, reports
from tidemark.plans import bronze, gold, silver
from tidemark.session import scratch_path
from tidemark.sources import metrics, snapshots
from tidemark.streaming.ingest import ingest_available
from tidemark.suite import views
from tidemark.suite.registry import query
from tidemark.suite.views import sql, table

_LMS_DDL = ("loan_id string, customer_id string, loan_start_date string, tenure string, installment_num string, loan_amt string, "
            "due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string")
_PER_MONTH = "SELECT snapshot_date, count(*) AS n, CAST(sum(installment_num) AS BIGINT) AS installments FROM raw_lms {} GROUP BY snapshot_date"


def _per_month(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.sum("installment_num").alias("installments"))


def _lms_csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "lms-csv")
    snapshots.write_csv(views.raw_lms(spark, sf), path)
    return path


def _lms_path(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "lms-table")
    snapshots.write_snapshots(views.raw_lms(spark, sf), path)
    return path


def _lms_table(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.read_table(spark, _lms_path(spark, sf))


# --- scans -------------------------------------------------------------------
@query("s01_csv_scan", sql(
    """SELECT 'given' AS schema_from, count(*) AS n, CAST(sum(installment_num) AS BIGINT) AS installments, count(paid_amt) AS paid FROM raw_lms
    UNION ALL SELECT 'inferred', count(*), CAST(sum(installment_num) AS BIGINT), count(paid_amt) FROM raw_lms""", "raw_lms"))
def _(spark, sf):
    path = _lms_csv(spark, sf)

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("installment_num").try_cast("int")).alias("installments"),
            F.count("paid_amt").alias("paid"),
        ).select(F.lit(name).alias("schema_from"), "*")

    return totals(snapshots.read_csv(spark, path, _LMS_DDL), "given").unionByName(
        totals(snapshots.read_csv(spark, path, infer=True), "inferred")
    )


@query("s02_monthly_ingest", sql(_PER_MONTH.format(""), "raw_lms"))
def _(spark, sf):
    source, target = _lms_csv(spark, sf), scratch_path(spark, "bronze-lms")
    raw = snapshots.read_csv(spark, source, _LMS_DDL)
    bronze.ingest_all(raw, target)
    for _ in range(2):  # a month that is run again replaces itself
        bronze.ingest_month(raw, target, "1997-07-01")
    return _per_month(snapshots.read_table(spark, target).withColumn("installment_num", F.col("installment_num").try_cast("int")))


@query("s03_load_once", sql("SELECT customer_id, age, ssn FROM raw_attr", "raw_attr"))
def _(spark, sf):
    target = scratch_path(spark, "bronze-attributes")
    raw = views.raw_attributes(spark, sf)
    bronze.ingest_static(raw, target)
    bronze.ingest_static(raw.withColumn("age", F.lit("changed")), target)
    return snapshots.read_table(spark, target).select("customer_id", "age", "ssn")


@query("s04_csv_sink", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "customer-csv")
    snapshots.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return snapshots.read_csv(spark, path, "c_custkey long, c_name string, c_mktsegment string")


@query("s05_snapshot_scan", sql(
    """SELECT 'lms' AS table_name, count(*) AS n FROM raw_lms WHERE snapshot_date = DATE '1997-07-01'
    UNION ALL SELECT 'attributes', count(*) FROM raw_attr UNION ALL SELECT 'financials', 0""", "raw_lms", "raw_attr"))
def _(spark, sf):
    root = scratch_path(spark, "silver")
    snapshots.write_snapshots(views.raw_lms(spark, sf), f"{root}/lms")
    snapshots.write_once(views.raw_attributes(spark, sf), f"{root}/attributes")
    read = {t: snapshots.read_silver(spark, root, t, "1997-07-01") for t in ("lms", "attributes", "financials")}
    return snapshots.bundle_counts(spark, read)


@query("s06_multi_month_scan", sql(_PER_MONTH.format(
    "WHERE snapshot_date IN (DATE '1996-05-01', DATE '1996-06-01', DATE '1996-07-01', DATE '2030-01-01')"), "raw_lms"))
def _(spark, sf):
    path = _lms_path(spark, sf)
    return _per_month(snapshots.read_months(spark, path, ["1996_05_01", "1996_06_01", "1996_07_01", "2030_01_01"]))


@query("s07_overwrite_snapshots", sql(_PER_MONTH.format(""), "raw_lms"))
def _(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = views.raw_lms(spark, sf)
    snapshots.write_snapshots(rows.withColumn("installment_num", F.lit(0)), path)
    snapshots.write_snapshots(rows, path)
    return _per_month(snapshots.read_table(spark, path))


@query("s08_static_silver", sql("SELECT customer_id, CAST(TRY_CAST(age AS INTEGER) AS INTEGER) AS age FROM raw_attr", "raw_attr"))
def _(spark, sf):
    path = scratch_path(spark, "silver-attributes")
    rows = silver.attributes_retrofit(views.raw_attributes(spark, sf))
    snapshots.write_once(rows, path)
    snapshots.write_once(rows.withColumn("age", F.lit(-1)), path)
    return snapshots.read_table(spark, path).select("customer_id", "age")


@query("s09_listed_months", sql(_PER_MONTH.format(
    "WHERE snapshot_date IN (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)"), "raw_lms"))
def _(spark, sf):
    months = table(spark, sf, "orders").select(calendar.month_start(F.col("o_orderdate")).alias("snapshot_date"))
    return _per_month(snapshots.semi_join_periods(_lms_table(spark, sf), months))


@query("s10_range_scan", sql(_PER_MONTH.format("WHERE snapshot_date BETWEEN DATE '1996-05-01' AND DATE '1997-04-01'"), "raw_lms"))
def _(spark, sf):
    return _per_month(snapshots.in_range(_lms_table(spark, sf), "1996_05_01", "1997_04_01"))


@query("s11_trailing_weeks", """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, count(*) AS n FROM lineitem
    WHERE CAST(date_trunc('week', l_shipdate) AS DATE) BETWEEN DATE '1998-06-01' - 350 AND DATE '1998-06-01' GROUP BY 1""")
def _(spark, sf):
    weeks = table(spark, sf, "lineitem").select(F.date_trunc("week", F.col("l_shipdate")).cast("date").alias("week"))
    return snapshots.in_trailing_weeks(weeks, "1998-06-01", 50, by="week").groupBy("week").agg(F.count(F.lit(1)).alias("n"))


@query("s12_newest_layout", sql(
    """SELECT snapshot_date, layout, count(*) AS n FROM (SELECT snapshot_date, 'new' AS layout FROM raw_lms WHERE snapshot_date >= DATE '1997-01-01'
    UNION ALL SELECT snapshot_date, 'old' FROM raw_lms WHERE snapshot_date < DATE '1997-01-01') GROUP BY 1, 2""", "raw_lms"))
def _(spark, sf):
    rows = views.raw_lms(spark, sf).select("loan_id", "snapshot_date")
    newer = rows.where("snapshot_date >= date '1997-01-01'").withColumn("layout", F.lit("new"))
    older = rows.where("snapshot_date < date '1998-01-01'").withColumn("layout", F.lit("old"))
    return snapshots.newest_layout(newer, older).groupBy("snapshot_date", "layout").agg(F.count(F.lit(1)).alias("n"))


# --- metric, prediction and tracker tables -----------------------------------
_STORED = "CAST({0} AS DECIMAL(5,4)) AS {0}"


def _metric_rows(spark, sf):
    return views.model_runs(spark, sf).withColumns({
        "mlflow_run_id": F.concat_ws("-", "model_name", "week_date"),
        "f1_by_grade": F.create_map(F.lit("0"), F.col("macro_f1")),
        "predictions_distribution": F.create_map(F.lit("0"), F.col("total_samples")),
        "evaluation_date": F.col("evaluation_date").cast("timestamp"),
        "total_samples": F.col("total_samples").cast("int"),
    })


@query("s13_performance_sink", sql(
    f"""SELECT week_date, model_name, {', '.join(_STORED.format(c) for c in ('accuracy', 'macro_f1', 'weighted_f1'))},
    CAST(total_samples AS INTEGER) AS total_samples FROM runs""", "runs"))
def _(spark, sf):
    path = scratch_path(spark, "performance")
    rows = _metric_rows(spark, sf)
    for part in ("week_date < '1998_01_01'", "week_date >= '1998_01_01'", "week_date >= '1997_06_01'"):  # some weeks are stored twice
        metrics.store_performance(rows.where(part), path)
    return snapshots.read_table(spark, path).select("week_date", "model_name", "accuracy", "macro_f1", "weighted_f1", "total_samples")


@query("s14_metrics_sink", sql(
    f"""SELECT week_date AS month_date, model_name, {_STORED.format('macro_f1')}, CAST(accuracy AS DECIMAL(5,4)) AS auc,
    '{{"0":' || CAST(total_samples AS VARCHAR) || '}}' AS predictions_distribution FROM runs""", "runs"))
def _(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = _metric_rows(spark, sf).withColumnRenamed("week_date", "month_date")
    rows = rows.withColumns({"precision": F.lit(0.5), "recall": F.lit(0.5)})
    for auc in (F.lit(0.1), F.col("accuracy")):  # a run that is evaluated again replaces itself
        metrics.store_metrics(rows.withColumn("auc", auc), path)
    return snapshots.read_table(spark, path).select("month_date", "model_name", "macro_f1", "auc", "predictions_distribution")


@query("s15_inference_sink", sql(
    """SELECT month_partition, count(*) AS n, CAST(sum(predicted_default) AS BIGINT) AS defaults, sum(p) AS probability, count(DISTINCT v) AS versions
    FROM (SELECT strftime(snapshot_date, '%Y_%m_%d') AS month_partition, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_default,
    CAST(score AS DECIMAL(5,4)) AS p, '' AS v FROM scored) GROUP BY 1""", "scored"))
def _(spark, sf):
    path = scratch_path(spark, "inference")
    rows = views.scored(spark, sf).select(
        F.col("key").cast("string").alias("loan_id"), F.col("key").cast("string").alias("customer_id"), "snapshot_date",
        F.when(F.col("score") >= 0.5, 1).alias("predicted_default"), F.col("score").alias("default_probability"),
        F.lit("credit_scoring_model").alias("model_name"), F.lit(None).cast("string").alias("model_version"),
        F.lit("run-1").alias("mlflow_run_id"), F.current_timestamp().alias("inference_date"),
        F.date_format("snapshot_date", "yyyy_MM_dd").alias("month_partition"), F.lit("monthly_inference").alias("execution_context"),
    )
    metrics.store_inference(rows.where("month_partition < '1997'"), path)
    metrics.store_inference(rows.withColumn("default_probability", F.lit(0.5)), path)
    metrics.store_inference(rows, path)  # every month is scored twice or more with the same run
    stored = metrics.read_inference(spark, path, run_id="run-1")
    return stored.groupBy("month_partition").agg(
        F.count(F.lit(1)).alias("n"), F.sum("predicted_default").alias("defaults"),
        F.sum("default_probability").cast("decimal(38,4)").alias("probability"), F.count_distinct("model_version").alias("versions"),
    )


@query("s16_latest_per_period", sql(
    """SELECT week_date, model_name, macro_f1, evaluation_date FROM (SELECT *, row_number() OVER (PARTITION BY week_date
    ORDER BY evaluation_date DESC, model_name) AS rn FROM runs) WHERE rn = 1""", "runs"))
def _(spark, sf):
    return reports.latest_per_period(views.model_runs(spark, sf)).select("week_date", "model_name", "macro_f1", "evaluation_date")


@query("s17_json_tracker", sql(
    """SELECT week_date, model_name, CAST(total_samples AS BIGINT) AS max_depth, macro_f1, length(model_name) AS grade FROM runs""", "runs"))
def _(spark, sf):
    path = scratch_path(spark, "tracker")
    rows = views.model_runs(spark, sf).select(
        "week_date", "model_name", "macro_f1", F.struct(F.col("total_samples").alias("max_depth")).alias("best_params"),
        F.create_map(F.lit("A"), F.length("model_name").cast("long")).alias("grade_mapping"),
    )
    metrics.write_json(rows, path)
    back = metrics.read_json(
        spark, path, "week_date string, model_name string, macro_f1 double, best_params struct<max_depth: bigint>, grade_mapping map<string, bigint>"
    )
    return back.select(
        "week_date", "model_name", "best_params.max_depth", "macro_f1", F.try_element_at("grade_mapping", F.lit("A")).alias("grade")
    )


@query("s18_customer_bundle", sql(
    """SELECT 'attributes' AS table_name, count(*) AS n FROM raw_attr WHERE customer_id = '42' UNION ALL
    SELECT 'lms', count(*) FROM lms WHERE customer_id = '42' UNION ALL SELECT 'clickstream', count(*) FROM raw_click WHERE customer_id = '42'
    UNION ALL SELECT 'absent', 0""", "lms", "raw_attr", "raw_click"))
def _(spark, sf):
    found = snapshots.bundle(
        {"attributes": views.raw_attributes(spark, sf), "lms": views.lms(spark, sf), "clickstream": views.raw_clicks(spark, sf), "absent": None},
        customer_id="42",
    )
    return snapshots.bundle_counts(spark, found)


_PROFILE_TYPES = {
    "loan_id": "string", "customer_id": "string", "loan_start_date": "date", "tenure": "int", "installment_num": "int", "loan_amt": "double",
    "due_amt": "double", "paid_amt": "double", "overdue_amt": "double", "balance": "double",
}


@query("s19_schema_profile", sql(
    "SELECT column_name, count(*) FILTER (WHERE n > 0) AS present_in, count(*) AS declared_in, types, CAST(sum(n) AS BIGINT) AS filled FROM (SELECT "
    + f"unnest({[*_PROFILE_TYPES, 'late']}) AS column_name, unnest({[*_PROFILE_TYPES.values(), 'int']}) AS types, unnest([{', '.join(f'count({c})' for c in _PROFILE_TYPES)},"
    + " CASE WHEN snapshot_date >= DATE '1997-01-01' THEN count(*) END]) AS n FROM raw_lms GROUP BY snapshot_date) WHERE n IS NOT NULL GROUP BY ALL", "raw_lms"))
def _(spark, sf):
    """All months, of which the later ones have one more column, by the catalogue."""
    path = scratch_path(spark, "profile")
    rows = views.raw_lms(spark, sf)
    snapshots.write_snapshots(rows.where("snapshot_date < date '1997-01-01'"), path)
    snapshots.write_snapshots(rows.where("snapshot_date >= date '1997-01-01'").withColumn("late", F.lit(1)), path)
    return quality.period_profile(snapshots.read_table(spark, path), snapshots.declared_columns(spark, path))


@query("s05_catalogue", sql(
    """SELECT strftime(snapshot_date, '%Y-%m-%d') AS period, CASE WHEN snapshot_date >= DATE '1997-01-01' THEN 11 ELSE 10 END AS n_columns FROM raw_lms GROUP BY 1, 2""", "raw_lms"))
def _(spark, sf):
    path = scratch_path(spark, "catalogue")
    rows = views.raw_lms(spark, sf)
    snapshots.write_snapshots(rows, path)
    snapshots.write_snapshots(rows.where("snapshot_date >= date '1997-01-01'").withColumn("late", F.lit(1)), path)
    return snapshots.declared_columns(spark, path).groupBy("period").agg(F.count(F.lit(1)).cast("int").alias("n_columns"))


@query("s07_killed_write", sql(_PER_MONTH.format(""), "raw_lms"))
def _(spark, sf):
    """A write that fails in its middle leaves all months as they were."""
    path = scratch_path(spark, "killed")
    rows = views.raw_lms(spark, sf)
    snapshots.write_snapshots(rows, path)
    broken = F.when(F.col("installment_num") == 4, F.raise_error(F.lit("lost")).cast("int")).otherwise(0)
    for write in (snapshots.write_snapshots, lambda df, at: snapshots.write_snapshot(df, at, "1997-07-01")):
        try:
            write(rows.withColumn("installment_num", broken), path)
        except PySparkException:
            continue
        raise AssertionError("the broken write went through")
    return _per_month(snapshots.read_table(spark, path))


# --- file arrival ------------------------------------------------------------
@query("st01_file_arrival", sql(_PER_MONTH.format(""), "lms"))
def _(spark, sf):
    root = scratch_path(spark, "arrival")
    source = _lms_csv(spark, sf)
    for _ in range(2):  # the second run finds nothing new
        ingest_available(
            spark, source, _LMS_DDL, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", silver.lms, files_per_batch=1000, row_local=True
        ).awaitTermination()
    return _per_month(snapshots.read_table(spark, f"{root}/silver"))


@query("st02_late_rows", sql("SELECT snapshot_date, count(*) AS n, CAST(sum(installment_num) AS BIGINT) AS installments, sum(dpd)::BIGINT AS dpd FROM lms GROUP BY snapshot_date", "lms"))
def _(spark, sf):
    root, source = scratch_path(spark, "late"), scratch_path(spark, "late-csv")
    raw = views.raw_lms(spark, sf)
    early = (F.col("installment_num") != 6)
    for part in (raw.where(early), raw.where(~early)):  # late rows fall into months already stored
        snapshots.write_csv(part, source, mode="append")
        ingest_available(
            spark, source, _LMS_DDL, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", silver.lms, row_local=True
        ).awaitTermination()
    return snapshots.read_table(spark, f"{root}/silver").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("installment_num").alias("installments"), F.sum("dpd").alias("dpd")
    )


@query("st02_rejected_rows", sql(
    """SELECT 'silver' AS place, count(*) AS n, count(DISTINCT snapshot_date) AS months FROM raw_lms WHERE installment_num <> 7 AND NOT (
    installment_num = 6 OR snapshot_date = DATE '1997-07-01')
    UNION ALL SELECT 'rejects', count(*) FILTER (WHERE installment_num = 7), 0 FROM raw_lms""", "raw_lms"))
def _(spark, sf):
    """Rows with unreadable dates are set apart; a month that the recipe empties leaves silver."""
    root, source = scratch_path(spark, "rejects"), scratch_path(spark, "rejects-csv")
    raw = views.raw_lms(spark, sf).withColumn("installment_num", F.col("installment_num").cast("string"))
    day = F.when(F.col("installment_num") == "7", F.lit("not a date")).otherwise(F.col("snapshot_date").cast("string"))
    kept = (F.col("installment_num") != "6") & (F.col("snapshot_date") != F.lit("1997-07-01").cast("date"))
    for part, recipe in ((raw.where("installment_num = 6"), lambda df: df), (raw.where("installment_num <> 6"), lambda df: df.where(kept))):
        snapshots.write_csv(part.withColumn("snapshot_date", F.when(F.lit(True), day)), source, mode="append")
        ingest_available(
            spark, source, _LMS_DDL, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", recipe, rejects=f"{root}/rejects"
        ).awaitTermination()
    silver_rows = snapshots.read_table(spark, f"{root}/silver").where("installment_num <> '6'")
    counts = silver_rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("snapshot_date").alias("months"))
    bad = snapshots.read_table(spark, f"{root}/rejects").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("months"))
    return counts.select(F.lit("silver").alias("place"), "n", "months").unionByName(bad.select(F.lit("rejects").alias("place"), "n", "months"))
