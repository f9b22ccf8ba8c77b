"""Sinks, idempotence, streaming ingest, the gold build and models."""

import decimal
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import session
from tidemark.operators import models
from tidemark.plans import bronze, gold, lifecycle, silver
from tidemark.sources import metrics, snapshots
from tidemark.streaming.ingest import ingest_available


def months(spark, *pairs):
    return spark.createDataFrame([(k, date.fromisoformat(d)) for k, d in pairs], "k string, snapshot_date date")


def test_month_rerun_replaces_only_that_month(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshots(months(spark, ("a", "2024-01-01"), ("b", "2024-02-01")), path)
    snapshots.write_snapshots(months(spark, ("c", "2024-02-01")), path)
    assert rows(snapshots.read_table(spark, path), "k") == [("a",), ("c",)]
    snapshots.write_snapshot(months(spark, ("x", "2024-03-01")), path, "2024-01-01")  # now empty
    assert rows(snapshots.read_table(spark, path), "k") == [("c",)]


def test_static_load_once(spark, tmp_path):
    path = str(tmp_path / "t")
    bronze.ingest_static(spark.createDataFrame([("a",)], "K string"), path)
    bronze.ingest_static(spark.createDataFrame([("b",)], "K string"), path)
    assert rows(snapshots.read_table(spark, path), "k") == [("a",)]


def test_missing_table_is_none(spark, tmp_path):
    assert snapshots.read_table(spark, str(tmp_path / "nothing")) is None
    assert snapshots.read_silver(spark, str(tmp_path), "attributes", "2024-01-01") is None


def test_period_filters_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshots(months(spark, *[(str(i), f"2024-{i:02d}-01") for i in range(1, 13)]), path)
    df = snapshots.read_table(spark, path)
    assert rows(snapshots.in_months(df, ["2024_02_01", "2030_01_01"]), "k") == [("2",)]
    narrowed = snapshots.in_range(df, "2024_02_01", "2024_04_01")
    assert rows(narrowed, "k") == [("2",), ("3",), ("4",)]
    assert len(narrowed.inputFiles()) >= 3
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_newest_layout(spark):
    newer = months(spark, ("new", "2024-02-01"))
    older = months(spark, ("old", "2024-01-01"), ("old", "2024-02-01"))
    assert rows(snapshots.newest_layout(newer, older), "k", "snapshot_date") == [("new", date(2024, 2, 1)), ("old", date(2024, 1, 1))]


def test_trailing_weeks_has_both_ends(spark):
    weeks = spark.sql("select explode(sequence(date'2021-01-03', date'2023-03-05', interval 7 day)) snapshot_date")
    assert snapshots.in_trailing_weeks(weeks, "2023-01-01", 50).count() == 51


def test_metric_sinks(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame(
        [("2024_01_01", "r", "m", 0.123456, 0.5, 0.5, 7)],
        "week_date string, mlflow_run_id string, model_name string, accuracy double, macro_f1 double, weighted_f1 double, total_samples long",
    ).withColumn("f1_by_grade", F.create_map(F.lit("A"), F.lit(0.5)))
    metrics.store_performance(df, path)
    metrics.store_performance(df.withColumn("mlflow_run_id", F.lit("other")), path)
    metrics.store_performance(df, path)  # the same week, run and model once more
    stored = snapshots.read_table(spark, path)
    row = stored.where("mlflow_run_id = 'r'").first()
    assert stored.count() == 2 and row.accuracy == decimal.Decimal("0.1235") and row.f1_by_grade == '{"A":0.5}'
    assert row.evaluation_date is not None and row.predictions_distribution is None


def test_inference_defaults(spark, tmp_path):
    path = str(tmp_path / "i")
    df = spark.createDataFrame([("l1", None, None)], "loan_id string, predicted_default int, default_probability double").withColumns({
        "customer_id": F.lit("c"), "snapshot_date": F.lit("2024-01-01").cast("date"), "model_name": F.lit("m"),
        "model_version": F.lit(None).cast("string"), "mlflow_run_id": F.lit(None).cast("string"), "month_partition": F.lit("2024_01_01"),
    })
    metrics.store_inference(df, path)
    metrics.store_inference(df.withColumn("mlflow_run_id", F.lit("b")), path)
    metrics.store_inference(df, path)
    assert rows(metrics.read_inference(spark, path), "loan_id", "mlflow_run_id") == [("l1", ""), ("l1", "b")]
    assert metrics.read_inference(spark, path, "2024_01_01", "b").count() == 1 and metrics.read_inference(spark, path, "2025_01_01").count() == 0
    row = metrics.read_inference(spark, path, run_id="").first()
    assert (row.predicted_default, row.default_probability, row.model_version, row.month_partition) == (0, 0, "", "2024_01_01")


def test_tracker_json_round_trip(spark, tmp_path):
    path = str(tmp_path / "j")
    df = spark.sql("select 'x' model_type, named_struct('max_depth', 4) best_params, map('A', 0) grade_mapping")
    metrics.write_json(df, path)
    back = metrics.read_json(spark, path, "model_type string, best_params struct<max_depth:int>, grade_mapping map<string,int>").first()
    assert back.best_params.max_depth == 4 and back.grade_mapping == {"A": 0}


def test_streaming_ingest_is_idempotent_and_merges_late_rows(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    schema = "k string, snapshot_date string"

    def arrive(df):
        snapshots.write_csv(df, source, mode="append")

    def run():
        ingest_available(spark, source, schema, f"{root}/b", f"{root}/s", f"{root}/c", lambda df: df).awaitTermination()
        return rows(snapshots.read_table(spark, f"{root}/s"), "k", "snapshot_date")

    arrive(months(spark, ("a", "2024-01-01"), ("b", "2024-02-01")))
    first = run()
    assert first == [("a", date(2024, 1, 1)), ("b", date(2024, 2, 1))]
    assert run() == first
    arrive(months(spark, ("late", "2024-01-01")))
    assert run() == [("a", date(2024, 1, 1)), ("b", date(2024, 2, 1)), ("late", date(2024, 1, 1))]


def test_gold_needs_static_tables(spark, tmp_path):
    assert gold.write_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), "2024-01-01") is False


def test_gold_month(spark, tmp_path):
    silver_dir, gold_dir, d = str(tmp_path / "silver"), str(tmp_path / "gold"), "2024-01-01"
    day = F.lit(d).cast("date")
    one = spark.range(1)
    snapshots.write_once(one.select(F.lit("C1").alias("customer_id"), F.lit(30).alias("age"), F.lit("x").alias("occupation"), day.alias("snapshot_date")), f"{silver_dir}/attributes")
    snapshots.write_once(one.select(F.lit("C1").alias("customer_id"), F.lit(1.0).alias("income"), day.alias("snapshot_date")), f"{silver_dir}/financials")
    snapshots.write_snapshots(one.select(F.lit("C1").alias("customer_id"), F.lit(5).alias("fe_1"), day.alias("snapshot_date")), f"{silver_dir}/clickstream")
    snapshots.write_snapshots(one.select(F.lit("L1").alias("loan_id"), F.lit("C1").alias("customer_id"), F.lit(6).alias("mob"), F.lit(31).alias("dpd"), day.alias("snapshot_date")), f"{silver_dir}/lms")
    for _ in range(2):
        assert gold.write_gold(spark, silver_dir, gold_dir, d)
    labels = snapshots.read_table(spark, f"{gold_dir}/label_store")
    features = snapshots.read_table(spark, f"{gold_dir}/feature_store")
    assert rows(labels, "loan_id", "label", "label_def") == [("L1", 1, "30dpd_6mob")]
    assert rows(features, "loan_id", "age", "income", "fe_1") == [("L1", 30, 1.0, 5)]
    joined = lifecycle.window_rows(features, labels, "2024_06_01")
    assert joined.count() == 1 and lifecycle.window_rows(features, labels, "2024_01_01").count() == 0


def test_scratch_follows_the_session(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


# --- models ------------------------------------------------------------------
@pytest.fixture(scope="module")
def loans(spark):
    return spark.range(2000).select(
        F.col("id").cast("string").alias("loan_id"), F.col("id").cast("string").alias("customer_id"), F.lit("2024-01-01").cast("date").alias("snapshot_date"),
        (F.col("id") % 10).cast("double").alias("a"), F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("b"),
        ((F.col("id") % 10 > 6) | (F.col("id") % 31 == 0)).cast("int").alias("label"),
    )


def test_training_scoring_and_report(spark, loans):
    fitted, scores = lifecycle.train_candidates(loans, ["a", "b"], n_estimators=3)
    assert all(r.auc > 0.9 for r in scores.collect()) and set(fitted) == {"LightGBM", "CatBoost"}
    table, report = lifecycle.monthly_inference(fitted["CatBoost"], loans, ["a", "b"], "2024_01_01", "1", "run")
    assert table.count() == 2000 and table.where("default_probability between 0 and 1").count() == 2000
    assert report.first().auc > 0.9
    top = models.feature_importances(spark, fitted["LightGBM"], ["a", "b"], 1).first()
    assert top.feature == "a"


def test_retrain_prepares_the_registry_rows(spark, loans):
    features = loans.drop("label", "customer_id")
    labels = loans.select("loan_id", "label", "snapshot_date")
    versions = spark.createDataFrame([("credit_scoring_model", "3", "Production", "r")], "name string, version string, stage string, run_id string")
    out = lifecycle.retrain(features, labels, versions, "2024_06_01", n_estimators=2)
    assert out["features"] == ["a", "b"] and out["scores"].count() == 2
    assert out["version"].first().version == "4" and out["version"].first().stage == "Production"
    tracker = out["tracker"].first()
    assert (tracker.last_retraining_date, tracker.model_version) == ("2024-06-01", "4")
    assert tracker.macro_f1_score > 0.9


def test_bronze_month_from_text(spark, tmp_path):
    source, target = str(tmp_path / "csv"), str(tmp_path / "bronze")
    snapshots.write_csv(months(spark, ("007", "2024-01-01"), ("8", "2024-02-01")).withColumnRenamed("k", "K"), source)
    bronze.bronze_table(spark, source, target, "2024-01-01", static=False)
    assert rows(snapshots.read_table(spark, target), "k", "snapshot_date") == [("007", date(2024, 1, 1))]


def test_draws_are_reproducible_and_in_range():
    draws = models.draw_settings(20)
    assert draws == models.draw_settings(20) and len(draws) == 20
    assert all(100 <= d["n_estimators"] <= 1000 and d["n_estimators"] % 50 == 0 and 3 <= d["max_depth"] <= 10 for d in draws)


def test_external_model_scores_every_row(spark, loans):
    got = models.score_with(loans, ["a"], ["loan_id"], lambda x: x[:, 0] * 2)
    assert got.count() == 2000 and got.agg(F.sum("score")).first()[0] == 18000.0


def test_load_once_repairs_a_failed_first_load(spark, tmp_path):
    path = tmp_path / "static"
    path.mkdir()  # what a failed write leaves: a folder without a commit marker
    one = spark.range(1).select(F.col("id"))
    snapshots.write_once(one, str(path))
    snapshots.write_once(one.withColumn("id", F.lit(9).cast("long")), str(path))
    assert rows(snapshots.read_table(spark, str(path)), "id") == [(0,)]


def test_months_with_different_columns_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.lit("2024-01-01").cast("date")
    snapshots.write_snapshot(spark.range(1).select(F.col("id"), day.alias("snapshot_date")), path, "2024-01-01")
    later = F.lit("2024-02-01").cast("date")
    snapshots.write_snapshot(spark.range(1).select(F.col("id"), F.lit(5).alias("y"), later.alias("snapshot_date")), path, "2024-02-01")
    assert rows(snapshots.read_table(spark, path), "snapshot_date", "y") == [(date(2024, 1, 1), None), (date(2024, 2, 1), 5)]


def test_silver_is_written_by_month_and_once(spark, tmp_path):
    root = str(tmp_path)
    fin = spark.createDataFrame([("C1", "Auto Loan", "2024-01-01")], "customer_id string, type_of_loan string, snapshot_date string")
    columns = {c: F.lit(None).cast("string") for c in (*silver.fv.FINANCIAL_TYPES, "credit_history_age", "payment_behaviour", "credit_mix", "payment_of_min_amount")}
    snapshots.write_once(fin.withColumns(columns), f"{root}/b/financials")
    assert silver.write_silver(spark, f"{root}/b", f"{root}/s", "financials", "2024-01-01", "main") is True
    assert silver.write_silver(spark, f"{root}/b", f"{root}/s", "lms", "2024-01-01", "main") is False
    assert snapshots.read_table(spark, f"{root}/s/financials").count() == 1
    assert "auto_loan" in snapshots.read_table(spark, f"{root}/s/loan_type").columns
    assert gold.write_gold(spark, f"{root}/s", f"{root}/g", "2024-01-01", "main") is False


def test_scoring_a_month_without_a_feature(spark, loans):
    model = models.train_boosted(loans.withColumn("extra", F.col("a") * 0 + 1), ["a", "b", "extra"], n_estimators=2)
    table, metrics = lifecycle.monthly_inference(model, loans, ["a", "b", "extra"], "2024_01_01", "1", "r")
    assert table.count() == loans.count() and metrics.first().total_samples == loans.count()


def test_skipped_rounds_are_not_kept(spark, loans):
    model = models.train_boosted_early_stop(loans, ["a", "b"], F.col("b") % 5 == 0, n_estimators=4)
    assert 1 <= len(model.rounds) <= model.fitted_rounds <= 4


def test_nested_tuning(spark):
    data = [(f"L{i}", int((i * 7) % 10 < 3), float((i * 7) % 10), float(i % 3)) for i in range(400)]
    df = spark.createDataFrame(data, "loan_id string, label int, a double, b double")
    ranges = {**models.SEARCH_RANGES, "n_estimators": (2, 3, 1), "max_depth": (3, 3)}
    model, params, report = lifecycle.tune_and_refit(df, ["a", "b"], sample_share=0.5, trials=2, ranges=ranges)
    row = report.first()
    assert params["max_depth"] == 3 and row.roc_auc == pytest.approx(1.0) and 50 < row.total_loans < 110


def test_loaded_silver_is_not_made_again(spark, tmp_path, monkeypatch):
    made = []
    recipes = {name: (lambda raw, name=name: made.append(name) or raw) for name in ("attributes", "financials", "loan_type")}
    monkeypatch.setitem(silver.RECIPES, "main", recipes)
    for table in ("attributes", "financials"):
        bronze.ingest_static(spark.createDataFrame([("c1", "x")], "customer_id string, v string"), f"{tmp_path}/b/{table}")
    for day in ("2024-01-01", "2024-02-01"):
        for table in ("attributes", "financials"):
            assert silver.write_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", table, day, "main") is True
    assert made == ["attributes", "financials", "loan_type"]
    assert snapshots.read_table(spark, f"{tmp_path}/s/loan_type").count() == 1
