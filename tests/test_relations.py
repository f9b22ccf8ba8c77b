"""Skewed joins, features, quality, reports and registry on small rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import features as feats, quality, registry as runs, reports
from pyspark.ml.functions import vector_to_array

from tidemark.functions import text
from tidemark.operators import drift, evaluation, indicators
from tidemark.operators.skew import heavy_grid, heavy_keys, left_join_chain, left_join_grid
from tidemark.plans import gold
from tidemark.sources import snapshots


# --- skew --------------------------------------------------------------------
@pytest.fixture(scope="module")
def hot(spark):
    left = spark.range(300).select(
        F.when(F.col("id") < 100, "hot").when(F.col("id") < 150, F.lit(None)).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    right = spark.range(120).select(
        F.when(F.col("id") < 60, "hot").when(F.col("id") < 70, F.lit(None)).otherwise((F.col("id") % 25).cast("string")).alias("k"),
        F.col("id").alias("m"),
    )
    return left, right


def test_heavy_keys_are_found_and_bounded(hot):
    left, right = hot
    assert set(heavy_keys(left, "k", share=0.1, rows_per_task=10)) == {"hot", None}
    assert heavy_keys(left, "k") == {}
    assert len(heavy_keys(right, "k", share=0.05, rows_per_task=1)) <= 20


def test_salted_chain_equals_plain_left_joins(hot):
    left, right = hot
    other = right.select("k", (F.col("m") * 2).alias("o")).where("m % 2 = 0 or k is null")
    plain = left.join(right, "k", "left").join(other, "k", "left")
    heavy = heavy_keys(left, "k", share=0.1, rows_per_task=10)
    salted = left_join_chain(left, [right, other], "k", ["n"], heavy)
    assert rows(salted, "k", "n", "m", "o") == rows(plain, "k", "n", "m", "o")


@pytest.mark.parametrize("rows_per_task,pairs_per_task", [(5, 10**9), (1000, 50), (7, 60), (10**9, 10**9)])
def test_grid_equals_plain_left_join(hot, rows_per_task, pairs_per_task):
    left, right = hot
    grid = heavy_grid(left, right, "k", 0.05, rows_per_task, pairs_per_task)
    assert ("hot" in grid) == (rows_per_task < 10**9) and ((None in grid) == (rows_per_task < 50))
    got = left_join_grid(left, right, "k", ["n"], ["m"], grid)
    assert got.columns == ["k", "n", "m"] and rows(got, "k", "n", "m") == rows(left.join(right, "k", "left"), "k", "n", "m")


def test_grid_evens_out_a_key_hot_on_both_sides(spark):
    """One key holds 30 % of both sides: no task reads or makes much more than the others."""
    def side(n, name):
        return spark.range(n).select(F.when(F.col("id") % 10 < 3, -1).otherwise(F.col("id") % 700).alias("k"), F.col("id").alias(name))

    left, right = side(6_000, "n"), side(4_000, "m")
    grid = heavy_grid(left, right, "k", rows_per_task=120, pairs_per_task=14_400)
    assert set(grid) == {-1} and grid[-1] == (15, 10)
    pairs = left_join_grid(left, right, "k", ["n"], ["m"], grid).select("k", F.xxhash64("n").alias("n"), F.xxhash64("m").alias("m"))
    heavy = pairs.where("k = -1").groupBy(F.pmod("n", F.lit(15)).alias("i"), F.pmod("m", F.lit(10)).alias("j")).agg(F.count(F.lit(1)).alias("c")).toPandas()["c"]
    assert len(heavy) == 150 and heavy.sum() == 1_800 * 1_200 and heavy.max() < 2 * heavy.median()


# --- sparse indicators -------------------------------------------------------
def test_sparse_equals_wide(spark):
    data = [(1, "Auto Loan, and Home Loan, Auto Loan", "a"), (2, None, "b"), (3, "Home Loan", None), (3, "Home Loan", "a"), (4, "", "ü")]
    df = spark.createDataFrame(data, "id int, listed string, mix string")
    names = text.loan_type_names(F.col("listed"))
    vectors, codes = indicators.sparse_indicators(df, {"loan": names, "mix": F.array("mix")}, counts=True)
    places = {(r["column"], r["value"]): r["code"] for r in codes.collect()}
    assert sorted(places.values()) == list(range(len(places))) and sorted(places) == [k for k, _ in sorted(places.items(), key=lambda x: x[1])]
    wide = df.withColumn("c", text.loan_type_counts(F.col("listed"))).select(
        "id", "mix", *[text.count_of(F.col("c"), v).alias(f"loan_{v}") for c, v in places if c == "loan"],
    )
    got = [(r["id"], r["mix"], *[int(r["v"][places["loan", c.removeprefix("loan_")]]) for c in wide.columns[2:]])
           for r in vectors.select("id", "mix", vector_to_array("indicators").alias("v")).collect()]
    assert sorted(got, key=repr) == rows(wide, *wide.columns)
    one_hot = feats.one_hot(df.select("id", "mix"), {"mix": ["a", "b", "ü"]})
    again, _ = indicators.sparse_indicators(df.select("id", "mix"), {"mix": F.array("mix")}, codes=codes)
    got = [(r["id"], *[int(r["v"][places["mix", m]]) for m in "abü"]) for r in again.select("id", vector_to_array("indicators").alias("v")).collect()]
    assert sorted(got, key=repr) == rows(one_hot, *one_hot.columns)
    none, empty = indicators.sparse_indicators(df.limit(0), {"mix": F.array("mix")})
    assert none.count() == 0 and empty.count() == 0


def test_many_names_stay_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    fetched = []
    monkeypatch.setattr(Frame, "collect", lambda self, f=Frame.collect: (lambda r: fetched.append(len(r)) or r)(f(self)))
    df = spark.range(200_000).select("id", F.array(F.col("id").cast("string"), F.lit("common")).alias("v"))
    vectors, codes = indicators.sparse_indicators(df, {"v": F.col("v")})
    assert codes.count() == 200_001 and vectors.count() == 200_000
    assert max(fetched, default=0) < 100
    first = vectors.where("id = 17").first()["indicators"]
    assert first.size == 200_001 and list(first.values) == [1.0, 1.0]


# --- stored summaries --------------------------------------------------------
def test_months_are_summed_up_once(spark, tmp_path):
    path = str(tmp_path / "s")
    data = [(i, i % 3 == 0 and 1 or 0, (i * 7 % 100) / 100, date(2024, 1 + i % 4, 1)) for i in range(400)] + [(900, None, 0.5, date(2024, 4, 1)), (901, 1, None, date(2024, 4, 1))]
    df = spark.createDataFrame(data, "key int, label int, score double, snapshot_date date")
    for day in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-04-01"):
        drift.store_summaries(df.where(F.col("snapshot_date") == F.lit(day).cast("date")), path)
    now, before = ["2024-03-01", "2024-04-01"], ["2024-01-01", "2024-02-01"]
    got = drift.monitor(spark, path, now, before).first()
    late = df.where("snapshot_date >= date '2024-03-01'")
    want = evaluation.loan_default_report(late).first()
    for c in ("roc_auc", "ks_statistic", "gini_coefficient", "pr_auc"):
        assert got[c] == pytest.approx(want[c])
    assert got["n"] == 200 and got["positives"] == late.where("label = 1 and score is not null").count()
    assert got["score_psi"] == pytest.approx(drift.psi(df.where("snapshot_date < date '2024-03-01'"), late, "score").first()["psi"])


# --- stored layouts ----------------------------------------------------------
def test_bucketed_sides_are_not_shuffled(spark, tmp_path):
    names = []
    for i in range(3):
        names.append(f"b{i}_{tmp_path.name}".replace("-", "_"))
        snapshots.write_bucketed(spark.range(1000).select((F.col("id") % (200 + i)).alias("k"), (F.col("id") * i).alias(f"v{i}")), names[-1], "k", 8)
    anchor, *sides = [spark.table(n).hint("merge") for n in names]
    plan = left_join_chain(anchor, sides, "k", ["v0"], {})
    told = plan._jdf.queryExecution().executedPlan().toString()
    assert told.count("SortMergeJoin") == 2 and "Exchange" not in told
    plain = [spark.range(1000).select((F.col("id") % (200 + i)).alias("k"), (F.col("id") * i).alias(f"v{i}")) for i in range(3)]
    assert rows(plan, "k", "v0", "v1", "v2") == rows(plain[0].join(plain[1], "k", "left").join(plain[2], "k", "left"), "k", "v0", "v1", "v2")


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", F.when(F.col("id") < 30, F.lit("2024-01-01")).otherwise("2024-02-01").cast("date").alias("snapshot_date"))
    snapshots.write_snapshots(df, path)
    snapshots.write_snapshots(df.where("id = 5"), path)
    counts = snapshots.period_counts(spark, path)
    assert rows(counts, "snapshot_date", "record_count") == [(date(2024, 1, 1), 1), (date(2024, 2, 1), 70)]
    told = counts._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in told and "PushedGroupBy: [snapshot_date" in told
    assert snapshots.period_counts(spark, str(tmp_path / "none")).count() == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- features ----------------------------------------------------------------
def test_mean_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None), (None, None, None), (4, float("nan"), None), (3, 4.334, None)], "i int, f float, none double")
    got = feats.impute_means(df)
    assert [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    assert [r.i for r in got.collect()] == [1, 2, 4, 3]  # mean 2.67 is cut
    assert [round(r.f, 3) for r in got.collect()] == [1.0, 2.667, 2.667, 4.334]
    assert all(r.none is None for r in got.collect())
    assert rows(feats.usable_columns(df), "column_name", "imputable") == [("f", 1), ("i", 1), ("none", 0)]


def test_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,), ("C d",)], "occupation string")
    labels = feats.category_labels(df, ["occupation"])
    assert labels == {"occupation": ["a", "C d", "b"]}
    got = feats.one_hot(df, labels)
    assert got.columns == ["occupation_a", "occupation_c d", "occupation_b"]
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 0, 0)]


def test_splits(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    train, test = feats.random_split(df)
    assert train.count() + test.count() == 1000 and 740 < train.count() < 860
    marked = feats.stratified_split(df, "id", "label")
    assert rows(marked.groupBy("label", "part").count(), "label", "part", "count") == [
        (0, "test", 134), (0, "train", 532), (1, "test", 67), (1, "train", 267),
    ]
    tiny = feats.stratified_split(spark.createDataFrame([(1, 0)], "id long, label int"), "id", "label")
    assert tiny.first().part == "test"


def test_repeated_keys_across_the_cut(spark):
    """Every class gives exactly its share, also where one key, or one whole row, is there many times."""
    data = [(i // 7, i, i % 2) for i in range(100)] + [(5, 5, 2)] * 11 + [(None, i, None) for i in range(10)]
    df = spark.createDataFrame(data, "id long, x long, label int")
    marked = feats.stratified_split(df, "id", "label")
    assert rows(marked.groupBy("label", "part").count(), "label", "part", "count") == [
        (0, "test", 10), (0, "train", 40), (1, "test", 10), (1, "train", 40), (2, "test", 3), (2, "train", 8), (None, "test", 2), (None, "train", 8),
    ]
    assert rows(marked.drop("part"), "id", "x", "label") == rows(df, "id", "x", "label")
    assert rows(feats.stratified_split(df.repartition(5), "id", "label"), "id", "x", "label", "part") == rows(marked, "id", "x", "label", "part")


def test_codes(spark):
    df = spark.createDataFrame([("B",), ("A",), ("C",), ("A",)], "grade string")
    assert rows(feats.encode_labels(df, "grade"), "grade", "grade_index") == [("A", 0), ("A", 0), ("B", 1), ("C", 2)]
    coded = spark.createDataFrame([(0,), (9,)], "p int")
    assert rows(feats.decode_labels(coded, "p", feats.label_indexes(df, "grade"), "grade"), "p", "p_label") == [(0, "A"), (9, "Unknown")]


def test_splits_and_samples_by_hash(spark):
    keys = spark.createDataFrame([("L1",), (None,), (str(2**62),)], "loan_id string")
    assert {r.loan_id: r.part for r in feats.split_by_key(keys, "loan_id").collect()}[None] == "test"
    longs = spark.range(2**62, 2**62 + 2000)
    assert 1500 < feats.split_by_key(longs, "id").where("part = 'train'").count() < 1700
    one, two = feats.sample_rows(longs, "id"), feats.sample_rows(longs.repartition(7), "id")
    assert 130 < one.count() < 270 and rows(one, "id") == rows(two, "id")
    strata = longs.withColumn("g", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    assert {r.g for r in feats.stratified_sample(strata, "g", {"a": 0.2}, "id").select("g").distinct().collect()} == {"a"}


# --- gold --------------------------------------------------------------------
def test_retrofit_fan_out_and_dedupe(spark):
    d = date(2024, 1, 1)
    lms = spark.createDataFrame([("L1", "C1", 6, d), ("L2", "C2", 6, d), ("L3", "C1", 5, d)], "loan_id string, customer_id string, mob int, snapshot_date date")
    attr = spark.createDataFrame([("C1", "x", 30, d)], "customer_id string, occupation string, age int, snapshot_date date")
    fin = spark.createDataFrame([("C1", "Good", 1.0, d)], "customer_id string, credit_mix string, income float, snapshot_date date")
    clicks = spark.createDataFrame([("C1", 2, d), ("C1", 4, d), ("C9", 9, d)], "customer_id string, fe_1 int, snapshot_date date")
    wide = gold.feature_store_retrofit(attr, fin, clicks, lms)
    assert set(wide.columns) == {"loan_id", "age", "income", "fe_1"}
    assert rows(wide, "loan_id", "age", "fe_1") == [("L1", 30, 2), ("L1", 30, 4), ("L2", None, None)]
    assert rows(gold.feature_store_retrofit(attr, fin, clicks, lms, dedupe=True), "loan_id", "fe_1") == [("L1", 3.0), ("L2", None)]


# --- quality -----------------------------------------------------------------
def test_duplicate_report(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (2, "a", 1), (2, "b", 1), (3, None, 1), (3, "c", 1), (4, None, None), (4, None, None), (5, "z", 2)],
        "id int, s string, n int",
    )
    got = {r.id: (r["count"], r.differing_columns, r.exact_duplicate) for r in quality.duplicate_report(df, "id").collect()}
    assert got == {1: (2, [], 1), 2: (2, ["s"], 0), 3: (2, ["s"], 0), 4: (2, [], 1)}


def test_null_keys_in_set_and_join(spark):
    left = spark.createDataFrame([(1,), (None,)], "id int")
    right = spark.createDataFrame([(2,), (None,)], "id int")
    assert rows(quality.key_difference(left, right, ["id"]), "id") == [(1,)]
    assert sorted(rows(quality.rows_without_match(left, right, "id"), "id"), key=str) == [(1,), (None,)]


def test_missing_ids(spark):
    f = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    l = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(quality.missing_ids(f, l, "id"), "id", "missing_in") == [(1, "labels"), (3, "features")]
    assert tuple(quality.missing_summary(f, l, "id").first()) == (3, 2, 2, 2, 1, 1)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, None)], "a int, b string")
    assert rows(quality.null_profile(df), "column_name", "null_count", "null_pct") == [("a", 1, 25.0), ("b", 3, 75.0)]
    assert rows(quality.null_profile(df.limit(0)), "null_pct") == [(0.0,), (0.0,)]


def test_partition_comparison(spark):
    l = spark.createDataFrame([("p1", 5), ("p2", 3), ("p3", 4)], "period string, record_count long")
    r = spark.createDataFrame([("p1", 2), ("p2", 4), ("p4", 1)], "period string, record_count long")
    both = quality.compare_partitions(l, r)
    assert rows(both, "period", "presence", "difference") == [("p1", "both", 3), ("p2", "both", -1), ("p3", "feature_only", None), ("p4", "label_only", None)]
    s = quality.difference_summary(both).first()
    assert (s.more_features, s.more_labels, s.equal_counts, s.avg_feature_excess, s.avg_label_excess, s.total_difference) == (1, 1, 0, 3.0, 1.0, 5)


def test_inventory_of_a_partition_with_two_dates(spark):
    df = spark.createDataFrame([("w1", date(2024, 1, 1)), ("w1", date(2024, 1, 2)), ("w2", None)], "dir string, snapshot_date date")
    got = quality.partition_inventory(df, F.col("dir"), flags=["grade"])
    assert rows(got, "period", "record_count", "snapshot_dates", "has_grade") == [("w1", 2, 2, 0), ("w2", 1, 0, 0)]


# --- reports and registry ----------------------------------------------------
def test_best_model_puts_null_first(spark):
    df = spark.createDataFrame(
        [("w1", "a", 0.5, 0.1), ("w1", "b", None, 0.2), ("w2", "b", 0.7, 0.3), ("w2", "a", 0.7, 0.4)],
        "week_date string, model_name string, macro_f1 double, accuracy double",
    )
    assert rows(reports.best_by_period(df), "week_date", "model_name") == [("w1", "b"), ("w2", "a")]
    assert rows(reports.win_counts(df), "model_name", "wins") == [("a", 1), ("b", 1)]


def test_champion_tie_and_missing(spark):
    schema = "model_type string, run_id string, auc double"
    tie = spark.createDataFrame([("LightGBM", "r1", 0.8), ("CatBoost", "r2", 0.8)], schema)
    assert tuple(runs.choose_champion(tie).first()) == ("CatBoost", "r2", 0.8)
    missing = spark.createDataFrame([("LightGBM", None, None), ("CatBoost", None, None)], schema)
    assert tuple(runs.choose_champion(missing).first()) == ("CatBoost", "unknown", 0.0)
    better = spark.createDataFrame([("LightGBM", "r1", 0.81), ("CatBoost", "r2", 0.8)], schema)
    assert runs.choose_champion(better).first().model_type == "LightGBM"


def test_versions(spark):
    schema = "name string, version string, stage string, run_id string"
    none = spark.createDataFrame([("m", "9", "None", "a"), ("m", "10", "None", "b")], schema)
    assert runs.deployed_version(none).first().version == "10"
    prod = none.unionByName(spark.createDataFrame([("m", "2", "Production", "c")], schema))
    assert runs.deployed_version(prod).first().run_id == "c"
    champion = spark.createDataFrame([("LightGBM", "r", 0.9)], "model_type string, run_id string, auc double")
    assert tuple(runs.next_version(prod, "m", champion).first()) == ("m", "11", "Production", "r")
    assert runs.next_version(prod, "other", champion).first().version == "1"


def test_recent_run_choice(spark):
    df = spark.createDataFrame([("a", "LightGBM_x", 5), ("b", "catboost", 9), ("c", "lightgbm", 1)], "run_id string, run_name string, start_time long")
    assert runs.pick_run(df, F.lit(3), "lightgbm").first().run_id == "a"
    assert runs.pick_run(df, F.lit(3), "xgboost").first().run_id == "b"
    assert runs.pick_run(df, F.lit(99)).count() == 0


def test_run_facts(spark):
    df = spark.createDataFrame(
        [("t", 2, "RUN_ID: ffff"), ("t", 1, "run_id:  3fa9c0 x"), ("t", 3, "macro f1 score: 0.8612"), ("u", 1, "nothing")],
        "task_id string, line_no int, text string",
    )
    assert rows(runs.run_facts(df), "task_id", "run_id", "macro_f1") == [("t", "3fa9c0", 0.8612), ("u", None, None)]


def test_evaluate_production(spark):
    metrics = spark.createDataFrame(
        [("2024_06_01", "m", 0.5, 0.6, 10, 1), ("2024_06_01", "m2", 0.7, 0.8, 11, 2)],
        "week_date string, model_name string, macro_f1 double, accuracy double, total_samples int, evaluation_date int",
    )
    days = spark.createDataFrame([(date(2024, 6, 8),), (date(2024, 6, 15),), (date(2024, 6, 22),)], "day date")
    got = rows(reports.evaluate_production(days, metrics, F.lit("2024-06-15").cast("date")), "day", "model_name", "message")
    assert got == sorted([
        (date(2024, 6, 8), "m2", "success"), (date(2024, 6, 15), None, "No metrics for previous week 2024_06_08"),
        (date(2024, 6, 22), None, "Week after retraining event, skipping evaluation."),
    ], key=repr)


def test_shared_key_choice(spark):
    f = spark.createDataFrame([("1", 2)], "loan_id string, x int")
    assert snapshots.join_on_shared_key(f, spark.createDataFrame([("1", 0)], "id string, label int")).columns == ["id", "x", "label"]
    assert snapshots.join_on_shared_key(f, spark.createDataFrame([("1", 0)], "loan_id string, label int")).columns == ["loan_id", "x", "label"]
    assert snapshots.join_on_shared_key(f, spark.createDataFrame([("1", 0)], "other string, label int")) is None
