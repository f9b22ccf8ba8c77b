"""Joins, aggregates, rankings, top-k and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import quality, registry as runs, reports
from tidemark.operators.columns import at_mob
from tidemark.operators.skew import heavy_grid, left_join_chain, left_join_grid
from tidemark.plans import gold, silver
from tidemark.session import scratch_path
from tidemark.sources import snapshots
from tidemark.suite import views
from tidemark.suite.registry import query, r6
from tidemark.suite.views import sql, table


# --- joins -------------------------------------------------------------------
@query("j01_anchor_join_chain", sql(
    """SELECT l.loan_id, l.snapshot_date, l.dpd, a.occupation, f.credit_mix, length(f.type_of_loan) AS listed
    FROM lms l LEFT JOIN raw_attr a USING (customer_id) LEFT JOIN raw_fin f USING (customer_id) WHERE l.mob = 6""", "lms", "raw_attr", "raw_fin"))
def _(spark, sf):
    sides = [
        views.raw_attributes(spark, sf).select("customer_id", "occupation"),
        views.raw_financials(spark, sf).select("customer_id", "credit_mix", F.length("type_of_loan").cast("long").alias("listed")),
    ]
    anchor = at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id", "snapshot_date", "dpd")
    return left_join_chain(anchor, sides, "customer_id", ["loan_id", "snapshot_date"]).drop("customer_id")


@query("j02_click_averages_join", sql(
    """SELECT loan_id, l.customer_id, l.snapshot_date, round(m1, 6) AS avg_fe_1, round(m2, 6) AS avg_fe_2 FROM lms l LEFT JOIN
    (SELECT customer_id, snapshot_date, avg(fe_1) AS m1, avg(fe_2) AS m2 FROM raw_click GROUP BY 1, 2) c ON l.customer_id = c.customer_id
    WHERE mob = 6""", "lms", "raw_click"))
def _(spark, sf):
    anchor = at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id", "snapshot_date")
    means = gold.click_averages(views.raw_clicks(spark, sf), ["fe_1", "fe_2"]).drop("snapshot_date")
    joined = left_join_chain(anchor, [means], "customer_id", ["loan_id", "snapshot_date"])
    return joined.withColumns({c: r6(c) for c in ("avg_fe_1", "avg_fe_2")})


@query("j03_raw_click_fan_out", sql(
    """SELECT l.loan_id, count(*) AS n, count(c.fe_1) AS clicks, CAST(sum(c.fe_1) AS BIGINT) AS fe_1 FROM lms l LEFT JOIN raw_click c ON l.customer_id = c.customer_id
    WHERE l.mob = 6 GROUP BY l.loan_id""", "lms", "raw_click"))
def _(spark, sf):
    anchor = at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id")
    clicks = silver.clickstream_retrofit(views.raw_clicks(spark, sf)).drop("snapshot_date")
    wide = left_join_grid(anchor, clicks, "customer_id", ["loan_id"], clicks.columns)
    return wide.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("fe_1").alias("clicks"), F.sum("fe_1").alias("fe_1")
    )


@query("j03_hot_both_sides", """SELECT a.l_returnflag, a.l_linestatus, count(*) AS pairs, CAST(sum(a.l_linenumber * b.n) AS BIGINT) AS total FROM lineitem a
    JOIN (SELECT l_returnflag, o_orderpriority, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) b ON a.l_returnflag = b.l_returnflag GROUP BY 1, 2""")
def _(spark, sf):
    """Three keys, each with a large share of the left side and several rows on the right, split over a grid."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    counts = lines.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")
    counts = counts.groupBy("l_returnflag", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    grid = heavy_grid(lines, counts, "l_returnflag", share=0.1, rows_per_task=2_000, pairs_per_task=8_000)
    pairs = left_join_grid(lines, counts, "l_returnflag", ["l_orderkey", "l_linenumber"], ["o_orderpriority"], grid)
    return pairs.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum(F.col("l_linenumber") * F.col("n")).alias("total")
    )


@query("j01_bucketed_chain", sql(
    """SELECT l.loan_id, l.snapshot_date, l.dpd, a.occupation, f.credit_mix, length(f.type_of_loan) AS listed
    FROM lms l LEFT JOIN raw_attr a USING (customer_id) LEFT JOIN raw_fin f USING (customer_id) WHERE l.mob = 6""", "lms", "raw_attr", "raw_fin"))
def _(spark, sf):
    """The chain over tables that are stored by buckets of the customer: no side is shuffled."""
    return bucketed_chain(spark, sf).drop("customer_id")


def bucketed_chain(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "lms": at_mob(views.lms(spark, sf), 6).select("loan_id", "customer_id", "snapshot_date", "dpd"),
        "attributes": views.raw_attributes(spark, sf).select("customer_id", "occupation"),
        "financials": views.raw_financials(spark, sf).select("customer_id", "credit_mix", F.length("type_of_loan").cast("long").alias("listed")),
    }
    stored = []
    for name, df in tables.items():
        place = f"bucketed_{name}_{uuid.uuid4().hex}"
        snapshots.write_bucketed(df, place, "customer_id", 16)
        stored.append(spark.table(place).hint("merge"))
    return left_join_chain(stored[0], stored[1:], "customer_id", ["loan_id", "snapshot_date"])


@query("j04_features_labels", sql(
    """SELECT f.loan_id, f.dpd, s.label, s.snapshot_date FROM lms f JOIN label_store s ON f.loan_id = s.loan_id WHERE f.mob = 6""", "label_store"))
def _(spark, sf):
    lms = views.lms(spark, sf)
    features = at_mob(lms, 6).select("loan_id", "dpd", "snapshot_date")
    return snapshots.training_rows(features, gold.label_store(lms))


@query("j05_join_on_id", sql(
    "SELECT o_orderkey AS id, o_orderpriority AS grade, o_totalprice AS price FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey"))
def _(spark, sf):
    features = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    labels = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
    ).select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grade"))
    return features.join(labels, "id").select("id", "grade", "price")


@query("j06_shared_key", sql(
    "SELECT o_orderkey AS id, o_totalprice AS price, o_orderpriority AS grade FROM orders"))
def _(spark, sf):
    orders = table(spark, sf, "orders")
    features = orders.select(F.col("o_orderkey").alias("loan_id"), F.col("o_totalprice").alias("price"))
    labels = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grade"))
    return snapshots.join_on_shared_key(features, labels)


_IDLE = "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"


@query("j08_sample_rows", f"SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM ({_IDLE}) ORDER BY o_orderkey LIMIT 5)")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    idle = quality.key_difference(orders, lines, ["o_orderkey"])
    return quality.sample_rows_of(orders, idle, "o_orderkey")


@query("j09_label_anchored", sql(
    """SELECT s.loan_id, s.customer_id, s.label, s.label_def, s.snapshot_date, a.occupation FROM label_store s LEFT JOIN raw_attr a USING (customer_id)""",
    "label_store", "raw_attr"))
def _(spark, sf):
    side = views.raw_attributes(spark, sf).select("customer_id", "occupation", "snapshot_date")
    return gold.label_anchored(gold.label_store(views.lms(spark, sf)), side)


@query("j10_recent_periods", sql(
    """SELECT * FROM runs WHERE week_date IN (SELECT DISTINCT week_date FROM runs ORDER BY week_date DESC LIMIT 10)""", "runs"))
def _(spark, sf):
    return reports.recent_periods(views.model_runs(spark, sf), 10)


@query("j11_rows_without_match", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN ({_IDLE})")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return quality.rows_without_match(orders, lines, "o_orderkey")


_INVENTORIES = {
    "ships": "SELECT strftime(date_trunc('month', l_shipdate), '%Y_%m_%d') AS period, count(*) AS feature_count FROM lineitem GROUP BY 1",
    "sales": "SELECT strftime(date_trunc('month', o_orderdate), '%Y_%m_%d') AS period, count(*) AS label_count FROM orders GROUP BY 1",
    "compared": """SELECT coalesce(ships.period, sales.period) AS period, feature_count, label_count,
    CASE WHEN label_count IS NULL THEN 'feature_only' WHEN feature_count IS NULL THEN 'label_only' ELSE 'both' END AS presence,
    feature_count - label_count AS difference FROM ships FULL JOIN sales ON ships.period = sales.period""",
}


def _inventory(spark, sf, name: str, column: str):
    days = table(spark, sf, name).select(F.col(column).cast("date").alias("snapshot_date"))
    return quality.partition_inventory(days, F.date_format(F.trunc("snapshot_date", "month"), "yyyy_MM_dd"))


def compared_months(spark, sf):
    return quality.compare_partitions(
        _inventory(spark, sf, "lineitem", "l_shipdate"), _inventory(spark, sf, "orders", "o_orderdate")
    )


@query("j12_compare_partitions", sql("SELECT * FROM compared", **_INVENTORIES))
def _(spark, sf):
    return compared_months(spark, sf)


# --- aggregates --------------------------------------------------------------
@query("a01_click_averages", sql(
    "SELECT customer_id, snapshot_date, " + ", ".join(f"round(avg(fe_{i}), 6) AS avg_fe_{i}" for i in range(1, 21))
    + " FROM raw_click GROUP BY 1, 2", "raw_click"))
def _(spark, sf):
    means = gold.click_averages(views.raw_clicks(spark, sf))
    return means.select("customer_id", "snapshot_date", *[r6(f"avg_fe_{i}").alias(f"avg_fe_{i}") for i in range(1, 21)])


@query("a02_group_counts", sql("SELECT name, count(*) AS n FROM raw_attr GROUP BY name", "raw_attr"))
def _(spark, sf):
    return views.raw_attributes(spark, sf).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("a03_row_counts", "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'absent', 0")
def _(spark, sf):
    return snapshots.bundle_counts(spark, {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem"), "absent": None})


@query("a03_counts_from_footers", sql("SELECT snapshot_date, count(*) AS record_count FROM raw_lms GROUP BY snapshot_date", "raw_lms"))
def _(spark, sf):
    """Row counts of a stored table's months, from the footers of its files."""
    path = scratch_path(spark, "counted")
    snapshots.write_snapshots(views.raw_lms(spark, sf), path)
    return snapshots.period_counts(spark, path)


@query("a04_distinct_keys", """SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT (l_orderkey, l_linenumber)) AS loans FROM lineitem""")
def _(spark, sf):
    # one shuffle on the wider key; orders are distinct inside it
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    per_order = pairs.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg(F.count(F.lit(1)).alias("orders"), F.sum("n").alias("loans"))


@query("a05_non_null_counts", sql(
    """UNPIVOT (SELECT count(monthly_balance) AS monthly_balance, count(credit_mix) AS credit_mix, count(credit_history_age) AS credit_history_age
    FROM raw_fin) ON monthly_balance, credit_mix, credit_history_age INTO NAME column_name VALUE non_null""", "raw_fin").replace(
        "UNPIVOT (SELECT", "SELECT * FROM (UNPIVOT (SELECT") + ")")
def _(spark, sf):
    return quality.non_null_counts(views.raw_financials(spark, sf), ["monthly_balance", "credit_mix", "credit_history_age"])


@query("a06_model_summary", sql(
    """SELECT model_name, count(*) AS weeks_evaluated, round(avg(accuracy), 6) AS avg_accuracy, round(avg(macro_f1), 6) AS avg_macro_f1,
    round(avg(weighted_f1), 6) AS avg_weighted_f1, min(macro_f1) AS min_macro_f1, max(macro_f1) AS max_macro_f1,
    round(stddev_samp(macro_f1), 6) AS std_macro_f1, CAST(sum(total_samples) AS BIGINT) AS total_samples FROM runs GROUP BY model_name""", "runs"))
def _(spark, sf):
    row = reports.model_summary(views.model_runs(spark, sf))
    rounded = {c: r6(c) for c in ("avg_accuracy", "avg_macro_f1", "avg_weighted_f1", "std_macro_f1")}
    return row.withColumns(rounded)


_BEST = """SELECT week_date, model_name, macro_f1, accuracy FROM (SELECT *, row_number() OVER (PARTITION BY week_date
    ORDER BY macro_f1 DESC NULLS FIRST, model_name) AS rank FROM runs) WHERE rank = 1 ORDER BY week_date DESC LIMIT 20"""


@query("a07_win_counts", sql("SELECT model_name, count(*) AS wins FROM best GROUP BY model_name", "runs", best=_BEST))
def _(spark, sf):
    return reports.win_counts(views.model_runs(spark, sf))


@query("a08_difference_summary", sql(
    """SELECT CAST(sum(feature_count) AS BIGINT) AS total_feature_records, CAST(sum(label_count) AS BIGINT) AS total_label_records,
    CAST(sum(feature_count) - sum(label_count) AS BIGINT) AS total_difference, round(avg(difference), 6) AS avg_difference,
    max(difference) AS max_difference, min(difference) AS min_difference, count(*) FILTER (WHERE difference > 0) AS more_features,
    count(*) FILTER (WHERE difference < 0) AS more_labels, count(*) FILTER (WHERE difference = 0) AS equal_counts,
    round(avg(difference) FILTER (WHERE difference > 0), 6) AS avg_feature_excess,
    round(avg(-difference) FILTER (WHERE difference < 0), 6) AS avg_label_excess FROM compared""", **_INVENTORIES))
def _(spark, sf):
    row = quality.difference_summary(compared_months(spark, sf))
    return row.withColumns({c: r6(c) for c in ("avg_difference", "avg_feature_excess", "avg_label_excess")})


# --- rankings ----------------------------------------------------------------
@query("w01_best_by_week", sql("SELECT * FROM best", "runs", best=_BEST))
def _(spark, sf):
    return reports.best_by_period(views.model_runs(spark, sf))


@query("w02_weekly_places", sql(
    """SELECT week_date, model_name, accuracy, macro_f1, weighted_f1, total_samples, CAST(row_number() OVER (PARTITION BY week_date
    ORDER BY macro_f1 DESC NULLS FIRST, model_name) AS INTEGER) AS place FROM runs
    WHERE week_date IN (SELECT DISTINCT week_date FROM runs ORDER BY week_date DESC LIMIT 10)""", "runs"))
def _(spark, sf):
    return reports.weekly_comparison(views.model_runs(spark, sf))


@query("t01_duplicates_by_count", "SELECT l_orderkey AS id, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1")
def _(spark, sf):
    return quality.duplicate_ids(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("t02_sorted_vocabulary", "SELECT DISTINCT p_type FROM part ORDER BY p_type")
def _(spark, sf):
    return table(spark, sf, "part").select("p_type").distinct().orderBy("p_type")


@query("t03_recent_best", sql("SELECT week_date, macro_f1 FROM runs ORDER BY week_date DESC, macro_f1 DESC, model_name LIMIT 20", "runs"))
def _(spark, sf):
    df = views.model_runs(spark, sf)
    return df.orderBy(F.col("week_date").desc(), F.col("macro_f1").desc(), "model_name").limit(20).select("week_date", "macro_f1")


@query("t04_latest_metric", sql(
    "SELECT * FROM runs WHERE week_date = '1998_03_01' ORDER BY evaluation_date DESC, model_name LIMIT 1", "runs"))
def _(spark, sf):
    return reports.latest_metric(views.model_runs(spark, sf), F.lit("1998_03_01"))


@query("t05_champion", sql(
    """SELECT week_date, arg_max(struct_pack(m := model_type, r := run_id, f := f), struct_pack(f := f, p := pri, r := run_id)) AS b FROM
    (SELECT week_date, CASE model_name WHEN 'A' THEN 'LightGBM' ELSE 'CatBoost' END AS model_type, CASE WHEN model_name <> 'N' THEN model_name
    ELSE 'unknown' END AS run_id, coalesce(nullif(macro_f1, 0.5), 0) AS f, CASE model_name WHEN 'A' THEN 0 ELSE 1 END AS pri FROM runs) GROUP BY 1""",
    "runs").replace("SELECT week_date, arg_max", "SELECT week_date, b.m AS model_type, b.r AS run_id, b.f AS macro_f1 FROM (SELECT week_date, arg_max") + ")")
def _(spark, sf):
    candidates = views.model_runs(spark, sf).select(
        "week_date", F.when(F.col("model_name") == "A", "LightGBM").otherwise("CatBoost").alias("model_type"),
        F.when(F.col("model_name") != "N", F.col("model_name")).alias("run_id"),
        F.when(F.col("macro_f1") != 0.5, F.col("macro_f1")).alias("macro_f1"),
    )
    return runs.choose_champion(candidates, "macro_f1", by=("week_date",))


@query("t06_deployed_version", """SELECT name, version, stage, run_id FROM (SELECT *, row_number() OVER (PARTITION BY name
    ORDER BY CASE WHEN stage = 'Production' THEN 1 ELSE 0 END DESC, CAST(version AS INTEGER) DESC) AS rn FROM
    (SELECT CAST(o_custkey AS VARCHAR) AS name, CAST(o_orderkey AS VARCHAR) AS version, CASE WHEN o_orderstatus = 'P' THEN 'Production'
    ELSE 'None' END AS stage, o_orderpriority || '-' || CAST(o_orderkey AS VARCHAR) AS run_id FROM orders)) WHERE rn = 1""")
def _(spark, sf):
    versions = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("name"), F.col("o_orderkey").cast("string").alias("version"),
        F.when(F.col("o_orderstatus") == "P", "Production").otherwise("None").alias("stage"),
        F.concat_ws("-", "o_orderpriority", "o_orderkey").alias("run_id"),
    )
    return runs.deployed_version(versions)


@query("t07_recent_run", """SELECT run_id, run_name, start_time FROM (SELECT * FROM (SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
    o_orderpriority || '_LightGBM_' || o_orderstatus AS run_name, epoch_ms(o_orderdate) AS start_time FROM orders)
    WHERE start_time >= epoch_ms(TIMESTAMP '2001-07-01') ORDER BY start_time DESC, run_id LIMIT 10)
    ORDER BY contains(lower(run_name), 'lightgbm_o') DESC, start_time DESC, run_id LIMIT 1""")
def _(spark, sf):
    day = F.col("o_orderdate").cast("date")
    listed = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.concat(F.col("o_orderpriority"), F.lit("_LightGBM_"), F.col("o_orderstatus")).alias("run_name"),
        (F.unix_date(day).cast("long") * 86_400_000).alias("start_time"),
    )
    since = F.unix_date(F.lit("2001-07-01").cast("date")).cast("long") * 86_400_000
    return runs.pick_run(listed, since, "LightGBM_O")


@query("t09_first_keys", "SELECT DISTINCT l_partkey FROM lineitem ORDER BY l_partkey LIMIT 5")
def _(spark, sf):
    return quality.first_keys(table(spark, sf, "lineitem"), "l_partkey")


# --- set operations ----------------------------------------------------------
@query("u01_key_difference", """(SELECT o_orderkey AS id, 'orders' AS only_in FROM orders EXCEPT SELECT l_orderkey, 'orders' FROM lineitem)
    UNION ALL (SELECT l_orderkey, 'lineitem' FROM lineitem EXCEPT SELECT o_orderkey, 'lineitem' FROM orders)""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return quality.key_difference(orders, lines, ["id"]).withColumn("only_in", F.lit("orders")).unionByName(
        quality.key_difference(lines, orders, ["id"]).withColumn("only_in", F.lit("lineitem"))
    )


@query("u02_key_intersection", "SELECT o_orderkey AS id FROM orders INTERSECT SELECT l_orderkey FROM lineitem")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return quality.key_intersection(orders, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")), ["id"])


@query("u03_key_overlap", """SELECT tables, count(*) AS n FROM (SELECT id, string_agg(t, '+' ORDER BY t) AS tables FROM (
    SELECT DISTINCT c_custkey AS id, 'customer' AS t FROM customer UNION ALL SELECT DISTINCT user_id, 'events' FROM events
    UNION ALL SELECT DISTINCT o_custkey, 'orders' FROM orders) GROUP BY id) GROUP BY tables""")
def _(spark, sf):
    return quality.key_overlap(
        {
            "customer": table(spark, sf, "customer").select(F.col("c_custkey").alias("id")),
            "events": table(spark, sf, "events").select(F.col("user_id").alias("id")),
            "orders": table(spark, sf, "orders").select(F.col("o_custkey").alias("id")),
        },
        ["id"],
    )


@query("u04_union_months", sql(
    """SELECT snapshot_date, count(*) AS n, count(dpd) AS with_dpd FROM (SELECT snapshot_date, NULL AS dpd FROM lms
    WHERE snapshot_date < DATE '1998-01-01' UNION ALL SELECT snapshot_date, dpd FROM lms WHERE snapshot_date >= DATE '1998-01-01') GROUP BY 1""", "lms"))
def _(spark, sf):
    lms = views.lms(spark, sf)
    cut = F.lit("1998-01-01").cast("date")
    parts = [
        lms.where(F.col("snapshot_date") < cut).select("loan_id", "snapshot_date"),
        lms.where(F.col("snapshot_date") >= cut).select("snapshot_date", "dpd", "loan_id"),
    ]
    return snapshots.union_months(parts).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.count("dpd").alias("with_dpd"))


@query("u05_period_sets", sql("SELECT presence, count(*) AS n FROM compared GROUP BY presence", **_INVENTORIES))
def _(spark, sf):
    return compared_months(spark, sf).groupBy("presence").agg(F.count(F.lit(1)).alias("n"))
