"""Reports over the metric tables (one row per period and model)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import fixed_values as fv


def model_summary(metrics: DataFrame) -> DataFrame:
    """Averages, extremes and spread of every model, best average macro F1 first."""
    return (
        metrics.groupBy("model_name")
        .agg(
            F.count(F.lit(1)).alias("weeks_evaluated"),
            F.avg("accuracy").alias("avg_accuracy"),
            F.avg("macro_f1").alias("avg_macro_f1"),
            F.avg("weighted_f1").alias("avg_weighted_f1"),
            F.min("macro_f1").alias("min_macro_f1"),
            F.max("macro_f1").alias("max_macro_f1"),
            F.stddev_samp("macro_f1").alias("std_macro_f1"),
            F.sum("total_samples").alias("total_samples"),
        )
        .orderBy(F.col("avg_macro_f1").desc_nulls_first(), "model_name")
    )


def recent_periods(metrics: DataFrame, n: int = 10, period: str = "week_date") -> DataFrame:
    """Rows of the last n distinct periods; at most n periods are broadcast."""
    last = metrics.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return metrics.join(F.broadcast(last), period, "left_semi")


def _best_first() -> list[Column]:
    return [F.col("macro_f1").desc_nulls_first(), F.col("model_name")]


def weekly_comparison(metrics: DataFrame, n: int = 10, period: str = "week_date") -> DataFrame:
    """Recent periods with each model's place; a period holds one row per model."""
    place = F.row_number().over(Window.partitionBy(period).orderBy(*_best_first()))
    return (
        recent_periods(metrics, n, period)
        .select(period, "model_name", "accuracy", "macro_f1", "weighted_f1", "total_samples", place.alias("place"))
        .orderBy(F.col(period).desc(), "place")
    )


def best_by_period(metrics: DataFrame, period: str = "week_date", limit: int | None = 20) -> DataFrame:
    """The best model of each period, newest first; the rank filter is applied before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(period).orderBy(*_best_first()))
    best = (
        metrics.withColumn("rank", rank).where("rank = 1")
        .select(period, "model_name", "macro_f1", "accuracy").orderBy(F.col(period).desc())
    )
    return best.limit(limit) if limit else best


def win_counts(metrics: DataFrame, period: str = "week_date", limit: int | None = 20) -> DataFrame:
    wins = best_by_period(metrics, period, limit).groupBy("model_name").agg(F.count(F.lit(1)).alias("wins"))
    return wins.orderBy(F.col("wins").desc(), "model_name")


def latest_metric(metrics: DataFrame, at: Column, period: str = "week_date") -> DataFrame:
    """The newest evaluation row of one period."""
    return metrics.where(F.col(period) == at).orderBy(F.col("evaluation_date").desc(), "model_name").limit(1)


def latest_per_period(metrics: DataFrame, period: str = "week_date") -> DataFrame:
    """The newest evaluation row of every period (ties: first model name)."""
    rank = F.row_number().over(Window.partitionBy(period).orderBy(F.col("evaluation_date").desc(), "model_name"))
    return metrics.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def evaluate_production(days: DataFrame, metrics: DataFrame, last_retraining: Column | None = None) -> DataFrame:
    """For each day, the latest metric of the week before, with a message.

    ``last_retraining`` is a date column (or literal); one week after it the
    evaluation is skipped.
    """
    current = F.date_format("day", "yyyy_MM_dd")
    previous = F.date_format(F.date_sub("day", 7), "yyyy_MM_dd")
    calm = F.lit(False)
    if last_retraining is not None:
        calm = F.coalesce(current == F.date_format(F.date_add(last_retraining, 7), "yyyy_MM_dd"), F.lit(False))
    latest = latest_per_period(metrics).select(
        F.col("week_date").alias("prev_week"), "model_name", "macro_f1", "accuracy", "total_samples"
    )
    asked = days.select("day", previous.alias("prev_week"), calm.alias("skipped"))
    joined = asked.join(latest, "prev_week", "left")
    found = ~F.col("skipped") & F.col("model_name").isNotNull()
    return joined.select(
        "day", "prev_week",
        *[F.when(found, F.col(c)).alias(c) for c in ("model_name", "macro_f1", "accuracy", "total_samples")],
        F.when(F.col("skipped"), F.lit(fv.EVALUATION_SKIPPED))
        .when(F.col("model_name").isNull(), F.concat(F.lit(fv.NO_PREVIOUS_METRICS), F.col("prev_week")))
        .otherwise(F.lit(fv.EVALUATED)).alias("message"),
    )
