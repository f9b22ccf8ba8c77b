"""Metric, prediction and tracker sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import staged
from tidemark.sources import committed

# Stored columns and types.
RATIO = "decimal(5,4)"
PERFORMANCE_COLUMNS = {
    "week_date": "string", "mlflow_run_id": "string", "model_name": "string", "accuracy": RATIO, "macro_f1": RATIO,
    "weighted_f1": RATIO, "total_samples": "int", "f1_by_grade": "string", "predictions_distribution": "string",
    "evaluation_date": "timestamp",
}
METRIC_COLUMNS = {
    "month_date": "string", "mlflow_run_id": "string", "model_name": "string", "accuracy": RATIO, "precision": RATIO,
    "recall": RATIO, "auc": RATIO, "macro_f1": RATIO, "weighted_f1": RATIO, "total_samples": "int",
    "f1_by_grade": "string", "predictions_distribution": "string", "evaluation_date": "timestamp",
}
INFERENCE_COLUMNS = {
    "loan_id": "string", "customer_id": "string", "snapshot_date": "date", "predicted_default": "int",
    "default_probability": RATIO, "model_name": "string", "model_version": "string", "mlflow_run_id": "string",
    "inference_date": "timestamp", "month_partition": "string", "execution_context": "string",
}


def shape(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Stored columns in order and type: ratios rounded to 4 places, maps as JSON text."""
    kinds = dict(df.dtypes)

    def stored(name: str, kind: str) -> Column:
        if name not in kinds:
            fill = F.current_timestamp() if kind == "timestamp" else F.lit(None)
            return fill.cast(kind).alias(name)
        value = F.to_json(name) if kinds[name].startswith("map") else F.col(name)
        return value.cast(kind).alias(name)

    return df.select(*[stored(c, kind) for c, kind in columns.items()])


def _store(rows: DataFrame, path: str, period: str) -> None:
    """Put rows into their periods; a row with the same run and model takes the old one's place.

    Only the periods that ``rows`` holds are read and written again, in one switch.
    """
    spark = rows.sparkSession
    rows = staged(rows, "stored")
    periods = {r[0] for r in rows.select(period).distinct().collect()}
    old = committed.read_parts(spark, path, lambda part: committed.part_value(part, period) in periods)
    if old is not None:
        keys = [period, "mlflow_run_id", "model_name"]
        rows = null_safe_anti_join(old.select(rows.columns), rows.select(keys).distinct(), keys).unionByName(rows)
    committed.write_parts(rows, path, [period])


def null_safe_anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``; NULL keys match each other."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    return left.join(renamed, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]), "left_anti")


def store_performance(df: DataFrame, path: str) -> None:
    """Weekly performance rows, one per week, run and model: storing a week's run once more replaces it."""
    _store(shape(df, PERFORMANCE_COLUMNS), path, "week_date")


def store_metrics(df: DataFrame, path: str) -> None:
    """Monthly metric rows, one per month, run and model: storing a month's run once more replaces it."""
    _store(shape(df, METRIC_COLUMNS), path, "month_date")


def store_inference(df: DataFrame, path: str) -> None:
    """Predictions by scoring month and run: scoring a month once more with the same run replaces its rows."""
    filled = df.withColumns({
        "predicted_default": F.coalesce("predicted_default", F.lit(0)),
        "default_probability": F.coalesce("default_probability", F.lit(0.0)),
        "model_version": F.coalesce("model_version", F.lit("")),
        "mlflow_run_id": F.coalesce("mlflow_run_id", F.lit("")),
    })
    committed.write_parts(shape(filled, INFERENCE_COLUMNS), path, ["month_partition", "mlflow_run_id"])


def read_inference(spark: SparkSession, path: str, month: str | None = None, run_id: str | None = None) -> DataFrame | None:
    """Stored predictions, of one month or run if named; other folders are not opened."""
    def wanted(part: str) -> bool:
        at = {"month_partition": month, "mlflow_run_id": run_id}
        return all(v is None or (committed.part_value(part, c) or "") == v for c, v in at.items())

    rows = committed.read_parts(spark, path, wanted)
    # Spark stores an empty partition value as null
    return rows.withColumn("mlflow_run_id", F.coalesce("mlflow_run_id", F.lit(""))).select(*INFERENCE_COLUMNS) if rows is not None else None


def append_jdbc(df: DataFrame, url: str, table: str, columns: dict[str, str], **options: str) -> None:
    """The same rows into a database table, written by the executors."""
    shape(df, columns).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)
