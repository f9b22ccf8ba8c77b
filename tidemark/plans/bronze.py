"""Raw text to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.columns import lower_names
from tidemark.sources import snapshots


def ingest_month(raw: DataFrame, target: str, day: str) -> None:
    """Cut one month out of the source and replace exactly that month."""
    typed = lower_names(raw).withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    snapshots.write_snapshot(typed, target, day)


def ingest_all(raw: DataFrame, target: str) -> None:
    """Back-fill: all months of the source in one pass."""
    typed = lower_names(raw).withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    snapshots.write_snapshots(typed, target)


def ingest_static(raw: DataFrame, target: str) -> None:
    """Load-once source; a later call is a no-op."""
    snapshots.write_once(lower_names(raw), target)


def bronze_table(
    spark: SparkSession, source: str, target: str, day: str, static: bool, schema: StructType | str | None = None
) -> None:
    """One source file set to its bronze table, by month or once."""
    raw = snapshots.read_csv(spark, source, schema)
    if static:
        ingest_static(raw, target)
    else:
        ingest_month(raw, target, day)
