"""Runs, versions and champions as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.functions.text import first_match


def recent_runs(runs: DataFrame, since_ms: Column, limit: int = 10) -> DataFrame:
    """Runs started at or after ``since_ms``, newest first."""
    return runs.where(F.col("start_time") >= since_ms).orderBy(F.col("start_time").desc(), "run_id").limit(limit)


def pick_run(runs: DataFrame, since_ms: Column, model_type: str | None = None, limit: int = 10) -> DataFrame:
    """The newest recent run whose name mentions the model type, else simply the newest."""
    named = F.lit(False) if model_type is None else F.contains(F.lower("run_name"), F.lit(model_type.lower()))
    return (
        recent_runs(runs, since_ms, limit)
        .orderBy(F.coalesce(named, F.lit(False)).desc(), F.col("start_time").desc(), "run_id")
        .limit(1)
    )


def choose_champion(candidates: DataFrame, metric: str = "auc", first: str = "LightGBM", by: tuple[str, ...] = ()) -> DataFrame:
    """Best of two families; ``first`` must be strictly better to win.

    A missing metric counts 0 and a missing run is called ``unknown``. With ``by``,
    one champion per group; the maximum is a partial aggregate, not a sort.
    """
    score = F.coalesce(F.col(metric), F.lit(0.0))
    rows = candidates.select(
        *by, "model_type", F.coalesce("run_id", F.lit("unknown")).alias("run_id"), score.alias(metric),
        (F.col("model_type") != first).cast("int").alias("_priority"),
    )
    best = F.max_by(F.struct("model_type", "run_id", F.col(metric)), F.struct(F.col(metric), F.col("_priority"), F.col("run_id")))
    return rows.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def deployed_version(versions: DataFrame) -> DataFrame:
    """Per model name the Production version, else the highest; versions compare as numbers."""
    number = F.col("version").cast("string").try_cast("int")
    order = F.struct((F.col("stage") == "Production").cast("int"), number)
    best = F.max_by(F.struct("version", "stage", "run_id"), order)
    return versions.groupBy("name").agg(best.alias("b")).select("name", "b.*")


def next_version(versions: DataFrame, name: str, champion: DataFrame) -> DataFrame:
    """The row that registers the champion: one past the highest version, in Production."""
    highest = versions.where(F.col("name") == name).agg(
        F.coalesce(F.max(F.col("version").cast("string").try_cast("int")), F.lit(0)).alias("v")
    )
    return champion.select(
        F.lit(name).alias("name"), (highest.scalar() + 1).cast("string").alias("version"),
        F.lit("Production").alias("stage"), "run_id",
    )


def tracker_row(champion: DataFrame, version: Column, day: Column, metric: str, model_name: str) -> DataFrame:
    """The retraining record written beside the registry."""
    return champion.select(
        F.date_format(day, "yyyy-MM-dd").alias("last_retraining_date"), F.lit(model_name).alias("model_name"),
        version.alias("model_version"), "model_type", F.col(metric).alias("macro_f1_score"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("registration_date"),
    )


def run_facts(lines: DataFrame, task: str = "task_id", line: str = "line_no", text: str = "text") -> DataFrame:
    """First run id and first macro F1 found in each task's log lines."""
    run_id = first_match(F.col(text), fv.RUN_ID_IN_LOG)
    macro_f1 = first_match(F.col(text), fv.MACRO_F1_IN_LOG).try_cast("double")
    found = lines.select(F.col(task), F.col(line), run_id.alias("run_id"), macro_f1.alias("macro_f1"))
    return found.groupBy(task).agg(
        F.min_by("run_id", F.when(F.col("run_id").isNotNull(), F.col(line))).alias("run_id"),
        F.min_by("macro_f1", F.when(F.col("macro_f1").isNotNull(), F.col(line))).alias("macro_f1"),
    )
