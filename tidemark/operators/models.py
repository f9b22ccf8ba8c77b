"""Training, tuning and scoring of boosted trees and other models."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import boosting
from tidemark.operators.boosting import BoostedTrees
from tidemark.operators.evaluation import macro_f1_by_group, ranking_by_group
from tidemark.operators.features import hash_bucket, stratified_sample, stratified_split
from tidemark.session import staged

# Booster settings and search ranges of the two families.
TREES = {"max_depth": 4, "learning_rate": 0.1, "n_estimators": 150, "subsample": 0.8, "colsample": 0.8, "seed": 42}
SEARCH_RANGES = {
    "n_estimators": (100, 1000, 50),
    "learning_rate_ln": (-3.0, 0.0),
    "max_depth": (3, 10),
    "subsample": (0.7, 1.0),
    "colsample": (0.7, 1.0),
}
MULTICLASS_GRID = {
    "max_depth": (4, 6),
    "learning_rate": (0.05, 0.1),
    "n_estimators": (100, 200),
    "subsample": (0.8, 1.0),
    "colsample": (0.8,),
    "min_child_weight": (1, 5),
}

#: rounds without a lower validation loss after which growth ends
PATIENCE = 30


def assemble(df: DataFrame, features: Sequence[str], fill: float = 0.0, keep: Sequence[str] | None = None) -> DataFrame:
    """Feature columns to one vector; a NULL or NaN feature becomes ``fill``."""
    kept = list(keep if keep is not None else [c for c in df.columns if c not in set(features)])
    filled = df.select(*kept, *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(fill)).alias(c) for c in features])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled).drop(*features)


def train_boosted(train: DataFrame, features: Sequence[str], label: str = "label", **settings) -> BoostedTrees:
    """Family A: a fixed number of boosting rounds."""
    return boosting.fit(train, features, label, **{**TREES, **settings})


def train_boosted_early_stop(
    rows: DataFrame, features: Sequence[str], validation: Column, label: str = "label", patience: int = PATIENCE, **settings
) -> BoostedTrees:
    """Family B: keeps the rounds up to the best one on the validation rows and ends ``patience`` rounds after it; all rows and features per round."""
    return boosting.fit(rows, features, label, validation, patience=patience, **{**TREES, "subsample": 1.0, "colsample": 1.0, **settings})


def score_rows(model: Model | BoostedTrees, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``prediction`` and ``score`` (probability of class 1, or the prediction itself without one)."""
    if isinstance(model, BoostedTrees):
        out = boosting.score_many([model], df, keep, features=features)
        said = F.when(F.col("scores")[1] > 0.5, 1).otherwise(0) if model.classes == 2 else F.array_position("scores", F.array_max("scores")) - 1
        return out.select(*keep, said.cast("int").alias("prediction"), F.col("scores")[1].alias("score"))
    out = model.transform(assemble(df, features, keep=keep))
    prediction = F.col("prediction").cast("int")
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = F.col("prediction").cast("double")
    return out.select(*keep, prediction.alias("prediction"), score.alias("score"))


def score_with(df: DataFrame, features: Sequence[str], keep: Sequence[str], predict: Callable) -> DataFrame:
    """Score with any picklable ``predict(numpy matrix) -> probabilities``, batch by batch in the tasks."""
    wanted = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    rows = df.select(*keep, *wanted)
    names = [f"f{i}" for i in range(len(features))]
    kept = list(keep)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            out = batch[kept].copy()
            out["score"] = predict(batch[names].to_numpy(dtype="float64"))
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.mapInPandas(run, f"{schema}, score double")


def inference_table(
    scored: DataFrame, model_name: str, model_version: str, run_id: str, month: str, key: str = "loan_id"
) -> DataFrame:
    """Rows as stored: the loan id and the customer id both, with model and run."""
    columns = scored.columns
    customer = F.col("customer_id") if "customer_id" in columns else F.col(key)
    return scored.select(
        F.col(key).alias("loan_id"), customer.alias("customer_id"), "snapshot_date",
        F.coalesce("prediction", F.lit(0)).alias("predicted_default"),
        F.coalesce("score", F.lit(0.0)).alias("default_probability"),
        F.lit(model_name).alias("model_name"), F.lit(model_version or "").alias("model_version"),
        F.lit(run_id or "").alias("mlflow_run_id"), F.current_timestamp().alias("inference_date"),
        F.lit(month).alias("month_partition"), F.lit("monthly_inference").alias("execution_context"),
    )


def feature_importances(df_session, model: Model | BoostedTrees, features: Sequence[str], n: int = 20) -> DataFrame:
    """The n most important features (impurity gain); one row per feature exists at all."""
    weights = model.featureImportances.toArray().tolist()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    return df_session.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    ).limit(n)


def draw_settings(trials: int, seed: int = 42, ranges: Mapping = SEARCH_RANGES) -> list[dict]:
    """Random draws from the search ranges; the same seed gives the same draws."""
    import math

    rng = random.Random(seed)
    low, high, step = ranges["n_estimators"]
    draws = []
    for _ in range(trials):
        draws.append({
            "n_estimators": low + step * rng.randrange((high - low) // step + 1),
            "learning_rate": math.exp(rng.uniform(*ranges["learning_rate_ln"])),
            "max_depth": rng.randint(*ranges["max_depth"]),
            "subsample": rng.uniform(*ranges["subsample"]),
            "colsample": rng.uniform(*ranges["colsample"]),
        })
    return draws


def _at_once(spark: SparkSession, work: Callable, settings: Sequence[Mapping], parallelism: int) -> list:
    """``work`` for each of the settings; its jobs run beside each other."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), settings))


def _trial_table(spark: SparkSession, draws: Sequence[Mapping], fitted: Sequence[BoostedTrees]) -> DataFrame:
    """(trial, drawn settings, rounds kept and grown) of a search."""
    rows = [
        (i, int(d["n_estimators"]), float(d["learning_rate"]), int(d["max_depth"]), float(d["subsample"]), float(d["colsample"]), len(m.rounds), m.fitted_rounds)
        for i, (d, m) in enumerate(zip(draws, fitted))
    ]
    return spark.createDataFrame(
        rows, "trial int, n_estimators int, learning_rate double, max_depth int, subsample double, colsample double, rounds int, fitted_rounds int"
    )


@dataclass(frozen=True)
class Search:
    """What a search found: the refitted model, its settings, the table of all trials, and the scored rows behind it."""

    model: BoostedTrees
    settings: dict
    trials: DataFrame
    scored: DataFrame


def tune_boosted(
    rows: DataFrame, features: Sequence[str], label: str = "label", trials: int = 20, seed: int = 42,
    parallelism: int = 4, ranges: Mapping = SEARCH_RANGES, key: str = "loan_id", patience: int = PATIENCE,
) -> Search:
    """Random search for the lowest 1 - AUC on a fifth of every class, then a fit of the best settings on all rows.

    A trial's growth ends ``patience`` rounds after its lowest validation loss, and it is scored at that round. All trials read one staged binning and run
    ``parallelism`` at a time; their validation rows are scored in one pass. ``trials`` of the result has a row per trial: drawn
    settings, rounds, ``loss``, and the ranking metrics of the default report.
    """
    marked = staged(stratified_split(rows, key, label, 0.8), "tuning")
    binned = boosting.bin_rows(marked, features, label, F.col("part") == "test", key=[key])
    draws = [{**d, "learning_rate": min(d["learning_rate"], 1.0), "seed": seed} for d in draw_settings(trials, seed, ranges)]
    fitted = _at_once(rows.sparkSession, lambda d: boosting.grow(binned, patience, **d), draws, parallelism)
    held = marked.where((F.col("part") == "test") & F.col(label).isNotNull())
    scored = staged(
        boosting.score_many(fitted, held, [key, label]).select(
            F.col("model").alias("trial"), F.col(key).alias("key"), F.col(label).alias("label"), F.col("scores")[1].alias("score")
        ), "trials",
    )
    table = _trial_table(rows.sparkSession, draws, fitted).join(F.broadcast(ranking_by_group(scored, "trial")), "trial")
    table = staged(table.withColumn("loss", 1 - F.coalesce("roc_auc", F.lit(0.0))), "trial-table")
    best = draws[table.orderBy("loss", "trial").first()["trial"]]
    return Search(boosting.fit(rows, features, label, key=[key], **best), best, table, scored)


def draw_multiclass(draws: int, seed: int = 42, grid: Mapping = MULTICLASS_GRID) -> list[dict]:
    """Different points of the grid, drawn at random; the same seed gives the same points."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(points, min(draws, len(points)))


def tune_multiclass(
    rows: DataFrame, features: Sequence[str], classes: int, label: str = "label", draws: int = 5, folds: int = 3, seed: int = 42,
    parallelism: int = 4, grid: Mapping = MULTICLASS_GRID, key: str = "loan_id", sample_share: float = 0.1, patience: int = PATIENCE,
) -> Search:
    """Randomised search of one-vs-rest boosting by cross-validated macro F1, then a refit with early stopping.

    The search reads a share of every class; folds follow a hash of the key. Every draw is fitted without each fold in turn and
    predicts it; the mean macro F1 of the folds decides, ties by the earlier draw. The refit holds out a fifth of every class of all rows. Labels are
    class numbers from 0.
    """
    sample = staged(stratified_sample(rows, label, dict.fromkeys(range(classes), sample_share), key, seed), "multiclass") if sample_share < 1 else rows
    points = [{**d, "seed": seed} for d in draw_multiclass(draws, seed, grid)]
    fold = hash_bucket(F.concat(F.lit(f"fold:{seed}:"), F.col(key).cast("string")), folds)
    parts = []
    for f in range(folds):
        binned = boosting.bin_rows(sample.where(fold != f), features, label, classes=classes, key=[key])
        fitted = _at_once(rows.sparkSession, lambda d, b=binned: boosting.grow(b, **d), points, parallelism)
        told = boosting.score_many(fitted, sample.where(fold == f), [key, label])
        parts.append(told.select(F.lit(f).alias("fold"), F.col("model").alias("trial"), F.col(key).alias("key"), F.col(label).alias("label"), "scores"))
    most = F.array_position("scores", F.array_max("scores")) - 1
    scored = staged(reduce(DataFrame.unionByName, parts).withColumn("prediction", most.cast("int")), "folds")
    each = macro_f1_by_group(scored, ["trial", "fold"]).groupBy("trial").agg(F.avg("macro_f1").alias("macro_f1"), F.sum("n").alias("rows"))
    table = rows.sparkSession.createDataFrame([(i, *[float(p[c]) for c in grid]) for i, p in enumerate(points)], ", ".join(["trial int", *[f"{c} double" for c in grid]]))
    table = staged(table.join(F.broadcast(each), "trial"), "trial-table")
    best = points[table.orderBy(F.col("macro_f1").desc_nulls_last(), "trial").first()["trial"]]
    marked = staged(stratified_split(rows, key, label, 0.8), "refit")
    model = boosting.fit(marked, features, label, F.col("part") == "test", classes, patience=patience, key=[key], **best)
    return Search(model, best, table, scored)
