"""Training window to champion, and monthly scoring, as one flow over tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.operators import features as feats, models, registry
from tidemark.operators.columns import align_features, feature_columns, numeric_columns
from tidemark.operators.evaluation import loan_default_report, monthly_report, ranking_metrics
from tidemark.session import staged
from tidemark.sources import snapshots


def window_rows(features: DataFrame, labels: DataFrame, day: str, months: int = 12) -> DataFrame:
    """Joined rows of the ``months`` months that end before ``day``; partitions are pruned on both sides."""
    end = F.lit(day.replace("_", "-")).cast("date")
    window = F.col("snapshot_date").between(F.add_months(end, -months), F.add_months(end, -1))
    on_month = F.col("snapshot_date") == F.trunc("snapshot_date", "month")
    narrow = features.where(window) if "snapshot_date" in features.columns else features
    return snapshots.training_rows(narrow, labels.where(window & on_month))


def initial_rows(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Joined rows of the fixed first training window, both ends included."""
    narrow = snapshots.in_range(features, *fv.INITIAL_WINDOW) if "snapshot_date" in features.columns else features
    return snapshots.training_rows(narrow, snapshots.in_range(labels, *fv.INITIAL_WINDOW))


def training_features(rows: DataFrame) -> list[str]:
    numeric = set(numeric_columns(rows))
    return [c for c in feature_columns(rows, fv.TRAINING_EXCLUDES) if c in numeric]


def train_candidates(
    rows: DataFrame, features: Sequence[str], seed: int = 42, key: str = "loan_id", **settings
) -> tuple[dict[str, Model], DataFrame]:
    """Both families on the same 80/20 split, with their validation AUC as a table.

    The split follows a hash of the key and its rows are staged once, so no row can be on both sides.
    """
    marked = staged(feats.split_by_key(rows, key, 80), "split")
    train, valid = (marked.where(F.col("part") == part).drop("part") for part in ("train", "test"))
    fitted = {
        "LightGBM": models.train_boosted(train, features, seed=seed, **settings),
        "CatBoost": models.train_boosted_early_stop(
            train.withColumn("_v", F.lit(False)).unionByName(valid.withColumn("_v", F.lit(True))),
            features, F.col("_v"), seed=seed, **settings,
        ),
    }
    scores = None
    for family, model in fitted.items():
        scored = models.score_rows(model, valid, features, ["label"])
        row = ranking_metrics(scored).select(
            F.lit(family).alias("model_type"), F.lit(f"{family.lower()}-{seed}").alias("run_id"), F.col("roc_auc").alias("auc")
        )
        scores = row if scores is None else scores.unionByName(row)
    return fitted, scores


def tune_and_refit(
    rows: DataFrame, features: Sequence[str], key: str = "loan_id", label: str = "label", sample_share: float = 0.1,
    trials: int = 20, seed: int = 42, **options,
) -> tuple[Model, dict, DataFrame]:
    """Nested split, search on a stratified sample, refit that keeps the best round, full report on the test rows.

    A fifth of the keys is the test; of the others a fifth is held out for the refit. All splits follow hashes of the key.
    """
    marked = staged(feats.split_by_key(rows, key, 80), "nested")
    train, test = (marked.where(F.col("part") == part).drop("part") for part in ("train", "test"))
    classes = [r[0] for r in train.select(label).where(F.col(label).isNotNull()).distinct().collect()]  # a model has few
    sample = staged(feats.stratified_sample(train, label, dict.fromkeys(classes, sample_share), key, seed), "tuning")
    settings = models.tune_boosted(sample, features, label, trials, seed, key=key, **options).settings
    held_out = feats.hash_bucket(F.concat(F.lit("held:"), F.col(key).cast("string"))) < 20
    model = models.train_boosted_early_stop(train, features, held_out, label, **settings)
    scored = models.score_rows(model, test, features, [key, label])
    return model, settings, loan_default_report(scored, key=key, label=label)


def retrain(
    features: DataFrame, labels: DataFrame, versions: DataFrame, day: str, model_name: str = "credit_scoring_model",
    seed: int = 42, **settings,
) -> dict:
    """Train on the window that belongs to ``day`` and prepare the registry rows.

    The first training date uses its fixed window, later dates the 12 months before.
    Returns the winning ``model``, its ``features``, and the ``scores``, ``version``
    and ``tracker`` tables; nothing is written.
    """
    first = day.replace("_", "-") == fv.INITIAL_TRAINING_DATE
    rows = initial_rows(features, labels) if first else window_rows(features, labels, day)
    names = training_features(rows)
    fitted, scores = train_candidates(rows, names, seed, **settings)
    scores = staged(scores, "scores")
    champion = registry.choose_champion(scores, "auc")
    version = staged(registry.next_version(versions, model_name, champion), "version")
    when = F.lit(day.replace("_", "-")).cast("date")
    return {
        "model": fitted[champion.first()["model_type"]], "features": names, "scores": scores, "version": version,
        "tracker": registry.tracker_row(champion, version.select("version").scalar(), when, "auc", model_name),
    }


def monthly_inference(
    model: Model, rows: DataFrame, features: Sequence[str], month: str, version: str, run_id: str,
    model_name: str = "credit_scoring_model",
) -> tuple[DataFrame, DataFrame]:
    """Stored prediction rows and the month's metric row.

    Features the month does not have count as 0 and columns the model does not know are left out.
    """
    keep = [c for c in ("loan_id", "customer_id", "snapshot_date", "label") if c in rows.columns]
    scored = models.score_rows(model, align_features(rows, features, keep), features, keep)
    table = models.inference_table(scored, model_name, version, run_id, month)
    metrics = monthly_report(scored).withColumns({
        "month_date": F.lit(month), "model_name": F.lit(model_name), "mlflow_run_id": F.lit(run_id),
    })
    return table, metrics
