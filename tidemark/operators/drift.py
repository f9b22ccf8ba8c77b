"""Population stability and out-of-time monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark import fixed_values as fv
from tidemark.operators.evaluation import loan_default_report, ranking_of_counts
from tidemark.operators.ordered import quantiles_of_counts, value_counts
from tidemark.session import staged
from tidemark.sources import committed


def _steps(buckets: int) -> list[float]:
    return [i / buckets for i in range(buckets + 1)]


def _breaks(counts: DataFrame, buckets: int) -> DataFrame:
    return quantiles_of_counts(counts, _steps(buckets)).select(F.array_distinct("quantiles").alias("breaks"))


def _sketched_breaks(expected: DataFrame, column: str, buckets: int) -> DataFrame:
    sketch = F.percentile_approx(F.col(column).cast("double"), _steps(buckets), 10_000)
    return expected.agg(F.array_distinct(sketch).alias("breaks"))


def psi_table(expected: DataFrame, actual: DataFrame, column: str, buckets: int = 10, exact: bool = True) -> DataFrame:
    """Shares of both sides per bin; bins are the expected side's quantile intervals (lo, hi].

    The minimum and values outside the breaks fall in no bin, and shares are over
    the rows that do. A bin missing on one side gets a small fixed share.
    """
    sketched = None if exact else _sketched_breaks(expected, column, buckets)
    return psi_table_of_counts(value_counts(expected, column), value_counts(actual, column), buckets, sketched)


def psi_table_of_counts(expected: DataFrame, actual: DataFrame, buckets: int = 10, breaks: DataFrame | None = None) -> DataFrame:
    """``psi_table`` from (value, n) counts of both sides; counts of several months add up."""
    values = staged(expected.withColumn("side", F.lit("e")).unionByName(actual.withColumn("side", F.lit("a"))), "psi")
    found = _breaks(values.where("side = 'e'").groupBy("value").agg(F.sum("n").alias("n")), buckets) if breaks is None else breaks
    breaks = (found.first() or [None])[0] or []  # at most buckets + 1 numbers
    edges = F.array(*[F.lit(float(b)) for b in breaks]) if breaks else F.array().cast("array<double>")
    binned = (
        values.withColumn("bin", F.size(F.filter(edges, lambda b: b < F.col("value"))))
        .where(F.col("bin").between(1, len(breaks) - 1))
        .groupBy("bin")
        .agg(*[F.sum(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in ("e", "a")])
    )
    all_bins = Window.partitionBy()  # over at most ``buckets`` rows
    return binned.select(
        "bin", *[_share(F.col(s), F.sum(s).over(all_bins)).alias(name) for s, name in (("e", "expected"), ("a", "actual"))]
    )


def _share(n: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), total), F.lit(fv.EMPTY_BIN_SHARE))


def _index(table: DataFrame) -> DataFrame:
    e, a = F.col("expected"), F.col("actual")
    return table.agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def psi(expected: DataFrame, actual: DataFrame, column: str, buckets: int = 10, exact: bool = True) -> DataFrame:
    return _index(psi_table(expected, actual, column, buckets, exact))


# --- stored summaries --------------------------------------------------------
def store_summaries(rows: DataFrame, path: str, period: str = "snapshot_date", label: str = "label", score: str = "score") -> None:
    """Per period and score the rows, positives and negatives, stored by period; a period stored once more replaces itself."""
    counts = rows.where(F.col(score).isNotNull()).groupBy(period, F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    committed.write_parts(counts, path, [period])


def monitor(spark: SparkSession, path: str, current: Sequence[str], baseline: Sequence[str], period: str = "snapshot_date", buckets: int = 10) -> DataFrame:
    """One row of metrics of the ``current`` periods, and their score PSI against the ``baseline`` periods, from stored summaries alone.

    No period's rows are read, and only the named periods' summaries. NULL where the periods hold one class, or no row.
    """
    def stored(periods: Sequence[str]) -> DataFrame:
        wanted = set(periods)
        counts = committed.read_parts(spark, path, lambda part: committed.part_value(part, period) in wanted)
        return counts.groupBy("score").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neg")])

    now, then = staged(stored(current), "now"), stored(baseline)
    known = now.where(F.col("pos") + F.col("neg") > 0)
    shift = _index(psi_table_of_counts(*[c.select(F.col("score").alias("value"), "n") for c in (then, now)], buckets))
    return ranking_of_counts(known).withColumn("score_psi", shift.scalar())


def out_of_time_report(oot: DataFrame, training: DataFrame, score: str = "score", **names: str) -> DataFrame:
    """Metrics on out-of-time rows plus the score PSI against training."""
    metrics = loan_default_report(oot, score=score, **names)
    shift = psi(training, oot, score)
    return metrics.select(
        F.col("roc_auc").alias("oot_roc_auc"),
        F.col("ks_statistic").alias("oot_ks_statistic"),
        F.col("gini_coefficient").alias("oot_gini_coefficient"),
        F.col("lift_at_10_percentile").alias("oot_lift_at_10"),
        shift.scalar().alias("oot_score_psi"),
    )
