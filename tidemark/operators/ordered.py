"""Running totals and exact quantiles over a global order.

The input is already reduced to distinct keys and is staged once. It is range-partitioned
and sorted on the order; each range adds up its own running sums while it is written, and
the few range totals become start offsets. There is one path for tables of any size.

Staging runs jobs when the operator is called, not when its result is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tidemark.session import staged

RUN = "_run"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _sum_up(sums: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(sums, 0)
        for batch in batches:
            added = []
            for c in sums:
                so_far = pc.add(pc.cumulative_sum(batch.column(c)), carried[c])
                if len(so_far):
                    carried[c] = so_far[len(so_far) - 1].as_py()
                added.append(so_far)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *[f"_{c}_sum" for c in sums]])

    return run


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    within: Sequence[str] = (),
    is_staged: bool = False,
) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_through`` for every count column in ``sums``.

    ``df`` must already be reduced to one row per ``within`` + ``order`` key, so
    that a hot value is one row and cannot fill a range by itself. Counts are not
    negative. ``is_staged`` says that ``df`` is read from a staged table already.
    """
    within = list(within)
    counted = df.withColumns({c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in sums})
    counted = counted if is_staged else staged(counted, "counts")
    # the sums are added up in Arrow batches while the ranges are staged: a window would
    # need the rows shuffled and sorted a second time
    keys = [F.col(c) for c in within]
    # staging also freezes the range ids, so a lost executor cannot renumber them
    ranged = counted.repartitionByRange(*keys, *order).withColumn(RUN, F.spark_partition_id())
    schema = StructType(counted.schema.fields).add(RUN, IntegerType())
    for c in sums:
        schema = schema.add(f"_{c}_sum", LongType())
    runs = staged(ranged.sortWithinPartitions(*keys, *order).mapInArrow(_sum_up(sums), schema), "runs")

    earlier = Window.partitionBy(*within).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy(*within, RUN).agg(
        *[F.sum(c).alias(c) for c in sums],
        # a range may hold the end of one group and the start of the next
        *[F.min(F.col(f"_{c}_sum") - F.col(c)).alias(f"_{c}_base") for c in sums],
    )
    starts = totals.select(
        *within, RUN,
        *[(F.coalesce(F.sum(c).over(earlier), F.lit(0)) - F.col(f"_{c}_base")).alias(f"_{c}_start") for c in sums],
    )
    if within:
        placed = null_safe_join(runs, staged(starts, "starts"), [*within, RUN])
    else:
        # one row per range, at most spark.sql.shuffle.partitions of them
        placed = runs.join(F.broadcast(starts), RUN)
    through = {c: F.col(f"_{c}_sum") + F.col(f"_{c}_start") for c in sums}
    return placed.select(
        *counted.columns,
        *[through[c].alias(f"{c}_through") for c in sums],
        *[(through[c] - F.col(c)).alias(f"{c}_before") for c in sums],
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "rn", within: Sequence[str] = ()) -> DataFrame:
    """``row_number()`` over a unique order."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"], within)
    return ranked.withColumn(name, F.col("_one_through")).drop("_one", "_one_through", "_one_before")


def value_counts(df: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """Non-null values with their counts: the reduced form quantiles work on."""
    value = F.col(column).alias("value")
    return df.select(*within, value).where(F.col("value").isNotNull()).groupBy(*within, "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    interpolate: bool = True,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row (per ``within`` group) with the array ``quantiles``.

    ``interpolate=True`` follows the linear rule at rank ``p * (n - 1)``;
    ``False`` returns the smallest value whose share of rows reaches ``p``.
    """
    return quantiles_of_counts(value_counts(df, column, within), probabilities, interpolate, within)


def quantiles_of_counts(
    counts: DataFrame, probabilities: Sequence[float], interpolate: bool = True, within: Sequence[str] = (),
    is_staged: bool = False,
) -> DataFrame:
    """``exact_quantiles`` over rows already reduced by ``value_counts``."""
    within = list(within)
    ranked = running_totals(counts, [F.col("value").asc()], ["n"], within, is_staged)
    total = ranked.groupBy(*within).agg(F.sum("n").alias("total"))
    ranked = (
        null_safe_join(ranked, staged(total, "totals"), within)
        if within else ranked.withColumn("total", total.scalar())
    )

    def position(p: float) -> Column:
        if interpolate:
            return F.lit(float(p)) * (F.col("total") - 1)
        return F.greatest(F.ceil(F.lit(float(p)) * F.col("total")) - 1, F.lit(0)).cast("double")

    def covers(rank: Column) -> Column:
        return (rank >= F.col("n_before")) & (rank < F.col("n_through"))

    # a value row covers the 0-based ranks [before, through); plain comparisons leave
    # at most two rows per probability
    wanted = [
        (slot, position(p), rank(position(p)).cast("long"))
        for slot, p in enumerate(probabilities) for rank in (F.floor, F.ceil)
    ]
    near = ranked.where(reduce(lambda a, b: a | b, [covers(rank) for _, _, rank in wanted]))
    listed = F.array(*[
        F.when(covers(rank), F.struct(F.lit(slot).alias("slot"), at.alias("at"))) for slot, at, rank in wanted
    ])
    hits = near.select(*within, "value", F.explode(F.array_compact(listed)).alias("w"))
    low = F.min("value")
    per_slot = hits.groupBy(*within, F.col("w.slot").alias("slot")).agg(
        (low + (F.max("value") - low) * (F.max("w.at") - F.floor(F.max("w.at")))).alias("q")
    )
    return per_slot.groupBy(*within).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "q"))), lambda s: s["q"]).alias("quantiles")
    )
