"""Data-quality reports: duplicates, missing keys, nulls, partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.operators.skew import left_join_chain
from tidemark.session import staged



# --- duplicates --------------------------------------------------------------
def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, most frequent first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    return counts.orderBy(F.col("count").desc(), key)


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """For every duplicated key, which columns differ between its rows.

    A column differs when its extremes differ or when it is NULL on some rows only;
    both are plain partial aggregates, so a hot key costs no more than others. The key column
    alone is counted first, and only rows of repeated keys are read with all their columns.
    """
    others = [c for c in df.columns if c != key]
    # staged, so that the join knows its size: few keys are repeated as a rule
    counts = df.select(key).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = staged(counts.select(F.col(key).alias("_repeated")), "repeated")
    df = df.join(repeated, F.col(key).eqNullSafe(F.col("_repeated")), "left_semi")

    def differs(c: str) -> Column:
        partly_null = (F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))
        return F.coalesce(F.min(c) != F.max(c), F.lit(False)) | partly_null

    flags = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), *[differs(c).alias(f"_{i}") for i, c in enumerate(others)])
    names = F.array_compact(F.array(*[F.when(F.col(f"_{i}"), F.lit(c)) for i, c in enumerate(others)]))
    same = F.array_compact(F.array(*[F.when(~F.col(f"_{i}"), F.lit(c)) for i, c in enumerate(others)]))
    return flags.where("count > 1").select(
        key, "count", F.array_sort(names).alias("differing_columns"), F.array_sort(same).alias("same_columns"),
        (F.size(names) == 0).cast("int").alias("exact_duplicate"),
    )


def shared_name_counts(df: DataFrame, name: str = "name") -> DataFrame:
    """Rows per name joined back; a NULL name has no count and is not shared.

    The counts are pre-aggregated and a name held by very many rows is split over
    several tasks in the join.
    """
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("name_shared_count")).where(F.col(name).isNotNull())
    spread_on = [c for c in df.columns if c != name]
    joined = left_join_chain(df, [counts], name, spread_on)
    return joined.withColumn("is_name_shared", F.when(F.col("name_shared_count") > 1, 1).otherwise(0))


# --- keys on one side --------------------------------------------------------
def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of left absent from right; NULL keys compare equal.

    Both sides are made distinct before the shuffle, where a hot key is one row per task.
    """
    return left.select(*keys).distinct().subtract(right.select(*keys).distinct())


def key_intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).distinct().intersect(right.select(*keys).distinct())


def rows_without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full rows of left whose key is absent from right; a NULL key never matches."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def missing_ids(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side that lacks them, in one pass over both."""
    sides = features.select(key, F.lit(1).alias("in_features"), F.lit(0).alias("in_labels")).unionByName(
        labels.select(key, F.lit(0).alias("in_features"), F.lit(1).alias("in_labels"))
    )
    seen = sides.groupBy(key).agg(F.max("in_features").alias("f"), F.max("in_labels").alias("l"))
    return seen.where(F.col("f") != F.col("l")).select(
        key, F.when(F.col("f") == 1, "labels").otherwise("features").alias("missing_in")
    )


def missing_summary(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and one-sided keys of both tables as one row."""
    sides = features.select(key, F.lit(1).alias("f"), F.lit(0).alias("l")).unionByName(
        labels.select(key, F.lit(0).alias("f"), F.lit(1).alias("l"))
    )
    seen = sides.groupBy(key).agg(F.sum("f").alias("f"), F.sum("l").alias("l"))
    in_f, in_l = F.col("f") > 0, F.col("l") > 0
    return seen.agg(
        F.sum("f").alias("feature_rows"), F.sum("l").alias("label_rows"),
        F.count_if(in_f).alias("feature_ids"), F.count_if(in_l).alias("label_ids"),
        F.count_if(in_f & ~in_l).alias("missing_in_labels"), F.count_if(in_l & ~in_f).alias("missing_in_features"),
    )


def first_keys(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The n smallest distinct keys, as a reproducible sample."""
    return df.select(key).distinct().orderBy(key).limit(n)


def sample_rows_of(df: DataFrame, ids: DataFrame, key: str, n: int = 5) -> DataFrame:
    """All rows of the n smallest given ids (at most n ids are broadcast)."""
    return df.join(F.broadcast(first_keys(ids, key, n)), key, "left_semi")


def key_overlap(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Number of distinct keys per exact combination of tables that hold them."""
    names = sorted(tables)
    tagged = reduce(
        DataFrame.unionByName,
        [tables[t].select(*keys, F.lit(1 << i).alias("bit")) for i, t in enumerate(names)],
    )
    masks = tagged.groupBy(*keys).agg(F.bit_or("bit").alias("mask"))
    held = F.array_join(
        F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(1 << i) > 0, t) for i, t in enumerate(names)])), "+"
    )
    return masks.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).select(held.alias("tables"), "n")


# --- nulls -------------------------------------------------------------------
def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and their percentage per column, from one aggregate."""
    columns = list(columns if columns is not None else df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["_rows"], columns, "column_name", "null_count")
    return long.select(
        "column_name", "null_count", F.col("_rows").alias("total_rows"),
        F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("_rows").cast("double")), F.lit(0.0)).alias("null_pct"),
    )


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns if columns is not None else df.columns)
    return df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "non_null")


def gold_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row and column counts and the nulls of the given columns (absent ones are skipped)."""
    present = [c for c in keys if c in df.columns]
    return null_profile(df, present).withColumn("n_columns", F.lit(len(df.columns)))


# --- partitions --------------------------------------------------------------
def partition_inventory(df: DataFrame, period: Column, snapshot: str | None = "snapshot_date", flags: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct snapshot dates per period, and whether columns exist.

    ``snapshot=None`` is a store without that column: the period is its only date.
    """
    rows = df.withColumn("period", period)
    dates = F.count_distinct(snapshot) if snapshot else F.lit(1).cast("long")
    has = [F.lit(int(c in df.columns)).alias(f"has_{c}") for c in flags]
    if not snapshot:
        return rows.groupBy("period").agg(F.count(F.lit(1)).alias("record_count")).select("*", dates.alias("snapshot_dates"), *has)
    # reduce to (period, date) first: a hot period is then a handful of rows
    reduced = rows.groupBy("period", snapshot).agg(F.count(F.lit(1)).alias("n"))
    return reduced.groupBy("period").agg(F.sum("n").alias("record_count"), F.count(snapshot).alias("snapshot_dates")).select(
        "*", *has
    )


def compare_partitions(left: DataFrame, right: DataFrame, period: str = "period", count: str = "record_count") -> DataFrame:
    """Full outer comparison of two inventories; the difference only where both exist."""
    l = left.select(period, F.col(count).alias("feature_count"))
    r = right.select(period, F.col(count).alias("label_count"))
    return l.join(r, period, "full_outer").withColumn(
        "presence",
        F.when(F.col("label_count").isNull(), "feature_only").when(F.col("feature_count").isNull(), "label_only").otherwise("both"),
    ).withColumn("difference", F.col("feature_count") - F.col("label_count"))


def difference_summary(compared: DataFrame) -> DataFrame:
    d = F.col("difference")
    return compared.agg(
        F.sum("feature_count").alias("total_feature_records"),
        F.sum("label_count").alias("total_label_records"),
        (F.coalesce(F.sum("feature_count"), F.lit(0)) - F.coalesce(F.sum("label_count"), F.lit(0))).alias("total_difference"),
        F.avg(d).alias("avg_difference"), F.max(d).alias("max_difference"), F.min(d).alias("min_difference"),
        F.count_if(d > 0).alias("more_features"), F.count_if(d < 0).alias("more_labels"), F.count_if(d == 0).alias("equal_counts"),
        F.avg(F.when(d > 0, d)).alias("avg_feature_excess"), F.avg(F.when(d < 0, -d)).alias("avg_label_excess"),
    )


def availability(found: DataFrame, periods: DataFrame, static_from: str) -> DataFrame:
    """'data_available' or 'data_unavailable' per period, with what is missing.

    ``found`` has (layer, table, period); a static table has a NULL period and is
    required only after ``static_from``. The required grid is layers x tables per
    period, built without a join.
    """
    layers = ("bronze", "silver")
    monthly = [(l, t) for t in ("clickstream", "lms") for l in layers]
    static = [(l, t) for t in ("attributes", "financials") for l in layers]

    def need(pairs, is_static: bool) -> Column:
        return F.array(*[F.struct(F.lit(l).alias("layer"), F.lit(t).alias("table"), F.lit(is_static).alias("static")) for l, t in pairs])

    after = F.col("period") > F.lit(static_from).cast("date")
    grid = periods.select(
        "period", F.explode(F.when(after, F.concat(need(monthly, False), need(static, True))).otherwise(need(monthly, False))).alias("n")
    ).select("period", "n.layer", "n.table", F.when(~F.col("n.static"), F.col("period")).alias("at"))
    have = found.select("layer", "table", F.col("period").alias("at")).distinct()
    checked = grid.join(
        have.withColumn("hit", F.lit(1)),
        (grid["layer"] == have["layer"]) & (grid["table"] == have["table"]) & grid["at"].eqNullSafe(have["at"]),
        "left",
    ).select(grid["period"], grid["layer"], grid["table"], "hit")
    absent = F.count_if(F.col("hit").isNull())
    return checked.groupBy("period").agg(
        absent.alias("n_missing"), F.when(absent == 0, fv.DATA_AVAILABLE).otherwise(fv.DATA_UNAVAILABLE).alias("status")
    )


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """How columns drift over several tables or partitions of one table.

    Per column: in how many tables it has values, in how many it is declared, its
    types, and its filled values. One aggregate per table, then a few rows per column.
    """
    def filled(df: DataFrame) -> DataFrame:
        counts = non_null_counts(df)
        kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
        return counts.select("column_name", "non_null", F.try_element_at(kinds, F.col("column_name")).alias("type"))

    rows = reduce(DataFrame.unionByName, [filled(df) for df in tables.values()])
    return rows.groupBy("column_name").agg(
        F.count_if(F.col("non_null") > 0).alias("present_in"),
        F.count(F.lit(1)).alias("declared_in"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"),
        F.sum("non_null").alias("filled"),
    )


def period_profile(df: DataFrame, declared: DataFrame, period: str = "snapshot_date") -> DataFrame:
    """``column_profile`` over all periods of one table, whose declared columns (period, column_name, type) are known from its catalogue.

    One aggregate counts the values of all columns in all periods.
    """
    names = [r[0] for r in declared.select("column_name").distinct().collect() if r[0] in df.columns]
    counts = df.groupBy(F.col(period).cast("string").alias("period")).agg(*[F.count(c).alias(c) for c in names])
    filled = counts.unpivot(["period"], names, "column_name", "non_null")
    return declared.join(filled, ["period", "column_name"], "left").groupBy("column_name").agg(
        F.count_if(F.col("non_null") > 0).alias("present_in"), F.count_distinct("period").alias("declared_in"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.coalesce(F.sum("non_null"), F.lit(0)).alias("filled"),
    )


def join_audit(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Row count after each named join step, as one union."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("step"), "n_rows") for name, df in steps.items()],
    )


