"""Imputation, one-hot encoding, splits and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.operators.columns import numeric_columns
from tidemark.operators.ordered import null_safe_join, row_numbers, running_totals
from tidemark.session import staged


def _without_nan(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def impute_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill numeric NULLs with the column mean, cast back to the column's type.

    All means come from one aggregate. A column without any value has no mean and
    stays as it is; an integer column gets its mean cut to an integer.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    if not columns:
        return df
    means = df.agg(F.struct(*[F.avg(_without_nan(df, c)).alias(c) for c in columns]).alias("m")).scalar()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    chosen = set(columns)
    filled = df.withColumn("_means", means)
    return filled.select(
        *[
            F.coalesce(_without_nan(df, c), F.col("_means")[c].try_cast(kinds[c])).alias(c) if c in chosen else F.col(c)
            for c in df.columns
        ]
    )


def usable_columns(df: DataFrame) -> DataFrame:
    """Non-null count of every numeric column and whether it can be imputed."""
    names = numeric_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    long = counts.unpivot([], names, "column_name", "non_null")
    return long.withColumn("imputable", (F.col("non_null") > 0).cast("int"))


def category_labels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Labels of each column, most frequent first, then by name; one job for all columns.

    Each label becomes a column of the plan, so all of them have to fit the driver; give ``labels`` for open sets.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    counted = (
        df.select(pairs.alias("p")).where(F.col("p.v").isNotNull())
        .groupBy("p.c", "p.v").count().collect()
    )
    ranked = sorted(counted, key=lambda r: (-r["count"], r["v"]))
    return {c: [r["v"] for r in ranked if r["c"] == c] for c in columns}


def one_hot(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per label, named ``column_label`` in lower case."""
    out: dict[str, Column] = {}
    for column, values in labels.items():
        for value in values:
            out[f"{column}_{value.lower()}"] = F.when(F.col(column) == value, 1).otherwise(0)
    kept = [c for c in df.columns if c not in labels and c not in out]
    return df.select(*kept, *[expr.alias(name) for name, expr in out.items()])


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A bucket from the first 32 bits of the key's MD5: any type of key, and the same in other engines."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % buckets


def split_by_key(df: DataFrame, key: str, train_share: int = 80) -> DataFrame:
    """Reproducible train / test mark from a key of any type, without a shuffle; a NULL key is test."""
    return df.withColumn("part", F.when(hash_bucket(F.col(key)) < train_share, "train").otherwise("test"))


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test


def stratified_split(
    df: DataFrame, key: str, label: str, train_share: float = 0.8, order: Sequence[Column] | None = None
) -> DataFrame:
    """Mark ``floor(share * n)`` rows of every class as train.

    Rows are ranked inside their class by ``order`` (a hash of the key by default) with
    the two-level running total, so a class of any size uses all tasks. Only the last
    train position of each class comes back to the rows, which are not shuffled for it.
    Where rows equal in ``order`` lie across the cut, as many of them are train as are missing, by a hash of the whole row.
    """
    order = list(order) if order is not None else [F.xxhash64(key), F.col(key)]
    names = [f"_o{i}" for i in range(len(order))]
    position = [expr.alias(name) for expr, name in zip(order, names)]
    places = df.groupBy(label, *position).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(places, [F.col(c).asc() for c in names], ["n"], [label])
    sizes = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(train_share)).alias("_train_n"))
    begun = null_safe_join(ranked, staged(sizes, "class-sizes"), [label]).where(F.col("n_before") < F.col("_train_n"))
    whole, at = F.col("n_through") <= F.col("_train_n"), F.struct(*names)
    cuts = staged(
        begun.groupBy(label).agg(
            F.max(F.when(whole, at)).alias("_cut"), F.max(F.when(~whole, at)).alias("_edge"),
            F.max(F.when(~whole, F.col("_train_n") - F.col("n_before"))).alias("_missing"),
        ), "class-cuts",
    )
    here, columns = F.struct(*position), [F.col(f"`{c}`") for c in df.columns]
    part = F.when(here <= F.col("_cut"), "train").otherwise("test").alias("part")
    joined = null_safe_join(df, cuts, [label], "left")
    if cuts.where(F.col("_edge").isNotNull()).isEmpty():
        return joined.select(*columns, part)
    on_edge = F.coalesce(here == F.col("_edge"), F.lit(False))
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    # the staged number tells rows apart that are equal in every column
    edge = staged(joined.where(on_edge).select(*columns, "_missing", hashed.alias("_h"), F.monotonically_increasing_id().alias("_id")), "class-edges")
    numbered = row_numbers(edge, [F.col("_h").asc(), F.col("_id").asc()], "_rn", [label])
    dealt = numbered.select(*columns, F.when(F.col("_rn") <= F.col("_missing"), "train").otherwise("test").alias("part"))
    return joined.where(~on_edge).select(*columns, part).unionByName(dealt)


SAMPLE_PARTS = 1_000_000


def _in_sample(key: str, fraction: Column, seed: int) -> Column:
    part = hash_bucket(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), SAMPLE_PARTS)
    return part < F.round(fraction * SAMPLE_PARTS)


def stratified_sample(df: DataFrame, label: str, fractions: Mapping, key: str, seed: int = 42) -> DataFrame:
    """About ``fractions[label]`` of each class, by a hash of the key: the same rows whatever the partitions. Other classes go."""
    share = F.try_element_at(F.create_map(*[F.lit(x) for k, v in fractions.items() for x in (k, float(v))]), F.col(label))
    return df.where(F.coalesce(_in_sample(key, share, seed), F.lit(False)))


def sample_rows(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, by a hash of the key: the same rows whatever the partitions."""
    return df.where(_in_sample(key, F.lit(float(fraction)), seed))


def label_indexes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their alphabetical index; the sort is over distinct values only."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return row_numbers(values, [F.col(column).asc()], "_rn").select(
        column, (F.col("_rn") - 1).cast("int").alias(f"{column}_index")
    )


def encode_labels(df: DataFrame, column: str) -> DataFrame:
    return df.join(staged(label_indexes(df, column), "label-index"), column, "left")


def decode_labels(df: DataFrame, index: str, mapping: DataFrame, column: str, unknown: str = "Unknown") -> DataFrame:
    """Index back to label; an index outside the mapping becomes ``unknown``."""
    names = mapping.select(F.col(f"{column}_index").alias(index), F.col(column).alias("_name"))
    return df.join(staged(names, "label-names"), index, "left").withColumn(
        f"{index}_label", F.coalesce("_name", F.lit(unknown))
    ).drop("_name")
