"""Column selection, casting and schema-driven projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from tidemark.functions import text


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient cast of the named columns in one projection; a bad value is NULL."""
    textual = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}

    def cast(name: str) -> Column:
        if name not in types:
            return F.col(name)
        kind = types[name]
        return (text.parse(F.col(name), kind) if name in textual else F.col(name).try_cast(kind)).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def on_snapshot(df: DataFrame, day: str, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(day).cast("date"))


def at_mob(df: DataFrame, mob: int) -> DataFrame:
    return df.where(F.col("mob") == mob)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns but the excluded ones; excluded names that do not exist are ignored."""
    left_out = set(exclude)
    return [c for c in df.columns if c not in left_out]


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected features in order, absent ones as 0; no list means all columns."""
    if not expected:
        return df
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0).alias(c) for c in expected])


def lookup(df: DataFrame, customer_id: str) -> DataFrame:
    return df.where(F.col("customer_id") == customer_id)


def vocabularies(df: DataFrame, values: Mapping[str, Column]) -> dict[str, list[str]]:
    """Sorted distinct values of each (array of) column that is to become columns, in one pass.

    The values are reduced where the rows are. They become a plan with a column for each, so they have to fit the driver;
    for open sets of values use the long form instead of columns.
    """
    each = F.explode(F.concat(*[
        F.transform(F.coalesce(v, F.array().cast("array<string>")), lambda x: F.struct(F.lit(name).alias("c"), x.alias("v")))
        for name, v in values.items()
    ]))
    found: dict[str, list[str]] = {name: [] for name in values}
    for row in df.select(each.alias("p")).where("p.v is not null").select("p.*").distinct().collect():
        found[row.c].append(row.v)
    return {name: sorted(listed) for name, listed in found.items()}


def vocabulary(df: DataFrame, value: Column) -> list[str]:
    """``vocabularies`` of one array column."""
    return vocabularies(df, {"v": value})["v"]
