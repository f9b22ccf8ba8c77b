"""Indicators of open sets of values: a dictionary table and one sparse vector per row.

The wide form has a column per value and needs all values on the driver; here they stay a table, values and codes
meet in a join, and a row's codes become one vector. Nothing is collected, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators.ordered import row_numbers
from tidemark.operators.skew import left_join_chain
from tidemark.session import scratch_path, staged


def _mentions(values: Mapping[str, Column]) -> Column:
    """(column, value) for every value that a row has, in one array."""
    def named(name: str, listed: Column) -> Column:
        return F.transform(F.coalesce(listed.cast("array<string>"), F.array().cast("array<string>")), lambda x: F.struct(F.lit(name).alias("column"), x.alias("value")))

    return F.concat(*[named(name, listed) for name, listed in values.items()])


def dictionary(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """(column, value, code) of all distinct values of the named array columns; codes count from 0 in the order of column and value.

    NULL values have no code.
    """
    found = df.select(F.explode(_mentions(values)).alias("m")).select("m.*").where("value is not null").distinct()
    coded = row_numbers(found, [F.col("column").asc(), F.col("value").asc()], "code")
    return staged(coded.select("column", "value", (F.col("code") - 1).cast("int").alias("code")), "dictionary")


def sparse_indicators(
    df: DataFrame, values: Mapping[str, Column], codes: DataFrame | None = None, counts: bool = False, name: str = "indicators",
) -> tuple[DataFrame, DataFrame]:
    """``df`` with a sparse vector of the values that each row has, and the dictionary that says which place is which value.

    A place holds 1, or with ``counts`` how often the row names the value. Values outside the given dictionary are left out, so that months
    encode alike. A row without any value has an empty vector. A value that very many rows have is split over tasks.
    """
    rows = staged(df.withColumns({"_row": F.monotonically_increasing_id(), "_mentions": _mentions(values)}), "rows")
    codes = codes if codes is not None else dictionary(df, values)
    size = codes.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("n")).scalar()
    # a value named twice in a row is one pair with a count, before anything is shuffled
    named = F.array_distinct("_mentions")
    times = F.transform(named, lambda m: F.struct(m.alias("m"), F.size(F.filter("_mentions", lambda x: x == m)).alias("times"))) if counts else F.transform(
        named, lambda m: F.struct(m.alias("m"), F.lit(1).alias("times")))
    pairs = rows.select("_row", F.explode(times).alias("p")).select("_row", F.struct("p.m.column", "p.m.value").alias("m"), "p.times")
    pairs = pairs.withColumn("m", F.to_json("m"))
    known = codes.select(F.to_json(F.struct("column", "value")).alias("m"), "code")
    coded = left_join_chain(pairs.where("m is not null"), [known], "m", ["_row"]).where("code is not null")
    listed = coded.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("code", "times"))).alias("c"))
    empty = F.array().cast("array<struct<code:int,times:int>>")
    c = F.coalesce(F.col("c"), empty)
    # the stored form of a sparse vector: kind 0, size, places, values
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"), F.transform(c, lambda x: x["code"]).alias("indices"),
        F.transform(c, lambda x: x["times"].cast("double")).alias("values"),
    )
    made = rows.join(listed, "_row", "left").select(*df.columns, vector.alias(name))
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "indicators")
    made.write.parquet(path)
    return spark.read.schema(StructType([*df.schema.fields, StructField(name, VectorUDT())])).parquet(path), codes


def places_of(vectors: DataFrame, codes: DataFrame, key: Sequence[str], name: str = "indicators", keep_code: bool = False) -> DataFrame:
    """(key, column, value, times): a vector's places back as values, by a join with the dictionary; with the place itself if asked for."""
    stored = F.unwrap_udt(F.col(name))
    each = F.explode(F.arrays_zip(stored["indices"].alias("code"), stored["values"].alias("times")))
    places = vectors.select(*key, each.alias("z")).select(*key, F.col("z.code").alias("code"), F.col("z.times").alias("times"))
    return places.join(codes, "code").select(*key, "column", "value", *(["code"] if keep_code else []), "times")
