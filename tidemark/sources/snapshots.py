"""Snapshot tables: monthly partitions, load-once tables and pruned scans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import calendar
from tidemark.sources import committed

SNAPSHOT = "snapshot_date"
#: batch column of ingested months, which readers do not see
BATCH = "ingest_batch"
FOOTER_COUNTS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
STATIC_TABLES = ("attributes", "financials", "loan_type")


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header; without a schema all columns are text, which the silver recipes read.

    ``infer`` costs one extra pass over the files.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", infer).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_snapshots(df: DataFrame, path: str, by: str = SNAPSHOT, *then: str) -> None:
    """Replace exactly the periods present in ``df`` (by further columns inside them, with ``then``), all in one switch.

    The rebalance hint gathers each period into few files and lets adaptive
    execution split a period that is much larger than the others.
    """
    committed.write_parts(df, path, [by, *then])


def of_period(day: str, by: str = SNAPSHOT) -> Callable[[str], bool]:
    return lambda part: committed.part_value(part, by) == day


def drop_snapshot(spark: SparkSession, path: str, day: str, by: str = SNAPSHOT) -> None:
    """Remove one period."""
    committed.drop_parts(spark, path, of_period(day, by))


def write_snapshot(df: DataFrame, path: str, day: str, by: str = SNAPSHOT) -> None:
    """Replace one period, also when ``df`` has no rows for it any more. The old rows stay readable until the new ones are whole."""
    committed.write_parts(df.where(F.col(by) == F.lit(day).cast("date")), path, [by], drop=of_period(day, by))


def is_loaded(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_once(df: DataFrame, path: str) -> None:
    """Load-once table: a second call changes nothing.

    Only a write that was committed counts; what a failed first load has left is replaced.
    """
    if not is_loaded(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, merge: bool = True) -> DataFrame | None:
    """A stored table, or None when it does not exist.

    The schemas of all months are united, as they may differ in their columns; a column that a month does not have is
    NULL there. A committed table's catalogue knows them. Of other Parquet folders Spark reads the footers, in a job of its own;
    ``merge=False`` saves it where the schema is fixed.
    """
    stored = committed.read_parts(spark, path)
    if stored is not None:
        return stored.drop(BATCH)
    try:
        return spark.read.option("mergeSchema", merge).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def read_months(spark: SparkSession, path: str, months: Sequence[str], by: str = SNAPSHOT) -> DataFrame | None:
    """Only the listed periods of a committed table: no other folder is listed, and no footer is read to plan it. An absent period is skipped."""
    wanted = {m.replace("_", "-") for m in months}
    stored = committed.read_parts(spark, path, lambda part: committed.part_value(part, by) in wanted)
    return stored.drop(BATCH) if stored is not None else None


def read_silver(spark: SparkSession, root: str, table: str, day: str, by: str = SNAPSHOT) -> DataFrame | None:
    """Static tables ignore the date; of the others one period is opened."""
    if table in STATIC_TABLES:
        return read_table(spark, f"{root}/{table}")
    month = read_months(spark, f"{root}/{table}", [day], by)
    if month is not None:
        return month
    df = read_table(spark, f"{root}/{table}")
    return df.where(F.col(by) == F.lit(day).cast("date")) if df is not None else None


def declared_columns(spark: SparkSession, path: str, by: str = SNAPSHOT) -> DataFrame:
    """(period, column_name, type) of a committed table, from its catalogue; no file is opened."""
    told = committed.part_columns(spark, path)
    return told.select(F.regexp_extract("part", f"(?:^|/){by}=([^/]*)", 1).alias("period"), "column_name", "type").distinct()


def _dates(days: Sequence[str]) -> list[Column]:
    return [F.lit(d.replace("_", "-")).cast("date") for d in days]


def in_months(df: DataFrame, months: Sequence[str], by: str = SNAPSHOT) -> DataFrame:
    """Only the listed periods; a listed period that is absent is skipped. Prunes partitions."""
    return df.where(F.col(by).isin(*_dates(months)))


def in_range(df: DataFrame, start: str, end: str, by: str = SNAPSHOT) -> DataFrame:
    low, high = _dates([start, end])
    return df.where(F.col(by).between(low, high))


def in_trailing_weeks(df: DataFrame, end: str, weeks: int = 50, by: str = SNAPSHOT) -> DataFrame:
    """Weekly periods from ``weeks`` weeks before ``end`` through ``end``: weeks + 1 dates."""
    last = F.lit(end).cast("date")
    return df.where(F.array_contains(calendar.trailing_weeks(last, weeks + 1), F.col(by)))


def semi_join_periods(df: DataFrame, periods: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """Periods given as a table."""
    return df.join(periods.select(by).distinct(), by, "left_semi")


def newest_layout(newer: DataFrame, older: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """Two storage layouts of one table: a period comes from the newer if it is there, else the older."""
    fallback = older.join(newer.select(by).distinct(), by, "left_anti")
    return newer.unionByName(fallback, allowMissingColumns=True)


def union_months(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts with data-driven columns; a column absent from a part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def training_rows(features: DataFrame, labels: DataFrame, key: str = "loan_id") -> DataFrame:
    """Features joined to label and snapshot date of the same key."""
    return features.drop("label", SNAPSHOT).join(labels.select(key, "label", SNAPSHOT), key, "inner")


def join_on_shared_key(features: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Inner join on ``id``; else features' ``loan_id`` renamed to ``id``; else ``loan_id``; else None."""
    f, l = set(features.columns), set(labels.columns)
    if "id" in f and "id" in l:
        key = "id"
    elif "loan_id" in f and "id" in l:
        features, key = features.withColumnRenamed("loan_id", "id"), "id"
    elif "loan_id" in f and "loan_id" in l:
        key = "loan_id"
    else:
        return None
    return features.join(labels, key, "inner")


def bundle(
    tables: Mapping[str, DataFrame | None], customer_id: str | None = None
) -> dict[str, DataFrame | None]:
    """Several tables, each lazily filtered to one customer; a missing table stays None."""
    def narrow(df: DataFrame | None) -> DataFrame | None:
        if df is None or customer_id is None or "customer_id" not in df.columns:
            return df
        return df.where(F.col("customer_id") == customer_id)

    return {name: narrow(df) for name, df in tables.items()}


def period_counts(spark: SparkSession, path: str, by: str = SNAPSHOT) -> DataFrame:
    """(period, record_count) of a committed table from the footers of its files; no column is read.

    Spark hands counts to Parquet footers in its second reader only, which a session of its own turns on.
    """
    manifest = committed.read_manifest(spark, path) or committed.Manifest()
    folders = [f"{path}/data/{committed.VERSION}={p.version}/{name}" for name, p in sorted(manifest.parts.items())]
    if not folders:
        return spark.createDataFrame([], f"{by} date, record_count long")
    own = spark.newSession()
    for name, value in FOOTER_COUNTS.items():
        own.conf.set(name, value)
    schema = StructType([*manifest.schema().fields, *manifest.by.fields, StructField(committed.VERSION, StringType())])
    files = own.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    counts = files.groupBy(by, committed.VERSION).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(by).agg(F.sum("n").alias("record_count"))


def inventory(spark: SparkSession, roots: Mapping[str, str], tables: Sequence[str], by: str = SNAPSHOT) -> DataFrame:
    """(layer, table, period) of what is stored under the root of each layer: the periods of committed tables, by their catalogue, and NULL for a load-once table.

    No data file is opened.
    """
    rows = []
    for layer, root in roots.items():
        for name in tables:
            manifest = committed.read_manifest(spark, f"{root}/{name}")
            if manifest:
                rows += [(layer, name, day) for day in {committed.part_value(part, by) for part in manifest.parts}]
            elif is_loaded(spark, f"{root}/{name}"):
                rows.append((layer, name, None))
    return spark.createDataFrame(rows, "layer string, table string, day string").select("layer", "table", F.col("day").try_cast("date").alias("period"))


def bundle_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table as one union; a missing table counts 0."""
    counts = [
        (df.agg(F.count(F.lit(1)).alias("n")) if df is not None else spark.range(1).select(F.lit(0).cast("long").alias("n")))
        .select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = 64) -> None:
    """A catalogue table whose files are bucketed and sorted by ``key``: tables of equal buckets join on it without a shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
