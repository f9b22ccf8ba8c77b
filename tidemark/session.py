"""Session settings, the shared scratch folder, and staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # larger generated methods are never compiled by the JVM; run those stages unfused
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one under the configured warehouse directory."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that this application has staged; for when their readers have run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative learners cut their lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once in the shared folder and scan it from there.

    Used where one plan reads the same reduced table several times: the inputs
    are scanned once, lineage is cut, and each later pass prunes its columns. Spark knows the size
    of the files, so a join broadcasts the table if it is below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles beyond. The write is a job of its own; ``clear_scratch`` removes the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
