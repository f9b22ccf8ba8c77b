"""Scratch tables and Arrow helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_root

#: white space of the contracts: space and U+0009 to U+000D
SPACES = " \t\n\x0b\x0c\r"


class Scratch:
    """Tables of one operator call, written once in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage and survives lost executors. ``drop`` removes tables that
    nothing reads any more; tables that a returned DataFrame still reads are left there.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
        self.written = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{self.written}"
        self.written += 1
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: rows of a batch that a Python worker gets, and the number of them for rows with whole texts or sets in them
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FEW_ROWS = 1_000


def in_small_batches(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose jobs, all run in the call, hand ``FEW_ROWS`` rows at most to a worker at once: executor and worker each hold a batch or two."""

    @wraps(run)
    def inside(docs: DataFrame, *args, **options) -> DataFrame:
        conf = docs.sparkSession.conf
        before = conf.get(BATCH_ROWS)
        conf.set(BATCH_ROWS, str(min(FEW_ROWS, int(before) if int(before) > 0 else FEW_ROWS)))
        try:
            return run(docs, *args, **options)
        finally:
            conf.set(BATCH_ROWS, before)

    return inside


def row_identity(*values: Column) -> list[Column]:
    """Two 64-bit hashes that name a row by the values it holds.

    Rows with equal values share them, which is right wherever a decision depends on those values alone.
    """
    return [F.xxhash64(F.lit(seed), *values) for seed in (101, 202)]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with the given output names."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as binary, without a copy."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary())


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null rows are empty."""
    column = as_bytes(column).fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def list_array(values: pa.Array | np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def next_power_of_two(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()
