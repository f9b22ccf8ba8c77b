"""File arrival to bronze and silver months with Structured Streaming.

Each file is taken once (checkpoint). A micro-batch is stored under the months it touches and
its own batch number, so a replay overwrites itself and nothing is appended twice. A recipe whose rows depend on one
raw row each makes silver of the arrived rows alone; for any other, the months that a batch touches are rebuilt from
all their bronze rows. Late rows are merged in either way. Small parts of a month are merged step by step, so that a
month that has seen many batches is read and written like one that has seen few.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.session import staged
from tidemark.sources import committed, snapshots
from tidemark.sources.snapshots import BATCH

#: parts of a month on one level before they are merged
FAN = 8


def arriving(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def _is_batch(number: int) -> Callable[[str], bool]:
    return lambda part: committed.part_value(part, BATCH) == str(number)


def _store_batch(batch: DataFrame, number: int, bronze: str, rejects: str) -> DataFrame:
    """Store the rows by month and batch, those without a readable date apart; returns the former as they are stored.

    Both folders carry the batch number, so a replay replaces its own files.
    """
    rows = staged(batch.withColumn("_day", F.col("snapshot_date").try_cast("date")), "batch")
    good = rows.where("_day is not null").withColumn("snapshot_date", F.col("_day")).drop("_day")
    committed.write_parts(good.withColumn(BATCH, F.lit(number)), bronze, [snapshots.SNAPSHOT, BATCH], drop=_is_batch(number))
    bad = rows.where("_day is null").drop("_day")
    if not bad.isEmpty():
        committed.write_parts(bad.withColumn(BATCH, F.lit(number)), rejects, [BATCH], drop=_is_batch(number))
    return committed.read_parts(batch.sparkSession, bronze, _is_batch(number)).drop(BATCH)


def _months_of(spark: SparkSession, path: str, number: int) -> list[str]:
    """The months that a batch touches, as its parts name them."""
    manifest = committed.read_manifest(spark, path)
    return sorted({committed.part_value(n, snapshots.SNAPSHOT) for n in manifest.parts if _is_batch(number)(n)})


def compact(spark: SparkSession, path: str, months: Collection[str], before: int, fan: int = FAN) -> int:
    """Merge the parts of each month that come from batches ``before`` a number, ``fan`` parts of one level to a part of the next.

    A row is written again once per level, so the work per batch grows with the logarithm of their number. Batches from ``before`` on may
    still be replayed and are left alone. The result is the number of parts merged.
    """
    manifest, merged = committed.read_manifest(spark, path), 0
    groups: dict[tuple[int, str], list[str]] = {}
    for name, part in manifest.parts.items():
        month, batch = committed.part_value(name, snapshots.SNAPSHOT), int(committed.part_value(name, BATCH))
        if month in months and batch < before:
            groups.setdefault((part.level, month), []).append(name)
    full = {key: names for key, names in groups.items() if len(names) >= fan}
    for level in sorted({level for level, _ in full}):
        names = {n for (at, _), found in full.items() if at == level for n in found}
        last = {m: max(int(committed.part_value(n, BATCH)) for n in found) for (at, m), found in full.items() if at == level}
        number = F.try_element_at(F.create_map(*[F.lit(x) for pair in last.items() for x in pair]), F.col(snapshots.SNAPSHOT).cast("string"))
        rows = committed.read_parts(spark, path, names.__contains__, manifest)
        committed.write_parts(rows.withColumn(BATCH, number), path, [snapshots.SNAPSHOT, BATCH], drop=names.__contains__, level=level + 1)
        merged += len(names)
    return merged


def _rebuild(spark: SparkSession, months: list[str], bronze: str, silver: str, recipe: Callable[[DataFrame], DataFrame]) -> None:
    """Silver of the given months from all their bronze rows, in one switch; a month that the recipe empties leaves it."""
    rows = snapshots.read_months(spark, bronze, months)
    committed.write_parts(recipe(rows), silver, [snapshots.SNAPSHOT], drop=lambda part: committed.part_value(part, snapshots.SNAPSHOT) in months)


def ingest_available(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    bronze: str,
    silver: str,
    checkpoint: str,
    recipe: Callable[[DataFrame], DataFrame],
    fmt: str = "csv",
    files_per_batch: int | None = None,
    rejects: str | None = None,
    row_local: bool = False,
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop.

    ``row_local`` says that the recipe makes every row from one raw row; then only arrived rows go through it. Rows whose ``snapshot_date`` cannot be read are kept as they came in ``rejects`` (``<bronze>_rejects`` by default).
    """
    apart = rejects or f"{bronze}_rejects"

    def on_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = _store_batch(batch, number, bronze, apart)
        months = _months_of(spark, bronze, number)
        if row_local:
            made = recipe(rows).withColumn(BATCH, F.lit(number))
            # the stored months lie in few files each, and so do the rows made of them
            committed.write_parts(made, silver, [snapshots.SNAPSHOT, BATCH], drop=_is_batch(number), gathered=True)
            compact(spark, silver, months, number)
        elif months:
            _rebuild(spark, months, bronze, silver, recipe)
        compact(spark, bronze, months, number)

    return (
        arriving(spark, source, schema, fmt, files_per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
