"""Committed tables: one switch per write, one folder per read, merged batches."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources import committed, snapshots
from tidemark.streaming import ingest


def months(spark, *pairs, **more):
    df = spark.createDataFrame([(k, date.fromisoformat(d)) for k, d in pairs], "k string, snapshot_date date")
    return df.withColumns({c: F.lit(v) for c, v in more.items()})


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_day_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshots(months(spark, *[(str(i), f"2024-{i:02d}-01") for i in range(1, 13)]), path)
    snapshots.write_snapshot(months(spark, ("again", "2024-05-01"), y=1), path, "2024-05-01")
    month, n = jobs(spark, "one-day", lambda: snapshots.read_months(spark, path, ["2024_05_01", "2030_01_01"]))
    assert n == 0  # no footer was read to plan it
    assert rows(month, "k", "snapshot_date", "y") == [("again", date(2024, 5, 1), 1)]
    assert {Path(f).parent.name for f in month.inputFiles()} == {"snapshot_date=2024-05-01"}
    assert "paths)[file" in month._jdf.queryExecution().executedPlan().toString() or len(month.inputFiles()) == 1
    whole, n = jobs(spark, "whole", lambda: snapshots.read_table(spark, path))
    assert n == 0 and whole.columns == ["k", "y", "snapshot_date"] and whole.count() == 12
    assert snapshots.read_months(spark, path, ["2030_01_01"]).count() == 0
    told = rows(snapshots.declared_columns(spark, path).where("column_name = 'y'"), "period", "type")
    assert told == [("2024-05-01", "int")]


def test_failed_write_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(committed, "WAIT_SECONDS", 0.5)
    path = str(tmp_path / "t")
    snapshots.write_snapshots(months(spark, ("a", "2024-01-01"), ("b", "2024-02-01")), path)
    broken = months(spark, ("c", "2024-01-01"), ("d", "2024-02-01")).withColumn("k", F.when(F.col("k") == "d", F.raise_error(F.lit("x"))).otherwise(F.col("k")))
    for write in (lambda: snapshots.write_snapshots(broken.repartition(2), path), lambda: snapshots.write_snapshot(broken, path, "2024-02-01")):
        with pytest.raises(PySparkException):
            write()
        assert rows(snapshots.read_table(spark, path), "k") == [("a",), ("b",)]
    # a manifest that a killed writer left unfinished is passed over, and its number is not used again
    number = committed.read_manifest(spark, path).number
    (Path(path) / committed.MANIFESTS / f"{number + 1:012d}.json").write_text('{"by": ')
    assert rows(snapshots.read_table(spark, path), "k") == [("a",), ("b",)]
    snapshots.write_snapshot(months(spark, ("e", "2024-02-01")), path, "2024-02-01")
    assert committed.read_manifest(spark, path).number == number + 2 and rows(snapshots.read_table(spark, path), "k") == [("a",), ("e",)]


def test_writers_side_by_side(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [f"2024-{i:02d}-01" for i in range(1, 9)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda d: snapshots.write_snapshot(months(spark, (d, d)), path, d), days))
    assert rows(snapshots.read_table(spark, path), "k") == [(d,) for d in days]
    held = snapshots.read_table(spark, path)
    snapshots.write_snapshot(months(spark, ("new", days[0])), path, days[0])
    assert rows(held, "k") == [(d,) for d in days]  # a reader keeps the state that it began with
    assert committed.remove_unused(spark, path) == 1 and snapshots.read_table(spark, path).where("k = 'new'").count() == 1


def test_columns_of_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    narrow = months(spark, ("a", "2024-01-01"), x=1).withColumn("x", F.lit(1).cast("int"))
    snapshots.write_snapshots(narrow, path)
    snapshots.write_snapshots(months(spark, ("b", "2024-02-01")).withColumn("x", F.lit(2**40)), path)
    assert rows(snapshots.read_table(spark, path), "k", "x") == [("a", 1), ("b", 2**40)]
    snapshots.write_snapshots(months(spark, ("c", "2024-03-01"), x="text"), path)
    with pytest.raises(ValueError, match="column x"):
        snapshots.read_table(spark, path)
    with pytest.raises(ValueError, match="stored by"):
        committed.write_parts(narrow, path, ["k"])
    assert committed.read_parts(spark, str(tmp_path / "none")) is None


def test_odd_part_names(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None, "a/b c:d=e"), (2, "ü%", "")], "id int, m string, r string")
    committed.write_parts(df, path, ["m", "r"])
    committed.write_parts(df.where("id = 1").withColumn("id", F.lit(3)), path, ["m", "r"])
    assert rows(committed.read_parts(spark, path), "id", "m", "r") == [(2, "ü%", None), (3, None, "a/b c:d=e")]
    names = {(committed.part_value(n, "m"), committed.part_value(n, "r")) for n in committed.read_manifest(spark, path).parts}
    assert names == {(None, "a/b c:d=e"), ("ü%", None)}
    committed.drop_parts(spark, path, lambda n: committed.part_value(n, "m") is None)
    assert rows(committed.read_parts(spark, path), "id") == [(2,)]
    committed.write_parts(df.limit(0), path, ["m", "r"], drop=lambda n: True)
    assert committed.read_parts(spark, path).count() == 0


def test_batches_are_merged(spark, tmp_path):
    """The work of a batch does not grow with the batches before it."""
    path, biggest = str(tmp_path / "t"), 0
    for number in range(40):
        df = months(spark, (f"a{number}", "2024-01-01"), (f"b{number}", "2024-02-01"))
        committed.write_parts(df.withColumn(ingest.BATCH, F.lit(number)), path, ["snapshot_date", ingest.BATCH])
        ingest.compact(spark, path, ["2024-01-01", "2024-02-01"], number, fan=4)
        parts = committed.read_manifest(spark, path).parts
        assert f"snapshot_date=2024-01-01/ingest_batch={number}" in parts  # the batch at hand may be replayed
        biggest = max(biggest, len(parts))
    assert biggest <= 2 * (3 * 3 + 3)
    assert rows(snapshots.read_table(spark, path), "k") == sorted((f"{c}{i}",) for c in "ab" for i in range(40))
    levels = [p.level for p in committed.read_manifest(spark, path).parts.values()]
    assert max(levels) == 2


@pytest.mark.parametrize("row_local", [True, False])
def test_arrival_in_many_batches(spark, tmp_path, monkeypatch, row_local):
    monkeypatch.setattr(ingest, "compact", lambda *a, f=ingest.compact: f(*a, fan=2))
    source, root = str(tmp_path / "in"), str(tmp_path)
    for i in range(5):
        snapshots.write_csv(months(spark, (f"k{i}", "2024-01-01"), (f"m{i}", f"2024-0{i + 1}-01"), ("drop", "2024-06-01")), source, mode="append")
        ingest.ingest_available(
            spark, source, "k string, snapshot_date string", f"{root}/b", f"{root}/s", f"{root}/c", lambda df: df.where("k <> 'drop'"), row_local=row_local
        ).awaitTermination()
    want = sorted([*[(f"k{i}", date(2024, 1, 1)) for i in range(5)], *[(f"m{i}", date(2024, i + 1, 1)) for i in range(5)]])
    assert rows(snapshots.read_table(spark, f"{root}/s"), "k", "snapshot_date") == want
    assert snapshots.read_table(spark, f"{root}/b").count() == 15
    parts = [n for n in committed.read_manifest(spark, f"{root}/b").parts if "2024-01-01" in n]
    assert len(parts) <= 4


def test_gathered_rows_are_stored_without_a_shuffle(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-02-01", 2), ("2024-01-01", 3)], "snapshot_date string, x int")
    committed.write_parts(df, f"{tmp_path}/t", ["snapshot_date"], gathered=True)
    assert rows(committed.read_parts(spark, f"{tmp_path}/t"), "snapshot_date", "x") == [("2024-01-01", 1), ("2024-01-01", 3), ("2024-02-01", 2)]
