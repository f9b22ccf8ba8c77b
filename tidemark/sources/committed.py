"""Tables whose parts are replaced by one switch of a manifest.

A write goes to a folder of its own; the manifest then names it as the current place of the parts (say, months) that it holds. Readers follow
the newest whole manifest, so a write that fails, or is killed, changes nothing. The manifest also keeps the
columns of every part: a reader needs no footers to know the schema of a part or of all of them.

Under the table's path: ``data/v=<version>/<part>/*.parquet`` and ``_manifest/<number>.json``. A part is named as Spark names its folder, like
``snapshot_date=2024-01-01`` or ``month=2024_01/run=a``.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

VERSION = "v"
MANIFESTS = "_manifest"
#: codec of the stored files
CODEC = "zstd"
#: how often a change is put on top of what other writers have made, and how long an unfinished manifest is waited for
ATTEMPTS = 20
WAIT_SECONDS = 5
_SWITCHING = threading.Lock()
WIDER = {ShortType(): 0, IntegerType(): 1, LongType(): 2, FloatType(): 3, DoubleType(): 4}


@dataclass(frozen=True)
class Part:
    """Where a part lies, what its columns are, and how often it was merged from smaller ones."""

    version: str
    schema: StructType
    level: int = 0


@dataclass(frozen=True)
class Manifest:
    """State of a table: its partition columns and its parts by name."""

    number: int = 0
    by: StructType = field(default_factory=StructType)
    parts: Mapping[str, Part] = field(default_factory=dict)

    def schema(self, names: Iterable[str] | None = None) -> StructType:
        """The united columns of the named parts, or of all."""
        return united(self.parts[n].schema for n in sorted(self.parts if names is None else names))

    def to_json(self) -> str:
        kinds = sorted({p.schema.json() for p in self.parts.values()})
        parts = {name: [p.version, kinds.index(p.schema.json()), p.level] for name, p in sorted(self.parts.items())}
        return json.dumps({"by": self.by.jsonValue(), "schemas": [json.loads(k) for k in kinds], "parts": parts, "whole": True})

    @staticmethod
    def from_json(number: int, text: str) -> Manifest:
        told = json.loads(text)
        kinds = [StructType.fromJson(k) for k in told["schemas"]]
        parts = {name: Part(version, kinds[kind], level) for name, (version, kind, level) in told["parts"].items()}
        return Manifest(number, StructType.fromJson(told["by"]), parts)


def united(schemas: Iterable[StructType]) -> StructType:
    """All columns by name, in the order they first appear; numbers of different width take the wider type."""
    kinds: dict[str, DataType] = {}
    for f in (f for schema in schemas for f in schema.fields):
        known = kinds.get(f.name, f.dataType)
        if known != f.dataType:
            if known not in WIDER or f.dataType not in WIDER:
                raise ValueError(f"column {f.name} is {known.simpleString()} in one part and {f.dataType.simpleString()} in another")
            known = max(known, f.dataType, key=WIDER.__getitem__)
        kinds[f.name] = known
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = [n.removesuffix(".json") for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]
    return sorted((int(n) for n in found if n.isdigit()), reverse=True)


def _read(spark: SparkSession, path: str, number: int) -> Manifest | None:
    """The manifest of a number, or None if it is not whole."""
    fs, at = _fs(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Manifest.from_json(number, text) if json.loads(text).get("whole") else None
    except json.JSONDecodeError:
        return None


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest whole manifest, or None for a path that has none. One that is not whole (yet) is passed over."""
    return next((m for m in (_read(spark, path, n) for n in _numbers(spark, path)) if m), None)


def switch(spark: SparkSession, path: str, change: Callable[[Manifest], Manifest]) -> Manifest:
    """Put ``change`` on top of the current state.

    Threads of one driver take turns. Between drivers the file of a number is made by one writer alone, where the file system creates files exclusively;
    the others apply their change to its state. A writer that leaves its file unfinished is waited for, then passed over.
    """
    with _SWITCHING:
        for _ in range(ATTEMPTS):
            newest = max([0, *_numbers(spark, path)])
            until = time.monotonic() + WAIT_SECONDS
            while newest and _read(spark, path, newest) is None and time.monotonic() < until:
                time.sleep(0.2)
            now = change(read_manifest(spark, path) or Manifest())
            content = bytearray(now.to_json().encode())
            fs, at = _fs(spark, f"{path}/{MANIFESTS}/{newest + 1:012d}.json")
            try:
                stream = fs.create(at, False)
            except Py4JJavaError as error:
                if "exist" in str(error.java_exception).lower():
                    continue
                raise
            try:
                stream.write(content)
            finally:
                stream.close()
            return Manifest(newest + 1, now.by, now.parts)
    raise RuntimeError(f"other writers kept changing {path}")


def _found_parts(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Names of the part folders that a write has made."""
    names = [""]
    for _ in range(depth):
        names = [f"{n}/{m}".lstrip("/") for n in names for m in _names(spark, f"{root}/{n}".rstrip("/")) if "=" in m]
    return names


def write_parts(
    df: DataFrame, path: str, by: list[str], drop: Callable[[str], bool] | None = None, level: int = 0, gathered: bool = False
) -> Manifest:
    """Store ``df`` by the columns ``by`` and replace exactly the parts it has rows for, and those whose names ``drop`` accepts.

    A part is gathered into few files; ``gathered`` says that the rows come from such files already and need no shuffle. Nothing is visible
    before the whole write has succeeded.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    root = f"{path}/data/{VERSION}={version}"
    placed = df if gathered else df.hint("rebalance", *by)
    placed.write.partitionBy(*by).option("compression", CODEC).parquet(root)
    columns = StructType([StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in by])
    keys = StructType([StructField(c, df.schema[c].dataType) for c in by])
    new = {name: Part(version, columns, level) for name in _found_parts(spark, root, len(by))}

    def change(now: Manifest) -> Manifest:
        if now.parts and [f.name for f in now.by.fields] != by:
            raise ValueError(f"{path} is stored by {[f.name for f in now.by.fields]}, not by {by}")
        kept = {n: p for n, p in now.parts.items() if not (drop and drop(n))}
        return Manifest(now.number, keys, {**kept, **new})

    return switch(spark, path, change)


def drop_parts(spark: SparkSession, path: str, drop: Callable[[str], bool]) -> None:
    """Take parts out of the table; their files stay until ``remove_unused``."""
    if read_manifest(spark, path):
        switch(spark, path, lambda now: Manifest(now.number, now.by, {n: p for n, p in now.parts.items() if not drop(n)}))


def read_parts(spark: SparkSession, path: str, wanted: Callable[[str], bool] | None = None, manifest: Manifest | None = None) -> DataFrame | None:
    """The parts whose names ``wanted`` accepts (all by default), with their united columns; None for a path without a manifest.

    Only the folders of these parts are listed and opened. A column that a part does not have is NULL there.
    """
    manifest = manifest or read_manifest(spark, path)
    if manifest is None:
        return None
    names = [n for n in sorted(manifest.parts) if wanted is None or wanted(n)]
    # without any part the columns of the whole table still hold
    schema = manifest.schema(names or None)
    columns = StructType([*schema.fields, *manifest.by.fields])
    if not names:
        return spark.createDataFrame([], columns)
    folders = [f"{path}/data/{VERSION}={manifest.parts[n].version}/{n}" for n in names]
    read = spark.read.schema(StructType([*columns.fields, StructField(VERSION, StringType())])).option("basePath", f"{path}/data").parquet(*folders)
    return read.select(*columns.names)


def part_columns(spark: SparkSession, path: str) -> DataFrame:
    """(part, column_name, type, position): the catalogue of a table, from its manifest alone."""
    manifest = read_manifest(spark, path) or Manifest()
    rows = [
        (name, f.name, f.dataType.simpleString(), i) for name, p in sorted(manifest.parts.items()) for i, f in enumerate(p.schema.fields)
    ]
    return spark.createDataFrame(rows, "part string, column_name string, type string, position int")


def part_value(name: str, column: str) -> str | None:
    """The value of a partition column in a part's name; None for a null."""
    for piece in name.split("/"):
        key, _, value = piece.partition("=")
        if key == column:
            return None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)
    raise KeyError(column)


def remove_unused(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete folders that none of the newest ``keep`` manifests names, and the manifests before them. For when no reader or writer is at work."""
    numbers = _numbers(spark, path)
    states = [m for m in (_read(spark, path, n) for n in numbers[:keep]) if m]
    used = {p.version for m in states for p in m.parts.values()}
    gone = [n for n in _names(spark, f"{path}/data") if n.removeprefix(f"{VERSION}=") not in used]
    for where in [*[f"{path}/data/{n}" for n in gone], *[f"{path}/{MANIFESTS}/{n:012d}.json" for n in numbers[keep:]]]:
        fs, at = _fs(spark, where)
        fs.delete(at, True)
    return len(gone)
