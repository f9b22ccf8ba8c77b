"""Line deduplication with once-seen and twice-seen Bloom filters.

A first pass reduces each partition to the Bloom bits of the line hashes that it has seen
once and twice. The bits of all partitions meet by segment: a bit that two partitions hold
once counts as twice. A second pass probes the twice-seen filter: lines that surely occur in
one document only stay where they are, and only suspected repeats shuffle, with their whole
key, for the exact count and the choice of the first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import Scratch, as_bytes, next_power_of_two, row_identity, without

#: 64-bit words in a segment of a filter, bits set per key, and bits of filter per line
SEGMENT_WORDS = 1 << 14
PROBES = 4
BITS_PER_LINE = 16

_PARTIAL = StructType([
    StructField("segment", LongType()), StructField("words", BinaryType()), StructField("once", BinaryType()),
    StructField("twice", BinaryType()),
])


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z lower-cased (``bytes`` methods know ASCII only)."""
    return line.strip().lower()


def _key_hashes(text: bytes | None) -> set[int]:
    hashed = {xxhash.xxh64_intdigest(k) for k in set(map(line_key, (text or b"").split(b"\n"))) if k}
    return hashed


def _place(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word and bit mask of each hash: all bits of a key lie in one 64-bit word."""
    with np.errstate(over="ignore"):
        mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    slot = (mixed >> np.uint64(24)) & np.uint64(slots - 1)
    mask = np.zeros(len(hashes), np.uint64)
    for probe in range(PROBES):
        mask |= np.uint64(1) << ((hashes >> np.uint64(6 * probe)) & np.uint64(63))
    return slot.astype(np.int64), mask


def _fold(slot: np.ndarray, once: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per slot; a bit that two entries hold once is seen twice."""
    order = np.argsort(slot, kind="stable")
    slot, once, twice = slot[order], once[order], twice[order]
    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(slot)])
    o, t = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for rank in range(int(sizes.max(initial=0))):
        group = np.flatnonzero(sizes > rank)
        at = starts[group] + rank
        t[group] |= twice[at] | (o[group] & once[at])
        o[group] |= once[at]
    return slot[starts], o, t


def _partials(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        for batch in batches:
            for text in as_bytes(batch.column(0)).to_pylist():
                seen.append(np.fromiter(_key_hashes(text), np.uint64))
        if not seen:
            return
        hashes, counts = np.unique(np.concatenate(seen), return_counts=True)
        slot, mask = _place(hashes, slots)
        slot, once, twice = _fold(slot, mask, np.where(counts > 1, mask, np.uint64(0)))
        segment = slot // SEGMENT_WORDS
        cuts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True]) if len(slot) else np.zeros(0, np.int64)
        words = (slot % SEGMENT_WORDS).astype(np.uint16)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([int(segment[a])], pa.int64()), "words": pa.array([words[a:b].tobytes()]),
                "once": pa.array([once[a:b].tobytes()]), "twice": pa.array([twice[a:b].tobytes()]),
            })

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments arrive sorted, so that one of them is in memory at a time."""
    now, once, twice = None, None, None

    def flush() -> pa.RecordBatch:
        bits = pa.array([twice.view(np.int64)], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), bits], names=["segment", "twice"])

    for batch in batches:
        for segment, words, o, t in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != now:
                if now is not None:
                    yield flush()
                now, once, twice = segment, np.zeros(SEGMENT_WORDS, np.uint64), np.zeros(SEGMENT_WORDS, np.uint64)
            at, o, t = np.frombuffer(words, np.uint16), np.frombuffer(o, np.uint64), np.frombuffer(t, np.uint64)
            twice[at] |= t | (once[at] & o)
            once[at] |= o
    if now is not None:
        yield flush()


def twice_seen_filter(texts: DataFrame, slots: int) -> DataFrame:
    """(segment, twice): the bits of lines that at least two documents may hold.

    ``texts`` has one text column. The once-seen filter exists only while partitions are merged.
    """
    partial = texts.mapInArrow(_partials(slots), _PARTIAL)
    dealt = partial.repartition("segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(_merge, "segment long, twice array<long>")


def _keys_of(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, hashes = [], [], []
            for i, text in enumerate(as_bytes(batch.column("_ld_text")).to_pylist()):
                own = {k for k in map(line_key, (text or b"").split(b"\n")) if k}
                rows += [i] * len(own)
                keys += own
                hashes += map(xxhash.xxh64_intdigest, own)
            hashed = np.array(hashes, np.uint64)
            slot, mask = _place(hashed, slots)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(taken) for c in ("_ld_id", "_ld_r1", "_ld_r2")),
                    pa.array(keys, pa.binary()).cast(pa.string()), pa.array(hashed.view(np.int64)),
                    pa.array(slot // SEGMENT_WORDS), pa.array((slot % SEGMENT_WORDS).astype(np.int32)), pa.array(mask.view(np.int64)),
                ],
                names=["_ld_id", "_ld_r1", "_ld_r2", "key", "hash", "segment", "word", "mask"],
            )

    return run


def _clean(text: str | None, gone: list[int] | None, first: list[int] | None) -> tuple[str, int, int]:
    lines = (text or "").split("\n")
    if not gone and not first:
        return text or "", len(lines), 0
    drop, once, kept = set(gone or ()), set(first or ()), []
    for line in lines:
        key = line_key(line.encode())
        hashed = xxhash.xxh64_intdigest(key) if key else None
        signed = hashed - (1 << 64) if hashed is not None and hashed >= 1 << 63 else hashed
        if hashed is None or signed not in drop:
            kept.append(line)
            if signed in once:  # a later line of the document with this key is a repeat
                drop.add(signed)
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _apply(schema: StructType):
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                _clean(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("_ld_text", "_ld_gone", "_ld_first")))
            ]
            made = dict(zip(("_ld_text", "_ld_lines", "_ld_dropped"), zip(*done))) if done else {}
            kinds = {"_ld_text": pa.string(), "_ld_lines": pa.int64(), "_ld_dropped": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(made.get(n, ()), kinds[n]) if n in kinds else batch.column(n) for n in names], names=names
            )

    return run


def dedup_lines(
    docs: DataFrame, min_docs: int = 2, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text",
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space at its ends, A-Z lower-cased. A key found in at
    least ``min_docs`` rows is repeated. ``keep_first`` keeps one line for it: the first one in the row with the
    smallest id (ties by the hash of the row); otherwise all its lines go.

    Empty keys are never repeated. A null or empty text is one empty line and comes out as ''.
    Rows equal in id and text are counted one by one but treated alike (each keeps the first occurrence). A null id comes first.
    Input columns named ``n_lines`` or ``n_dropped`` are replaced; other columns are passed through.
    An empty table gives an empty result. Runs jobs when called: the filter and the suspected lines are written tables.

    The filter grows with the number of lines. It is broadcast up to ``broadcast_bytes``; a larger
    one is joined by segment. Either way the result is exact.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    docs = without(docs, "n_lines", "n_dropped")
    texts = docs.select(F.col(text_col).cast("string").alias("_ld_text"))
    breaks = F.length("_ld_text") - F.length(F.replace("_ld_text", F.lit("\n"))) + 1
    lines = texts.agg(F.sum(breaks)).first()[0] or 0
    slots = max(SEGMENT_WORDS, next_power_of_two(lines * BITS_PER_LINE // 64))
    seen = scratch.write(twice_seen_filter(texts, slots), "filter")
    seen = F.broadcast(seen) if slots * 8 <= broadcast_bytes else seen

    r1, r2 = row_identity(F.col(id_col), F.col(text_col))
    named = docs.select(
        F.col(id_col).alias("_ld_id"), r1.alias("_ld_r1"), r2.alias("_ld_r2"), F.col(text_col).cast("string").alias("_ld_text")
    )
    id_type = named.schema["_ld_id"].dataType
    each = StructType([
        StructField("_ld_id", id_type), StructField("_ld_r1", LongType()), StructField("_ld_r2", LongType()),
        StructField("key", StringType()), StructField("hash", LongType()), StructField("segment", LongType()),
        StructField("word", IntegerType()), StructField("mask", LongType()),
    ])
    probed = named.mapInArrow(_keys_of(slots), each).join(seen, "segment")
    suspected = probed.where(F.col("twice")[F.col("word")].bitwiseAND(F.col("mask")) == F.col("mask"))
    suspects = scratch.write(suspected.select("_ld_id", "_ld_r1", "_ld_r2", "key", "hash"), "suspects")

    row = F.struct("_ld_id", "_ld_r1", "_ld_r2")
    repeated = suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("first")).where(F.col("n") >= min_docs)
    # written first, so that the join can split a line that very many rows hold
    repeated = scratch.write(repeated.select("key", "first"), "repeated")
    is_first = F.lit(keep_first) & row.eqNullSafe(F.col("first"))
    verdicts = suspects.join(repeated, "key").groupBy("_ld_r1", "_ld_r2").agg(
        F.collect_set(F.when(~is_first, F.col("hash"))).alias("_ld_gone"),
        F.collect_set(F.when(is_first, F.col("hash"))).alias("_ld_first"),
    )
    verdicts = scratch.write(verdicts, "verdicts")
    scratch.drop(suspects, repeated)

    marked = docs.withColumns({"_ld_r1": r1, "_ld_r2": r2}).join(verdicts, ["_ld_r1", "_ld_r2"], "left")
    marked = marked.withColumn("_ld_text", F.col(text_col).cast("string"))
    others = [c for c in docs.columns if c != text_col]
    fields = [docs.schema[c] for c in others]
    out = StructType([
        *fields, StructField("_ld_text", StringType()), StructField("_ld_lines", LongType()), StructField("_ld_dropped", LongType()),
    ])
    done = marked.select(*others, "_ld_text", "_ld_gone", "_ld_first").mapInArrow(_apply(out), out)
    return done.select(
        *[F.col("_ld_text").alias(text_col) if c == text_col else F.col(c) for c in docs.columns],
        F.col("_ld_lines").alias("n_lines"), F.col("_ld_dropped").alias("n_dropped"),
    )
