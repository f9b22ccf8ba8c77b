"""Similarity join on word shingles by prefix filtering, down to the connected components.

Each text becomes its set of distinct n-word shingles, in one order for all: rare first, by a
count sketch over all texts. Two sets that reach the threshold share a shingle of their
prefixes, so only prefixes are joined, under length, positional and suffix filters, and each
pair that is left is verified once on the whole sets.

Equal sets are one class from the start. A prefix shingle links its classes to one of them
first, to the one with the most common shingles, as edited copies link to their original rather than to each other; pairs inside a
component that these links prove need no check of their own. Then the pairs between
different components that still share a prefix shingle are checked, all of them, so that no
link between components is lost and no group is ever expanded into all of its pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import Scratch, list_array
from tidemark.llm.components import components
from tidemark.llm.text_hashes import mix, shingle_rows

#: counters of the frequency sketch and its pieces; parts of the suffix filter; bits of a membership bitmap
SLOTS = 1 << 20
PIECES = 32
PARTS = 64
BITMAP_BITS = 1 << 25


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)) & np.uint64(SLOTS - 1)


def _distinct(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    for row in shingle_rows(column, n):
        yield np.unique(row)


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            sets = [*_distinct(batch.column(0), n)]
            if sets:
                counts += np.bincount(_slot(np.concatenate(sets)).astype(np.int64), minlength=SLOTS)
        if counts.any():
            for i, piece in enumerate(np.split(counts, PIECES)):
                packed = zlib.compress(piece.astype(np.uint32).tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"piece": pa.array([i], pa.int32()), "counts": pa.array([packed])})

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64)
            sums[i] = sums[i] + part if i in sums else part
    for i, total in sums.items():
        # an eighth of an octave is fine enough for an order
        level = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"piece": pa.array([i], pa.int32()), "counts": pa.array([level.tobytes()])})


def frequency_levels(texts: DataFrame, n: int) -> np.ndarray:
    """Frequency level of every sketch slot, counted over all texts; one byte per slot whatever the input."""
    kind = "piece int, counts binary"
    rows = texts.mapInArrow(_count(n), kind).repartition("piece").mapInArrow(_add_up, kind).collect()
    levels = np.zeros(SLOTS, np.uint8)
    for piece, packed in rows:
        size = SLOTS // PIECES
        levels[piece * size : (piece + 1) * size] = np.frombuffer(packed, np.uint8)
    return levels


def _signature(distinct: np.ndarray) -> np.uint64:
    """Hash of a set, the same in any order."""
    with np.errstate(over="ignore"):
        return mix(np.array([distinct.sum(dtype=np.uint64) + np.uint64(len(distinct)) * np.uint64(0x9E37)], np.uint64))[0]


def _prefixes(n: int, similarity: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            sizes, signatures, prefixes, parts, ranks = [], [], [], [], []
            for distinct in _distinct(batch.column("_nj_text"), n):
                size = len(distinct)
                sizes.append(size)
                signatures.append(_signature(distinct) if size else np.uint64(0))
                # sets of the threshold share at least one of the first size - ceil(t * size) + 1
                wanted = size - -(-similarity * size // 100) + 1 if size else 0
                keys = level[_slot(distinct)]
                # how common its shingles are, then its signature: an order of classes by how central they are
                ranks.append(int(64 * keys.mean()) << 48 | int(signatures[-1]) >> 16 if size else 0)
                order = np.lexsort((distinct, keys))[:wanted]
                prefixes.append(distinct[order])
                parts.append(np.bincount((distinct // np.uint64((1 << 64) // PARTS)).astype(np.int64), minlength=PARTS))
            ends = np.r_[0, np.cumsum([len(p) for p in prefixes])].astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_nj_id"), batch.column("_nj_row"), pa.array(sizes, pa.int32()),
                    pa.array(np.array(signatures, np.uint64).view(np.int64)), pa.array(ranks, pa.int64()), list_array(flat.view(np.int64), ends),
                    list_array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32), np.arange(len(parts) + 1, dtype=np.int32) * PARTS),
                ],
                names=["_nj_id", "row", "n", "sig", "rank", "prefix", "parts"],
            )

    return run


def bitmap(values: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits of the 64-bit values of a one-column table: a pre-filter of fixed size, false positives only."""
    at = F.pmod(F.col(values.columns[0]), F.lit(bits)) + 1  # buckets hold the values 1 to 32768, 32769 to ...
    rows = values.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, part in rows.collect():  # at most bits / 32768 rows of 4 kB
        out[(bucket - 1) * 4096 : bucket * 4096] |= np.frombuffer(part, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray, size: int = BITMAP_BITS) -> np.ndarray:
    """Which 64-bit values may be in the bitmap."""
    at = np.mod(values.view(np.int64), np.int64(size))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _shared_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            prefix = batch.column("prefix")
            lengths = np.diff(prefix.offsets.to_numpy())
            values = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(lengths)), lengths)
            pos = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            keep = in_bitmap(bits, values)
            taken = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[keep]), batch.column("sig").take(taken), batch.column("n").take(taken),
                    pa.array(pos[keep].astype(np.int32)),
                ],
                names=["shingle", "sig", "n", "pos"],
            )

    return run


def _whole_sets(n: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            rows = batch.column("_nj_row").to_numpy()
            sigs, sets = [], []
            for row, distinct in zip(rows, _distinct(batch.column("_nj_text"), n)):
                if len(distinct):
                    sig = _signature(distinct)
                    if in_bitmap(bits, np.array([row], np.int64) ^ np.array([sig], np.uint64).view(np.int64))[0]:
                        sigs.append(sig)
                        sets.append(distinct)
            ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(sigs, np.uint64).view(np.int64)), list_array(flat.view(np.int64), ends)], names=["sig", "grams"]
            )

    return run


def _needed(similarity: int, size_a: Column, size_b: Column) -> Column:
    """The overlap from which two sets reach the threshold: t / (1 + t) of both sizes, rounded up."""
    return F.ceil(F.lit(similarity) * (size_a + size_b) / F.lit(100 + similarity) - F.lit(1e-9))


def _ordered(met: DataFrame) -> DataFrame:
    """Pairs with the smaller signature as ``a``."""
    sides = [
        F.when(F.col("a") < F.col("b"), F.col(f"{own}_{what}")).otherwise(F.col(f"{other}_{what}")).alias(f"{own}_{what}")
        for own, other in ("ab", "ba") for what in ("n", "pos")
    ]
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *sides)


class _Join:
    def __init__(self, docs: DataFrame, n: int, similarity: int, id_col: str, text_col: str) -> None:
        spark = docs.sparkSession
        self.spark, self.n, self.similarity = spark, n, similarity
        self.scratch = Scratch(spark, "ngrams")
        self.texts = docs.select(
            F.col(id_col).alias("_nj_id"), F.xxhash64(id_col).alias("_nj_row"), F.col(text_col).cast("string").alias("_nj_text")
        )
        levels = spark.sparkContext.broadcast(frequency_levels(self.texts.select("_nj_text"), n))
        schema = StructType([
            StructField("_nj_id", docs.schema[id_col].dataType), StructField("row", LongType()), StructField("n", IntegerType()),
            StructField("sig", LongType()), StructField("rank", LongType()), StructField("prefix", ArrayType(LongType())), StructField("parts", ArrayType(IntegerType())),
        ])
        self.rows = self.scratch.write(self.texts.mapInArrow(_prefixes(n, similarity, levels), schema), "rows")

    def shared_prefixes(self) -> DataFrame:
        """(shingle, sig, n, pos, and the pivot of the shingle) for prefix shingles of two classes or more."""
        exploded = self.rows.select("sig", "n", "rank", F.posexplode("prefix").alias("pos", "shingle"))
        pivots = exploded.groupBy("shingle").agg(
            F.min("sig").alias("_first"), F.max("sig").alias("_last"), F.max_by("sig", "rank").alias("pivot"),
            F.max_by("n", "rank").alias("pivot_n"), F.max_by("pos", "rank").alias("pivot_pos"),
        ).where("_first <> _last").drop("_first", "_last")
        pivots = self.scratch.write(pivots, "pivots")
        shared = self.spark.sparkContext.broadcast(bitmap(pivots.select("shingle")))
        rows = self.rows.select("sig", "n", "prefix").mapInArrow(_shared_rows(shared), "shingle long, sig long, n int, pos int")
        joined = self.scratch.write(rows.join(pivots, "shingle").distinct(), "shared")
        self.scratch.drop(pivots)
        return joined

    def filtered(self, met: DataFrame) -> DataFrame:
        """(a, b) once per pair, after the length, positional and suffix filters.

        ``met`` has a row (a, b, a_n, b_n, a_pos, b_pos) for every prefix shingle in common.
        """
        short, long = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
        pairs = met.where(100 * short >= self.similarity * long).groupBy("a", "b").agg(
            F.min("a_n").alias("a_n"), F.min("b_n").alias("b_n"), F.min("a_pos").alias("a_pos"), F.min("b_pos").alias("b_pos")
        )
        # nothing in common comes before the first shared shingle of either side
        most = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
        pairs = pairs.where(most >= _needed(self.similarity, F.col("a_n"), F.col("b_n")))
        parts = self.rows.groupBy("sig").agg(F.first("parts").alias("parts"))
        for side in ("a", "b"):
            pairs = pairs.join(parts.select(F.col("sig").alias(side), F.col("parts").alias(f"{side}_parts")), side)
        # the sets are cut at the same values, so each part bounds its own share of the overlap
        bound = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
        return pairs.where(bound >= _needed(self.similarity, F.col("a_n"), F.col("b_n"))).select("a", "b", "a_n", "b_n")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose whole sets reach the threshold; sets are made again for the classes in pairs only."""
        pairs = self.scratch.write(pairs, f"{name}-pairs")
        wanted = pairs.select(F.col("a").alias("sig")).unionAll(pairs.select("b")).distinct()
        one = self.rows.where("n > 0").groupBy("sig").agg(F.min("row").alias("row")).join(wanted, "sig")
        bits = self.spark.sparkContext.broadcast(bitmap(one.select(F.col("row").bitwiseXOR(F.col("sig")))))
        sets = self.texts.select("_nj_row", "_nj_text").mapInArrow(_whole_sets(self.n, bits), "sig long, grams array<long>")
        # shuffled once: both joins read the sets by the same key
        sets = sets.groupBy("sig").agg(F.first("grams").alias("grams"))
        both = pairs.join(sets.select(F.col("sig").alias("b"), F.col("grams").alias("b_grams")), "b").join(
            sets.select(F.col("sig").alias("a"), F.col("grams").alias("a_grams")), "a"
        )
        common = F.size(F.array_intersect("a_grams", "b_grams"))
        links = both.where((100 + self.similarity) * common >= self.similarity * (F.col("a_n") + F.col("b_n"))).select("a", "b")
        links = self.scratch.write(links, f"{name}-links")
        self.scratch.drop(pairs)
        return links

    def across(self, shared: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs of different components that share a prefix shingle, but for the pairs with its pivot."""
        labelled = shared.join(found.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
        counts = labelled.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("members"))
        # of a shingle's classes, those of its largest component meet the others but not each other
        mixed = counts.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("_several"), F.max_by("component", F.struct("members", "component")).alias("largest")
        ).where("_several > 1").drop("_several")
        labelled = self.scratch.write(labelled.join(mixed, "shingle"), "mixed")
        x = labelled.where("component <> largest and sig <> pivot").select(
            "shingle", F.col("sig").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"), F.col("component").alias("a_component")
        )
        y = labelled.where("sig <> pivot").select(
            "shingle", "largest", F.col("sig").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"), F.col("component").alias("b_component")
        )
        least = _needed(self.similarity, F.col("a_n"), F.col("b_n"))
        met = x.join(y, "shingle").where(
            (F.col("a_component") != F.col("b_component"))
            & ((F.col("b_component") == F.col("largest")) | (F.col("a") < F.col("b")))
            & (F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos")) >= least)
        )
        return _ordered(met)

    def run(self) -> DataFrame:
        shared = self.shared_prefixes()
        star = _ordered(shared.where("sig <> pivot").select(
            F.col("pivot").alias("a"), F.col("sig").alias("b"), F.col("pivot_n").alias("a_n"), F.col("n").alias("b_n"),
            F.col("pivot_pos").alias("a_pos"), F.col("pos").alias("b_pos"),
        ))
        links = self.verified(self.filtered(star), "star")
        found = self.scratch.write(components(links, self.scratch), "found")
        more = self.verified(self.filtered(self.across(shared, found)), "across")
        self.scratch.drop(shared)
        # components found so far stand for their links
        tree = found.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
        found = self.scratch.write(components(tree.unionAll(more), self.scratch), "found")
        members = self.rows.select("_nj_id", "n", "sig").join(found.withColumnRenamed("node", "sig"), "sig", "left")
        members = members.withColumn("component", F.coalesce("component", "sig"))
        # written first, so that the join can split a component that holds many rows
        least = self.scratch.write(members.where("n > 0").groupBy("component").agg(F.min("_nj_id").alias("least")), "least")
        joined = members.join(least, "component", "left")
        return joined.select(
            "_nj_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("least", "_nj_id")).otherwise(F.col("_nj_id")).alias("component_id"),
        )


def ngram_components(docs: DataFrame, n: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles`` and ``component_id``.

    Words are runs of characters other than U+0020 and U+0009 to U+000D, A-Z lower-cased. A row's set holds its distinct
    ``n``-word shingles; a text of fewer words is one shingle, a null, empty or blank text has none, links with nothing
    and is its own component. Two rows link when 100 * intersection >= ``similarity`` * union (a whole percentage).
    ``component_id`` is the smallest id that links reach, the row's own included; it is null only where all ids of
    a component are null. Repeated rows and repeated ids are rows of their own that link like any others. Other
    columns of ``docs`` take no part. An empty table gives an empty result.

    Words, shingles and sets are compared by 64-bit hashes. Runs jobs when called.
    """
    return _Join(docs, n, similarity, id_col, text_col).run().withColumnRenamed("_nj_id", id_col)


def drop_near_duplicates(docs: DataFrame, n: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``ngram_components``: the one with the smallest id (ties: by a hash of the row).

    Of rows equal in id and text one stays. Rows without words link with nothing and stay, but for such repetitions. Columns are as they were.
    """
    scratch = Scratch(docs.sparkSession, "survivors")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("h"))
    found = ngram_components(docs.select(key.alias("key"), text_col), n, similarity, "key", text_col)
    fates = found.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min(F.col("key").eqNullSafe(F.col("component_id"))).alias("stays"))
    fates = scratch.write(fates.where("rows > 1 or not stays").select(F.col("key").alias("_nj_key"), "rows", "stays"), "fates")
    named = docs.withColumn("_nj_own", key)
    same = F.col("_nj_own").eqNullSafe(F.col("_nj_key"))
    single = named.join(fates, same, "left_anti")
    again = named.join(fates.where("rows > 1 and stays"), same, "left_semi").dropDuplicates(["_nj_own"])
    return single.unionAll(again).select(*docs.columns)
