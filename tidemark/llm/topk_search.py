"""Exact top-k search by distributed histogram selection.

Every query block meets every block of candidate vectors. In each round all scores are computed and
counted into a histogram per query; the bin that holds the k-th best score is cut into finer bins for the
next round, until it is one score wide. The last round keeps what is above that score and the ties at it.
Before shuffling, a block keeps only the bins from its own k-th best score up, as the global one cannot be lower.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import Scratch

#: queries in a block, candidates in a block, bins per round as a power of two, bytes of queries broadcast at a time
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
BIN_BITS = 10
GROUP_BYTES = 64 << 20
_NONE = np.iinfo(np.int64).min


def _usable(vec: Column) -> Column:
    """Vectors without null, NaN or infinite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad


def _whole(vec: Column, scale: int) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, vec, dim) as blocks (dim, ids, matrix), one dimension each."""
    for batch in batches:
        ids, dims = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        flat, offsets = batch.column(1).flatten().to_numpy(), batch.column(1).offsets.to_numpy()
        offsets = offsets - offsets[0]
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            for at in range(0, len(rows), CANDIDATE_BLOCK):
                own = rows[at : at + CANDIDATE_BLOCK]
                matrix = flat[offsets[own][:, None] + np.arange(dim)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(dim)], pa.int32()), pa.array([ids[own].tolist()], pa.list_(pa.int64())), pa.array([matrix.tobytes()])],
                    names=["dim", "ids", "matrix"],
                )


def _scores(row: dict) -> np.ndarray:
    """(queries, candidates) integer inner products; a query's own row is no candidate."""
    dim, ids, own = row["dim"], np.array(row["ids"], np.int64), np.array(row["queries"], np.int64)
    c = np.frombuffer(row["matrix"], np.int64).reshape(len(ids), dim)
    q = np.array(row["vectors"], np.int64).reshape(len(own), dim)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, dim)
    # doubles hold every partial sum exactly up to 2 ** 53
    s = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < 2**53 else q @ c.T
    at = np.searchsorted(own, ids)
    same = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == ids)
    s[at[same], same] = _NONE
    return s


def _best(s: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Which scores reach the k-th best of their row."""
    most = min(int(k.max(initial=0)), s.shape[1])
    if most <= 0:
        return np.zeros(s.shape, bool)
    top = np.sort(np.partition(s, s.shape[1] - most, axis=1)[:, s.shape[1] - most :], axis=1)[:, ::-1]
    least = top[np.arange(len(s)), np.minimum(k, most) - 1]
    return (s >= least[:, None]) & (s != _NONE) & (k > 0)[:, None]


def _histograms(shift: int, bits: int):
    """Counts of 2 ** ``bits`` bins of width 2 ** ``shift`` above each query's low end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s, low, need = _scores(row), np.array(row["low"], np.int64), np.array(row["need"], np.int64)
                gap = s - low[:, None]
                inside = (s != _NONE) & (s >= low[:, None]) & ((gap >> shift) < (1 << bits))
                q, at = np.nonzero(_best(np.where(inside, s, _NONE), need))
                keys, counts = np.unique((q << BIN_BITS) | (gap[q, at] >> shift), return_counts=True)
                queries = np.array(row["queries"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[keys >> BIN_BITS]), pa.array((keys & ((1 << BIN_BITS) - 1)).astype(np.int32)), pa.array(counts.astype(np.int64))],
                    names=["query_id", "bin", "n"],
                )

    return run


def _winners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores above the k-th best, and of its ties the smallest ids that can still be wanted."""
    for batch in batches:
        for row in batch.to_pylist():
            s, low, need = _scores(row), np.array(row["low"], np.int64), np.array(row["need"], np.int64)
            ids, queries = np.array(row["ids"], np.int64), np.array(row["queries"], np.int64)
            above = (s > low[:, None]) & (s != _NONE)
            by_id = np.argsort(ids, kind="stable")
            tied = ((s == low[:, None]) & (s != _NONE))[:, by_id]
            first = tied & (np.cumsum(tied, axis=1) <= need[:, None])
            above[:, by_id] |= first
            q, at = np.nonzero(above)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries[q]), pa.array(ids[at]), pa.array(s[q, at])], names=["query_id", "vec_id", "score"]
            )


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` highest scores among ``vectors``, fewer if there are fewer.

    A score is the inner product of floor(``scale`` * component), exact as long as it fits a long. Ties go to smaller ids. Vectors that are
    null or hold a null or non-finite component, and rows without an id, take no part; vectors of another dimension are no
    candidates. Rows with the query's id are the query's own and no candidates. Of several query rows with one id the smallest vector asks; repeated
    candidate rows all count. Empty tables give an empty result. Other columns take no part. Runs jobs when called.

    Queries are broadcast ``GROUP_BYTES`` at a time, so the largest broadcast doesn't grow with the input.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(id_col).isNotNull() & _usable(F.col(vec_col)))
        return rows.select(F.col(id_col).cast("long").alias("id"), _whole(F.col(vec_col), scale).alias("vec")).withColumn("dim", F.size("vec"))

    blocks = scratch.write(usable(vectors).mapInArrow(_pack, "dim int, ids array<long>, matrix binary"), "candidates")
    asked = scratch.write(usable(queries).groupBy("id").agg(F.min("vec").alias("vec")), "queries")
    total, dims, widest, heaviest = asked.agg(
        F.count(F.lit(1)), F.max(F.size("vec")), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.abs(x))),
        F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x).cast("double")))),
    ).first()
    names = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], names)
    largest = usable(vectors).agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x).cast("double"))))).first()[0]
    bound = min(int(widest * (largest or 0)) + 1, 2**62)
    n_blocks = -(-total // QUERY_BLOCK)
    per_group = max(1, GROUP_BYTES // (QUERY_BLOCK * 8 * max(1, dims)))
    n_groups = -(-n_blocks // per_group)
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks))
    asked = asked.withColumn("dim", F.size("vec")).withColumn("block", block)

    def met(state: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over all pairs of a query block and a candidate block."""
        rows = asked.join(state, F.col("id") == F.col("query_id")).groupBy("dim", "block").agg(
            F.array_sort(F.collect_list(F.struct("id", "vec", "low", "need"))).alias("rows")
        ).select(
            "dim", "block", F.col("rows.id").alias("queries"), F.flatten("rows.vec").alias("vectors"), F.col("rows.low").alias("low"), F.col("rows.need").alias("need"),
        )
        rows = scratch.write(rows, "asking")
        out = None
        for group in range(n_groups):
            first, last = group * per_group, min(n_blocks, (group + 1) * per_group) - 1
            own = F.broadcast(rows.where(F.col("block").between(first, last)))
            paired = blocks.withColumn("block", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")))).join(own, ["dim", "block"])
            part = paired.mapInArrow(run, schema)
            out = part if out is None else out.unionAll(part)
        return out

    whole = (2 * bound).bit_length()
    shift = max(0, whole - BIN_BITS)
    state = asked.select(F.col("id").alias("query_id"), F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    while True:
        counts = met(state, _histograms(shift, whole - shift), "query_id long, bin int, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        above = F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = counts.withColumn("above", above).join(state, "query_id")
        # the bin of the k-th best, or the lowest one where there are fewer candidates
        last = ranked.where("above < need").groupBy("query_id").agg(F.min_by(F.struct("bin", "above", "low", "need"), "bin").alias("x"))
        width = F.lit(1 << shift).cast("long")
        state = scratch.write(last.select("query_id", (F.col("x.low") + F.col("x.bin") * width).alias("low"), (F.col("x.need") - F.col("x.above")).alias("need")), "state")
        if shift == 0:
            break
        whole, shift = shift, max(0, shift - BIN_BITS)
    won = met(state, _winners, "query_id long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    # many blocks can hold ties: a first round of choices per query and part keeps the last one small
    part = Window.partitionBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(16))).orderBy(*order)
    best = won.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
