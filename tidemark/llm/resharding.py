"""Resharding by minimum-cost flow: the fewest bytes that bring old shards to new capacities.

The flow runs from the sizes of the old shards to the capacities of the new ones; a byte that stays costs nothing. Its
network has one node per shard, whatever the size of the table. Documents follow the flow: the few that are large against a shard
one by one, all others by where they lie in the order of their old shard, which is cut
into one stretch per new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import Scratch, without
from tidemark.operators.ordered import running_totals

#: a row larger than this part of an even shard is placed one by one; a table has at most as many of them as parts in all shards
LARGE_PART = 256
NEW = ("size", "old_shard", "shard", "slot")


def capacities(total: int, shards: int) -> np.ndarray:
    """``total`` in ``shards`` equal parts, those of the first shards a unit larger where it does not divide."""
    return np.array([total // shards + (i < total % shards) for i in range(shards)], np.int64)


def moving_costs(old: int, new: int) -> np.ndarray:
    """1 for a byte that changes its shard, 0 for one that stays."""
    return 1 - np.eye(old, new, dtype=np.int64)


def min_cost_flow(supply: Sequence[int], room: Sequence[int], cost: np.ndarray) -> np.ndarray:
    """Whole-numbered flow (old, new) of least cost that takes all of ``supply`` into ``room``.

    Successive shortest paths with potentials, from all shards that have something left at once. Costs are whole and not negative, and
    ``room`` holds ``supply``.
    """
    left, space = np.array(supply, np.int64), np.array(room, np.int64)
    if left.sum() > space.sum():
        raise ValueError("the capacities are smaller than what is to be stored")
    m, n = len(left), len(space)
    cost, flow = np.asarray(cost, np.int64), np.zeros((m, n), np.int64)
    far = np.iinfo(np.int64).max // 4
    height = np.zeros(m + n, np.int64)
    while left.any():
        near = np.full(m + n, far)
        near[:m][left > 0] = 0
        open_, via = np.ones(m + n, bool), np.full(m + n, -1)
        while True:
            at = int(np.where(open_, near, far + 1).argmin())
            open_[at] = False
            if at >= m and space[at - m] > 0:
                break
            if at < m:
                reach, slice_ = near[at] + cost[at] + height[at] - height[m:], slice(m, m + n)
            else:
                j = at - m
                back = near[at] - cost[:, j] + height[at] - height[:m]
                reach, slice_ = np.where(flow[:, j] > 0, back, far), slice(0, m)
            closer = open_[slice_] & (reach < near[slice_])
            near[slice_][closer] = reach[closer]
            via[slice_][closer] = at
        height += np.minimum(near, near[at])
        path = [at]
        while via[path[-1]] >= 0:
            path.append(int(via[path[-1]]))
        path.reverse()  # old, new, old, new, ...
        back = [flow[b, a - m] for a, b in zip(path[1::2], path[2::2])]
        amount = int(min(left[path[0]], space[at - m], *back))
        for a, b in zip(path[::2], path[1::2]):
            flow[a, b - m] += amount
        for a, b in zip(path[1::2], path[2::2]):
            flow[b, a - m] -= amount
        left[path[0]] -= amount
        space[at - m] -= amount
    return flow


def _place_large(rows: list, flow: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """(tie, old, new) of the large rows, largest first into the widest part of the flow, and what they leave of it."""
    left, out = flow.copy(), []
    for r in rows:
        new = int(left[r["old"]].argmax())
        left[r["old"], new] -= r["size"]
        out.append((r["tie"], r["old"], new))
    return out, np.maximum(left, 0)


def _stretches(left: np.ndarray, small: np.ndarray) -> list[tuple[int, list[int], list[float]]]:
    """Per old shard its new shards in turn, itself first, and where each one's stretch of the small rows ends."""
    out = []
    for old, total in enumerate(small):
        share = left[old].astype(float) if left[old].sum() else np.eye(1, left.shape[1], old % left.shape[1])[0]
        targets = sorted(np.flatnonzero(share).tolist(), key=lambda new: (new != old, new))
        ends = np.cumsum(share[targets]) * (float(total) / share.sum())
        out.append((old, targets, [float(x) for x in ends[:-1]]))
    return out


def flow_layout(
    docs: DataFrame, size: Column, old: Column, old_shards: int, room: Sequence[int] | int, order: Sequence[str], cost: np.ndarray | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``old_shard``, their new ``shard`` and their ``slot`` in it (from 0, without gaps).

    ``old`` is the present shard (0 to ``old_shards`` - 1), ``room`` the bytes of each new shard, or the number of new shards of
    equal size. As few bytes change their shard as the capacities allow, by the ``cost`` of a byte from an old to a new shard (by default 1, 0 where it
    stays); each cut misses its place by half a row at most, where no row is larger than a shard's ``LARGE_PART``. ``order`` names the columns
    that tell rows apart: a shard's rows lie in the order of their hash, so reruns agree but for rows equal in
    all of them, which are exchangeable.

    A null size counts as 0 and a null shard as shard 0. Columns named like the new ones are replaced; others
    stay. An empty table stays empty. The driver sees sums per shard and at most ``LARGE_PART`` large rows per new shard. Runs jobs when called.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "reshard")
    kept = without(docs, *NEW)
    # numbered where they are written, so that equal rows are told apart, and no task can number them anew
    rows = scratch.write(docs.select(
        *[F.col(c).alias(f"k_{c}") for c in kept.columns], F.coalesce(size.cast("long"), F.lit(0)).alias("size"), F.coalesce(old.cast("int"), F.lit(0)).alias("old"),
        F.xxhash64(*order).alias("h"), F.monotonically_increasing_id().alias("tie"),
    ), "rows")
    sums = rows.groupBy("old").agg(F.sum("size").alias("size")).collect()
    sizes = np.zeros(old_shards, np.int64)
    for r in sums:
        sizes[r["old"]] = r["size"]
    room = capacities(int(sizes.sum()), room) if isinstance(room, int) else np.array(room, np.int64)
    flow = min_cost_flow(sizes, room, moving_costs(old_shards, len(room)) if cost is None else cost)

    limit = max(1, int(sizes.sum()) // (len(room) * LARGE_PART))
    large_rows = rows.where(F.col("size") > limit).select("old", "size", "h", "tie").collect()
    large, left = _place_large(sorted(large_rows, key=lambda r: (-r["size"], r["h"], r["tie"])), flow)
    small = sizes - np.bincount([r["old"] for r in large_rows], [r["size"] for r in large_rows], old_shards).astype(np.int64)
    cuts = F.broadcast(spark.createDataFrame(_stretches(left, small), "c_old int, targets array<int>, ends array<double>"))

    line = rows.where(F.col("size") <= limit).withColumn("row", F.lit(1).cast("long"))
    line = running_totals(line, [F.col("h"), F.col("tie")], ["size", "row"], ["old"], is_staged=True)
    middle = F.col("size_before") + F.col("size") / 2
    stretch = F.size(F.filter("ends", lambda x: x <= middle))
    line = line.join(cuts, F.col("old") == F.col("c_old")).withColumn("shard", F.element_at("targets", stretch + 1))
    # a stretch is whole in its old shard's order, so its rows are numbered from its first one
    begins = line.groupBy("old", "shard").agg(F.min("row_before").alias("begin"), F.count(F.lit(1)).alias("n")).collect()
    filled, starts = np.zeros(len(room), np.int64), []
    for r in sorted(begins, key=lambda r: (r["shard"], r["old"])):
        starts.append((r["old"], r["shard"], int(filled[r["shard"]]) - r["begin"]))
        filled[r["shard"]] += r["n"]
    one_by_one = []
    for tie, _, new in large:
        one_by_one.append((tie, new, int(filled[new])))
        filled[new] += 1

    starts = F.broadcast(spark.createDataFrame(starts, "s_old int, s_shard int, base long"))
    placed = line.join(starts, (F.col("old") == F.col("s_old")) & (F.col("shard") == F.col("s_shard"))).withColumn("slot", F.col("row_before") + F.col("base"))
    told = F.broadcast(spark.createDataFrame(one_by_one, "l_tie long, shard int, slot long"))
    singles = rows.where(F.col("size") > limit).join(told, F.col("tie") == F.col("l_tie"))
    columns = [*[F.col(f"k_{c}").alias(c) for c in kept.columns], "size", F.col("old").alias("old_shard"), "shard", "slot"]
    return placed.select(*columns).unionAll(singles.select(*columns))


def moved_bytes(layout: DataFrame) -> DataFrame:
    """(old_shard, shard, rows, bytes) of what changes its shard, as ``flow_layout`` tells it."""
    return layout.where("old_shard <> shard").groupBy("old_shard", "shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def rewrite_shards(layout: DataFrame, path: str) -> dict[int, str]:
    """Store what ``flow_layout`` has moved, next to the files that stay; returns what became of every affected shard.

    Only two kinds of files are written, under ``path``: ``rest/shard=N`` holds all rows that stay in a shard that gives some away and takes its files'
    place; ``gained/shard=N`` holds the rows that come to a shard, beside its files. A shard without either is not touched.
    Rows lie in their slots' order. ``path`` is written anew, so a failed run is repeated as a whole.
    """
    gives = layout.where("old_shard <> shard").select(F.col("old_shard").alias("g")).distinct()
    parts = {
        "rest": layout.where("old_shard = shard").join(F.broadcast(gives), F.col("shard") == F.col("g"), "left_semi"),
        "gained": layout.where("old_shard <> shard"),
    }
    for name, rows in parts.items():
        rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/{name}")
    moved = moved_bytes(layout).collect()
    state = {int(r["old_shard"]): "rewritten" for r in moved}
    for r in moved:
        state[r["shard"]] = "rewritten, extended" if "rewritten" in state.get(r["shard"], "") else "extended"
    return state
