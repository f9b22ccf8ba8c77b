"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Sources get targets by weight, none above a multiple of its size. Blocks of words then go to
sources by highest quotients, and each source's blocks to its shards in the same way, so every
shard knows its integer quota. Inside a shard documents lie end to end in a seeded order, pass
after pass, and the first blocks of that line are taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import Scratch

#: words in a block; documents that a shard holds about; shards whose quotas are apportioned together
BLOCK_WORDS = 64
SHARD_DOCS = 1_000
GROUP_SHARDS = 4096
NEW = ("size", "source_size", "target", "taken")


def apportion(shares: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients share / (2 * seats + 1), no party above its ``most``; ties to the first.

    A common divisor gives all seats but a few at once; those are then given or taken one by one.
    """
    shares = np.asarray(shares, float)
    seats = int(min(seats, most.sum()))
    given = np.zeros(len(shares), np.int64)
    if not len(shares) or seats <= 0 or shares.max() <= 0:
        return given

    def at(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(shares / divisor + 0.5)).astype(np.int64)

    low, high = 0.0, 2 * shares.max() + 1  # many seats at a low divisor, none at a high one
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = at(high)
    while given.sum() < seats:
        quotient = np.where(given < most, shares / (2 * given + 1), -1.0)
        given[int(quotient.argmax())] += 1
    return given


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_times: int = 3) -> DataFrame:
    """(source, source_size, target) from the total size of each source.

    Sources in order of their code points, null last, weigh ``weights`` in turn. The total of all sizes is shared by weight;
    a target stops at ``most_times`` its source's size and what is over is shared among the rest. In the
    order of size / weight the sources that stop come first, so running totals find them at once.
    One row per source, in one task.
    """
    # Spark compares strings by their UTF-8 bytes, which is the order of code points
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - most_times * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levelled = weighed.withColumn("level", level).withColumn("stops", most_times * F.col("source_size") <= F.col("weight") * F.col("level"))
    # the level of the first source that does not stop holds for all that follow
    common = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(whole)
    return levelled.select(
        "source", "source_size",
        F.when(F.col("stops"), (most_times * F.col("source_size")).cast("double")).otherwise(F.col("weight") * common).alias("target"),
    )


def _source_blocks(block: int, most_times: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        most = np.ceil(most_times * rows["source_size"].to_numpy() / block).astype(np.int64)
        total = int(np.round(rows["target"].sum() / block))
        rows["blocks"] = apportion(rows["target"].to_numpy(), total, most)
        return rows[["source", "source_size", "target", "blocks"]]

    return run


def _part_blocks(part: str, block: int, most_times: int):
    """The blocks of a whole, apportioned to its parts by their sizes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(part).reset_index(drop=True)
        most = np.ceil(most_times * rows["part_size"].to_numpy() / block).astype(np.int64)
        rows["quota"] = apportion(rows["part_size"].to_numpy(), int(rows["blocks"].iloc[0]), most)
        return rows[["source", *(["shard_group"] if part == "shard" else []), part, "part_size", "quota"]]

    return run


def words(text: Column) -> Column:
    """Number of runs of characters other than U+0020 and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_times: int = 3, seed: int = 17, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", block: int = BLOCK_WORDS, keep: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: the columns of ``keep`` (the id alone by default), ``size``, ``source_size``, ``target`` and ``taken`` words.

    ``taken`` counts repeats and is never above ``most_times`` * ``size``; a document may be taken in part where a quota
    ends in it. The words taken of a source are within a block of its target, and of the whole mix
    within a block of the total. The choice depends on ids, sizes and the seed alone, so reruns agree; rows equal in id and size
    are exchangeable.

    A null or empty text has size 0 and takes 0. A null source is a source of its own, the last one. All-empty or
    empty tables give targets of 0 and no error. Columns named like the new ones are replaced; others take no part. Runs jobs when called.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    keep = [c for c in keep or [id_col] if c.lower() not in NEW]
    made = {
        "_mx_source": F.col(source_col).cast("string"), "_mx_size": words(F.col(text_col)), "_mx_h": F.xxhash64(F.lit(seed), F.col(id_col)),
    }
    sized = docs.select(*[c.alias(name) for name, c in made.items()])
    sized = scratch.write(sized, "sized").select(*[F.col(f"_mx_{c}").alias(c) for c in ("source", "size", "h")])
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(stats.select("source", "source_size"), weights, most_times)
    # one row per source: the quotients of all sources meet in one task
    seats = targets.groupBy(F.lit(0).alias("all")).applyInPandas(
        _source_blocks(block, most_times), "source string, source_size long, target double, blocks long"
    )
    shards = F.greatest(F.lit(1), F.ceil(F.col("docs") / SHARD_DOCS)).cast("long").alias("shards")
    counts = stats.select(F.col("source").alias("_mx_source"), shards)
    plan = scratch.write(seats.join(counts, F.col("source").eqNullSafe(F.col("_mx_source"))).drop("_mx_source"), "plan")
    own = plan.select(F.col("source").alias("_mx_own"), *[F.col(c).alias(f"_mx_{c}") for c in ("source_size", "target", "blocks", "shards")])

    def sharded(rows: DataFrame, source: str, h: str) -> DataFrame:
        return rows.join(own, F.col(source).eqNullSafe(F.col("_mx_own"))).withColumn("_mx_shard", F.pmod(F.xxhash64(h), F.col("_mx_shards")))

    shard_sizes = sharded(sized, "source", "h").groupBy("source", F.col("_mx_shard").alias("shard"), F.col("_mx_blocks").alias("blocks")).agg(
        F.sum("size").alias("part_size")
    )
    # a source of any size has shards of one size, and so very many of them; they get their quotas in groups, which get theirs first
    shard_sizes = scratch.write(shard_sizes.withColumn("shard_group", F.floor(F.col("shard") / GROUP_SHARDS)), "shard-sizes")
    of_groups = shard_sizes.groupBy("source", "shard_group", "blocks").agg(F.sum("part_size").alias("part_size")).groupBy("source").applyInPandas(
        _part_blocks("shard_group", block, most_times), "source string, shard_group long, part_size long, quota long"
    )
    of_groups = of_groups.select(F.col("source").alias("_g_source"), F.col("shard_group").alias("_g"), F.col("quota").alias("blocks"))
    grouped = shard_sizes.drop("blocks").join(of_groups, F.col("source").eqNullSafe(F.col("_g_source")) & (F.col("shard_group") == F.col("_g"))).drop("_g_source", "_g")
    quotas = grouped.groupBy("source", "shard_group").applyInPandas(
        _part_blocks("shard", block, most_times), "source string, shard_group long, shard long, part_size long, quota long"
    ).select("source", "shard", F.col("part_size").alias("shard_size"), "quota")
    quotas = scratch.write(quotas, "quotas").select(*[F.col(c).alias(f"_mx_q_{c}") for c in ("source", "shard", "shard_size", "quota")])

    line = Window.partitionBy("_mx_source", "_mx_shard").orderBy("_mx_h", "_mx_size").rowsBetween(Window.unboundedPreceding, -1)
    laid = sharded(docs.select(*keep, *[c.alias(name) for name, c in made.items()]), "_mx_source", "_mx_h")
    laid = laid.withColumn("_mx_start", F.coalesce(F.sum("_mx_size").over(line), F.lit(0)))
    laid = laid.join(quotas, F.col("_mx_source").eqNullSafe(F.col("_mx_q_source")) & (F.col("_mx_shard") == F.col("_mx_q_shard")))
    whole = F.col("_mx_q_shard_size")
    quota = F.least(F.col("_mx_q_quota") * block, most_times * whole)
    passes = F.when(whole > 0, F.floor(quota / whole)).otherwise(F.lit(0))
    last = F.greatest(F.lit(0), F.least(F.col("_mx_size"), quota - passes * whole - F.col("_mx_start")))
    return laid.select(
        *keep, F.col("_mx_size").alias("size"), F.col("_mx_source_size").alias("source_size"), F.col("_mx_target").alias("target"),
        (passes * F.col("_mx_size") + last).cast("long").alias("taken"),
    )
