"""Left joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALT = "_salt"
COPIES = "_copies"


#: rows of one key that a task should have to handle
ROWS_PER_TASK = 1_000_000
#: pairs that a task should make of one key that is hot on both sides
PAIRS_PER_TASK = 100_000_000


def heavy_keys(df: DataFrame, key: str, share: float = 0.001, rows_per_task: int = ROWS_PER_TASK) -> dict:
    """Key values (None included) with more than ``rows_per_task`` rows, and the tasks each should be split over.

    Only keys above ``share`` of all rows count, so there are never more than ``1 / share`` of them and they fit in a plan
    as literals. This runs a job over the key column alone, when it is called.
    """
    counts = df.select(key).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    bar = F.greatest(counts.agg(F.sum("_n")).scalar() * F.lit(share), F.lit(float(rows_per_task)))
    return {row[0]: -(-row[1] // rows_per_task) for row in counts.where(F.col("_n") > bar).select(key, "_n").collect()}


def _is_heavy(key: str, heavy: Mapping) -> Column:
    values = [v for v in heavy if v is not None]
    return F.coalesce(F.col(key).isin(values), F.lit(False)) if values else F.lit(False)


def _salts(key: str, heavy: Mapping) -> Column:
    """The number of salts of the row's key; looked up for heavy keys only."""
    known = [F.lit(x) for k, n in heavy.items() if k is not None for x in (k, int(n))]
    salts = F.when(_is_heavy(key, heavy), F.try_element_at(F.create_map(*known), F.col(key))) if known else F.lit(None)
    null = F.when(F.col(key).isNull(), F.lit(int(heavy.get(None, 1))))
    return F.coalesce(salts, null, F.lit(1)).cast("int")


def spread(df: DataFrame, key: str, heavy: Mapping, spread_on: Sequence[str]) -> DataFrame:
    """Give rows of heavy keys one of their key's salts, computed from their own values; others get salt 0."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(*spread_on), _salts(key, heavy).cast("long")).cast("int"))


def replicate(df: DataFrame, key: str, heavy: Mapping) -> DataFrame:
    """Repeat only the rows of heavy keys, once per salt of their key."""
    every = F.when(_is_heavy(key, heavy), _salts(key, heavy)).otherwise(F.lit(1))
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), every - 1)))


def left_join_chain(
    anchor: DataFrame,
    sides: Sequence[DataFrame],
    key: str,
    spread_on: Sequence[str],
    heavy: Mapping | None = None,
) -> DataFrame:
    """Left-join ``sides`` one after the other on the same key.

    With heavy anchor keys all joins use (key, salt): the anchor is shuffled once for
    the whole chain and a heavy key is split by its own count. ``spread_on`` are
    columns that differ between the anchor rows of one key.
    """
    heavy = heavy_keys(anchor, key) if heavy is None else heavy
    if not heavy:
        for side in sides:
            anchor = anchor.join(side, key, "left")
        return anchor
    out = spread(anchor, key, heavy, spread_on)
    for side in sides:
        out = out.join(replicate(side, key, heavy), [key, SALT], "left")
    return out.drop(SALT)


def heavy_grid(
    left: DataFrame, right: DataFrame, key: str, share: float = 0.001, rows_per_task: int = ROWS_PER_TASK, pairs_per_task: int = PAIRS_PER_TASK
) -> dict:
    """Key values with too many rows or pairs for one task, and the (rows, columns) of the grid that each is split over.

    Left rows are dealt over the rows of the grid and right rows over its columns, so a cell holds about ``rows_per_task`` rows of a side and makes about
    ``pairs_per_task`` pairs. Only keys above ``share`` of a side count. One job over the two key columns, when it is called.
    """
    def counts(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(side))

    both = counts(left, "l").join(counts(right, "r").where("k is not null").withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left").select(
        "k", "l", F.coalesce("r", F.lit(0)).alias("r")
    )
    bars = {side: counts(df, side).agg(F.sum(side) * F.lit(share)).scalar() for side, df in (("l", left), ("r", right))}
    large = (F.col("l") > rows_per_task) | (F.col("r") > rows_per_task) | (F.col("l").cast("double") * F.col("r") > pairs_per_task)
    known = both.where(large & ((F.col("l") > bars["l"]) | (F.col("r") > bars["r"])))
    grid = {}
    for k, l, r in known.select("k", "l", "r").collect():
        rows, columns = -(-l // rows_per_task), max(1, -(-r // rows_per_task))
        more = math.sqrt(max(1.0, l * r / (rows * columns * pairs_per_task)))
        grid[k] = (min(l, math.ceil(rows * more)), max(1, min(r, math.ceil(columns * more))))
    return grid


def left_join_grid(
    left: DataFrame, right: DataFrame, key: str, left_spread_on: Sequence[str], right_spread_on: Sequence[str], grid: Mapping | None = None,
) -> DataFrame:
    """Left join of two sides of which either, or both, may hold very many rows of one key.

    A heavy key's rows are dealt over a grid: a left row goes to all cells of its grid row, a right row to all cells of its grid column, so each pair meets
    in one cell. ``left_spread_on`` and ``right_spread_on`` are columns that differ between the rows of a key. Without heavy keys this is
    the ordinary join.
    """
    grid = heavy_grid(left, right, key) if grid is None else grid
    if not grid:
        return left.join(right, key, "left")
    rows, columns = ({k: size[i] for k, size in grid.items()} for i in (0, 1))
    # cells along one side, by salt of the row's own values along the other
    # more than one column means that the key is on the right, so every left row of it meets something in one of them
    copied = {k: n for k, n in columns.items() if n > 1}
    lefts = spread(left, key, rows, left_spread_on).withColumnRenamed(SALT, "_row").withColumn(COPIES, _is_heavy(key, copied))
    lefts = replicate(lefts, key, columns).withColumnRenamed(SALT, "_column")
    rights = spread(right.where(F.col(key).isNotNull()), key, columns, right_spread_on).withColumnRenamed(SALT, "_column").withColumn("_hit", F.lit(True))
    rights = replicate(rights, key, rows).withColumnRenamed(SALT, "_row")
    joined = lefts.join(rights, [key, "_row", "_column"], "left")
    return joined.where(~F.col(COPIES) | F.col("_hit").isNotNull()).drop("_row", "_column", COPIES, "_hit")
