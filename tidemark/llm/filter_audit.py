"""Interaction of filters in every order, by wide packed counters.

A document's outcome in any order of the filters depends only on the mask of filters that it fails. Each mask is
mapped to one big integer with a field for every outcome of every step of every order. Documents are counted by part and mask
first; the counts times the integers, summed, hold all counters of a part at once. A field is as wide as the
part's number of rows needs, so that no sum runs over into the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Scratch, row_identity

#: outcomes of a step, in the order of their fields
OUTCOMES = ("kept", "removed", "redundant")
COUNTED = ("docs", "good", "toxic")
WORDS = r"[^\x20\x09-\x0D]+"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, "
    "shapley long"
)


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides by itself; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    return {
        "A": n < 100, "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text), "D": text.rlike("[#$%&*|]"),
    }


@lru_cache
def steps(filters: str) -> tuple[tuple[str, int], ...]:
    """(order, place) of every step of every order."""
    return tuple(("".join(order), i) for order in permutations(filters) for i in range(len(order)))


def packed(mask: int, filters: str, width: int) -> int:
    """The big integer of a mask: a 1 in the field of each outcome that its documents have, ``width`` bits a field."""
    out = 0
    for n, (order, i) in enumerate(steps(filters)):
        failed = [mask >> filters.index(f) & 1 for f in order[: i + 1]]
        gone = any(failed[:-1])
        for field, holds in enumerate((not any(failed), failed[-1] and not gone, failed[-1] and gone)):
            if holds:
                out |= 1 << (n * len(OUTCOMES) + field) * width
    return out


def unpacked(total: int, filters: str, width: int) -> Iterator[tuple[int, ...]]:
    """The counters of every step, in the order of ``steps``."""
    raw = total.to_bytes((len(steps(filters)) * len(OUTCOMES) * width + 7) // 8, "little")
    for n in range(len(steps(filters))):
        fields = []
        for field in range(len(OUTCOMES)):
            bit = (n * len(OUTCOMES) + field) * width
            piece = int.from_bytes(raw[bit // 8 : (bit + width + 7) // 8], "little")
            fields.append(piece >> bit % 8 & (1 << width) - 1)
        yield tuple(fields)


def _audit(filters: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        width = max(1, *(sum(map(int, rows[name])).bit_length() for name in COUNTED))
        totals, alone = dict.fromkeys(COUNTED, 0), dict.fromkeys(filters, 0)
        for row in rows.itertuples():
            field = packed(int(row.mask), filters, width)
            for name in COUNTED:
                totals[name] += int(getattr(row, name)) * field
            for i, f in enumerate(filters):
                alone[f] += int(row.docs) if row.mask == 1 << i else 0
        read = [list(unpacked(totals[name], filters, width)) for name in COUNTED]
        share = dict.fromkeys(filters, 0)
        for (order, i), (_, removed, _) in zip(steps(filters), read[0]):
            share[order[i]] += removed
        part = rows["part"].iloc[0]
        return pd.DataFrame([
            (part, order, i + 1, kept, removed, redundant, alone[order[i]], good[1], toxic[1], share[order[i]])
            for (order, i), (kept, removed, redundant), good, toxic in zip(steps(filters), *read)
        ], columns=[c.split()[0] for c in REPORT.split(", ")])

    return run


def audit_masks(counts: DataFrame, filters: str) -> DataFrame:
    """The report from (part, mask, docs, good, toxic) counts: bit i of a mask says that its documents fail filter i.

    One row per part, order and step, zeros included; a part is one group of at most ``2 ** len(filters)`` rows.
    """
    return counts.groupBy("part").applyInPandas(_audit(filters), REPORT)


def audit_filters(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, copies: str = "E", id_col: str = "doc_id",
    text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """What every filter removes at every step of every order, per part.

    ``filters`` names conditions on the text alone (by default ``text_filters``) by one letter each; ``copies`` is the letter of
    one more filter, failed by a text that a smaller id has anywhere in ``docs``, removed or not. Per part, order and step:
    documents ``kept`` after it and ``removed`` by it, ``redundant`` ones (failing it, removed before), ``unique_fails`` (failing no
    other), ``good_lost`` and ``toxic_lost`` (removed here and of quality 1 or toxic 1 in ``labels``), and ``shapley``: what the filter
    removes, summed over all orders.

    A null part is the empty string, a null text an empty one. Rows equal in id and text are counted each, and neither is the
    other's copy; a null id is no smaller than any, has no smaller one, and has no label. Several labels of one id count if any says 1. Other
    columns take no part; an empty table gives no rows. Runs jobs when called.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    told = dict(filters if filters is not None else text_filters(F.col(text_col)))
    names = "".join(told) + copies
    own = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(told.values())), F.lit(0)).cast("int")
    h1, h2 = row_identity(text)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), own.alias("mask"), h1.alias("h1"), h2.alias("h2")
    )
    # equal rows become one with a count; a text's many ids are spread by the id
    rows = scratch.write(rows.groupBy("id", "h1", "h2", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "rows")
    said = labels.groupBy(F.col(id_col).alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    known = rows.where("id is not null").join(said, F.col("id") == F.col("l_id"), "left")
    kinds = known.select("id", "h1", "h2", "part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    kinds = kinds.unionByName(rows.where("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))
    # per text and kind of row: all rows, and those of its smallest id; both add up before they are shuffled
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    groups = kinds.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), least.alias("least")
    )
    groups = scratch.write(groups, "groups")
    first = groups.groupBy("h1", "h2").agg(F.min("least.id").alias("id")).withColumnsRenamed({"h1": "f1", "h2": "f2"})
    met = groups.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")))
    stays = F.col("unnamed") + F.when(F.col("least.id") == F.col("id"), F.col("least.n")).otherwise(0)
    each = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), stays.alias("n")),
        F.struct((F.col("mask") + (1 << len(told))).alias("mask"), (F.col("n") - stays).alias("n")),
    ))
    masks = met.select("part", "good", "toxic", each.alias("e")).groupBy("part", F.col("e.mask").alias("mask")).agg(
        F.sum("e.n").alias("docs"), F.sum(F.col("good") * F.col("e.n")).alias("good"), F.sum(F.col("toxic") * F.col("e.n")).alias("toxic")
    )
    # a part counts also where all of its rows are of one mask; masks without rows add nothing
    return audit_masks(scratch.write(masks.where("docs > 0"), "masks"), names)
