"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, so an item asked again with other values has the
same template. Windows of template tokens are joined by hash with the windows of the benchmark; along
one alignment the values in the slots must then agree: one value of the item stands for one value of the text throughout.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from tidemark.llm.common import Scratch, next_power_of_two, row_identity

WINDOW = 8
#: a window counts if so many of its tokens are no placeholders
LITERALS = 4
#: consecutive tokens of an item that make a leak (all of them for shorter items)
LEAK_TOKENS = 13
#: fixed patterns and placeholders
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*%?"
NAMES = r"\p{Lu}(?<=[^.!?:\s]\x20\p{Lu})\p{Ll}+"
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mile miles ft feet foot inch inches yard yards l ml liter liters litre litres gallon gallons "
    "s sec seconds second min minutes minute h hr hrs hours hour days day weeks week months month years year "
    "dollars dollar cents cent euros euro percent degrees degree mph kmh kw kwh w v hz ghz mhz mb gb tb"
).split()
UNITS_AFTER = rf"(\x01\x20?)(?:{'|'.join(sorted(UNITS, reverse=True))})\b"
JUNK = r"[^\p{L}\p{N}\x01-\x03\s]+"
SLOT = r"[\x01-\x03]"


def template(text: Column, names: bool = True) -> Column:
    """Text with placeholders, still one token for each token of the text."""
    out = F.regexp_replace(text, NUMBERS, NUMBER)
    out = F.regexp_replace(out, NAMES, NAME) if names else out
    return F.regexp_replace(out, UNITS_AFTER, rf"$1{UNIT}")


def tokens(text: Column) -> Column:
    """Lower-cased tokens without punctuation."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, JUNK, "")), r"\s+"), lambda x: x != "")


def window_bits(index: DataFrame, most_bits: int = 1 << 23) -> list[int]:
    """Bits of the window hashes as 64-bit words, for a test that only false positives pass; at most ``most_bits`` whatever the benchmark."""
    bits = min(most_bits, max(1 << 12, next_power_of_two(32 * index.count())))
    word = F.shiftrightunsigned("h", 64 - (bits // 64).bit_length() + 1).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    rows = index.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("mask")).collect()
    out = [0] * (bits // 64)
    for row in rows:
        out[row["word"]] = row["mask"]
    return out


def windows(df: DataFrame, text_col: str, keep: list[Column], names: bool = True, bits: list[int] | None = None) -> DataFrame:
    """(kept columns, pos, h, exact, slots): one row for every window of ``WINDOW`` template tokens; ``slots`` holds the values behind its placeholders.

    A window with fewer than ``LITERALS`` plain tokens has a second, ``exact`` row, whose hash is that of its own tokens.

    With ``bits``, windows that are surely none of ``window_bits`` are left out where they are made.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = df.select(*keep, text.alias("_bd_text"), template(text, names).alias("_bd_template"))
    kept = [c for c in parts.columns if not c.startswith("_bd_")]
    parts = parts.select(
        *kept, "_bd_text", tokens(F.col("_bd_template")).alias("_bd_c"), F.col("_bd_template").rlike(SLOT).alias("_bd_has")
    )
    # the same tokens with their own values; only texts with placeholders need them
    own = F.when(F.col("_bd_has"), tokens(F.col("_bd_text")))
    values = F.transform(F.arrays_zip(F.col("_bd_c").alias("c"), own.alias("o")), lambda x: F.when(x["c"].rlike(SLOT), x["o"]))
    parts = parts.where(F.size("_bd_c") >= WINDOW).withColumn("_bd_v", F.when(F.col("_bd_has"), values))

    hashed = F.transform(
        F.sequence(F.lit(1), F.size("_bd_c") - (WINDOW - 1)),
        lambda i: F.struct(i.alias("i"), F.xxhash64(F.slice("_bd_c", i, F.lit(WINDOW))).alias("h"), F.lit(False).alias("exact")),
    )
    at = F.filter(F.sequence(F.lit(1), F.size("_bd_c")), lambda i: F.element_at("_bd_v", i).isNotNull())
    parts = parts.withColumn("_bd_at", F.when(F.col("_bd_has"), at)).withColumn("_bd_own", own)
    # first and last of so many placeholders in a row that a window over them has too few plain tokens
    most = WINDOW - LITERALS
    crowds = F.filter(
        F.arrays_zip(F.col("_bd_at").alias("a"), F.slice("_bd_at", F.lit(most + 1), F.size("_bd_at")).alias("b")), lambda x: x["b"] - x["a"] < WINDOW
    )
    starts = F.transform(crowds, lambda x: F.sequence(F.greatest(F.lit(1), x["b"] - (WINDOW - 1)), F.least(x["a"], F.size("_bd_c") - (WINDOW - 1))))
    exact = F.transform(
        F.array_distinct(F.flatten(starts)),
        lambda i: F.struct(i.alias("i"), F.xxhash64(F.lit(1), F.slice("_bd_own", i, F.lit(WINDOW))).alias("h"), F.lit(True).alias("exact")),
    )
    hashed = F.when(F.size("_bd_at") > most, F.concat(hashed, exact)).otherwise(hashed)
    if bits is not None:
        held = F.lit(np.array(bits, np.int64))

        def known(w: Column) -> Column:
            word = F.shiftrightunsigned(w["h"], 64 - len(bits).bit_length() + 1).cast("int")
            return F.getbit(held[word], w["h"].bitwiseAND(F.lit(63)).cast("int")) == 1

        hashed = F.filter(hashed, known)
    slots = lambda w: F.when(F.col("_bd_has"), F.filter(F.slice("_bd_v", w["i"], F.lit(WINDOW)), lambda x: x.isNotNull()))
    each = F.transform(hashed, lambda w: F.struct((w["i"] - 1).alias("pos"), w["h"].alias("h"), w["exact"].alias("exact"), slots(w).alias("slots")))
    out = parts.select(*kept, F.explode(each).alias("w"))
    return out.select(*kept, "w.pos", "w.h", "w.exact", F.coalesce("w.slots", F.array().cast("array<string>")).alias("slots"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, ipos, h, exact, islots, n, n_plain): windows of the items, with names as placeholders and as they are (for texts in one case)."""
    both = None
    for names in (True, False):
        made = windows(items, text_col, [F.col(id_col).alias("item"), F.xxhash64(id_col, text_col).alias("ir")], names)
        both = made if both is None else both.unionAll(made)
    indexed = F.col("exact") | (F.size("slots") <= WINDOW - LITERALS)
    sizes = both.groupBy("ir").agg((F.max("pos") + 1).alias("n"), F.count_distinct(F.when(~F.col("exact") & indexed, F.col("pos"))).alias("n_plain"))
    return both.join(sizes, "ir").where(indexed).select(
        "item", F.col("pos").alias("ipos"), "h", "exact", F.col("slots").alias("islots"), "n", "n_plain"
    ).distinct()


def short_leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, scratch: Scratch) -> DataFrame | None:
    """(r1, r2, item, leaked) for items of fewer than ``WINDOW`` tokens, which leak where all their own tokens follow one another; None without such items."""
    held = tokens(F.coalesce(F.col(item_text).cast("string"), F.lit("")))
    short = items.select(F.col(item_id).alias("item"), held.alias("own")).where(F.size("own").between(1, WINDOW - 1))
    short = scratch.write(short.select("item", F.size("own").alias("k"), F.xxhash64("own").alias("h")).distinct(), "short")
    lengths = sorted(r["k"] for r in short.select("k").distinct().collect())
    if not lengths:
        return None
    r1, r2 = row_identity(F.col(id_col), F.col(text_col))
    rows = docs.select(r1.alias("r1"), r2.alias("r2"), tokens(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("own"))

    def of(k: int) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size("own") - (k - 1)), lambda i: F.xxhash64(F.slice("own", i, F.lit(k))))
        return F.when(F.size("own") >= k, made).otherwise(F.array().cast("array<bigint>"))

    each = rows.select("r1", "r2", F.explode(F.array_distinct(F.concat(*[of(k) for k in lengths]))).alias("h"))
    return each.join(short, "h").select("r1", "r2", "item", F.lit(1).cast("long").alias("leaked")).distinct()


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """(r1, r2, item, leaked): the items that a row of ``docs`` holds, and the windows of each it holds.

    ``r1``, ``r2`` are ``row_identity`` of id and text, so rows equal in both are one. An item leaks when, along one alignment,
    at least ``LEAK_TOKENS`` of its tokens in windows (all windows of a shorter item) match and no value of the item stands
    for two values of the text. Windows with fewer than ``LITERALS`` plain tokens count where they are held word for word; an item of up to ``LEAK_TOKENS`` tokens also leaks
    when all its other windows match. An item of fewer than ``WINDOW`` tokens leaks where its own tokens follow one another. Null and empty ones match nothing.
    The benchmark's windows are broadcast up to ``broadcast_rows`` rows (some 50 MB), else joined by hash.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    index = scratch.write(benchmark_windows(items, item_id, item_text), "windows")
    bits = window_bits(index)
    index = F.broadcast(index) if index.count() <= broadcast_rows else index
    r1, r2 = row_identity(F.col(id_col), F.col(text_col))
    met = windows(docs, text_col, [r1.alias("r1"), r2.alias("r2")], bits=bits).join(index, ["h", "exact"])
    # equal words may differ in what is a name, so the values of exact windows stand for themselves
    pairs = F.arrays_zip(F.col("islots").alias("a"), F.when(F.col("exact"), F.col("islots")).otherwise(F.col("slots")).alias("b"))
    aligned = met.groupBy("r1", "r2", "item", "n", "n_plain", (F.col("pos") - F.col("ipos")).alias("shift")).agg(
        F.collect_set("ipos").alias("at"), F.size(F.collect_set(F.when(~F.col("exact"), F.col("ipos")))).alias("plain"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    wanted = F.least(F.col("n"), F.lit(LEAK_TOKENS - WINDOW + 1))
    agree = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"])))
    rest = (F.col("n") <= LEAK_TOKENS - WINDOW + 1) & (F.col("n_plain") > 0) & (F.col("plain") >= F.col("n_plain"))
    found = aligned.where(((F.size("at") >= wanted) | rest) & agree)
    found = found.groupBy("r1", "r2", "item").agg(F.max(F.size("at")).cast("long").alias("leaked"))
    short = short_leaks(docs, items, id_col, text_col, item_id, item_text, scratch)
    return found if short is None else found.unionAll(short).groupBy("r1", "r2", "item").agg(F.max("leaked").alias("leaked"))


def mark_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``contaminated``, ``items`` (the ids of leaked items, sorted) and ``n_windows`` (their leaked windows).

    Texts of any length are read whole; null, empty and short ones are clean, and so is every text where the benchmark is empty. Other columns take no part.
    """
    found = leaks(docs, items, id_col, text_col, item_id, item_text).groupBy("r1", "r2").agg(
        F.array_sort(F.collect_list("item")).alias("items"), F.sum("leaked").alias("n_windows")
    )
    r1, r2 = row_identity(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col), r1.alias("r1"), r2.alias("r2")).join(found, ["r1", "r2"], "left")
    kind = ArrayType(items.schema[item_id].dataType)
    return rows.select(
        id_col, F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array()).cast(kind).alias("items"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns as they were."""
    scratch = Scratch(docs.sparkSession, "decontaminated")
    found = scratch.write(leaks(docs, items, id_col, text_col, item_id, item_text).select(F.col("r1").alias("_bd_x1"), F.col("r2").alias("_bd_x2")).distinct(), "leaks")
    r1, r2 = row_identity(F.col(id_col), F.col(text_col))
    named = docs.withColumns({"_bd_r1": r1, "_bd_r2": r2})
    same = (F.col("_bd_r1") == F.col("_bd_x1")) & (F.col("_bd_r2") == F.col("_bd_x2"))
    return named.join(found, same, "left_anti").select(*docs.columns)
