"""Which texts are in a language that a network knows: bounds fitted on labelled rows that it was not trained on.

A score means little by itself: short texts and texts with tables or keys in them score lower than prose. The bound of a text is therefore taken
from held-out texts of its length or longer, a margin below the lowest score of those that were told right. Scripts that
no labelled text is written in are told by their letters, as a network scores them at will.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.language_id import UNKNOWN, Network, has_letters, identify_language, training_windows

#: held-out rows that a bound needs, of its length class or longer and of the class itself, its margin, its highest value in parts of the way from chance to certainty
LEAST_ROWS, LEAST_OF_CLASS = 100, 10
MARGIN = 0.9
HIGHEST = 0.4
#: labelled windows that the known letters are taken from, per language, and their characters
WINDOWS, CHARS = 1024, 288


@dataclass(frozen=True)
class Gate:
    """Least score by length class (floor of log2 of the characters; longer ones take the longest class's), and the known letters."""

    bounds: dict[int, float]
    letters: str

    def accepts(self, text: Column, lang: Column, score: Column) -> Column:
        """Whether a text is in a known language, given what was predicted for it."""
        length = F.least(length_class(text), F.lit(max(self.bounds, default=0)))
        known = [F.lit(x) for pair in self.bounds.items() for x in pair]
        least = F.coalesce(F.try_element_at(F.create_map(*known), length), F.lit(0.0)) if known else F.lit(0.0)
        own = F.regexp_count(text, F.lit(f"[{re.escape(self.letters)}]")) if self.letters else F.lit(0)
        return (lang != UNKNOWN) & (score >= least) & (2 * own >= F.regexp_count(text, F.lit(r"\p{L}")))


def length_class(text: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.lit(1), F.length(text)))).cast("int")


def fit_gate(network: Network | None, trained_on: DataFrame, held_out: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Gate:
    """The gate of a network from labelled rows that it has seen (their letters) and others (their scores).

    Letters come from at most ``WINDOWS`` windows per language, scores from all held-out rows; the driver sees one number per length class. A class of which
    too few rows were told right has no bound, and its texts pass by their score. Rows without text or label take no part; without a
    network letters alone decide.
    """
    windows = training_windows(trained_on, lang_col, text_col, WINDOWS, CHARS).select("window").distinct()
    letters = windows.select(F.explode(F.array_distinct(F.split("window", ""))).alias("c")).where(F.col("c").rlike(r"^\p{L}$")).distinct()
    found = "".join(sorted(r["c"] for r in letters.collect()))  # as many as the alphabets of the known languages have
    if network is None or len(network.labels) < 2:
        return Gate({}, found)
    labelled = held_out.where(F.col(lang_col).isNotNull() & has_letters(F.col(text_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    right = identify_language(labelled, network).where(F.col("lang_pred") == F.col("lang"))
    lowest = right.groupBy(length_class(F.col("text")).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).collect()
    chance = 1 / len(network.labels)
    highest = chance + HIGHEST * (1 - chance)
    bounds: dict[int, float] = {}
    least, n = 1.0, 0
    for r in sorted(lowest, key=lambda r: -r["c"]):
        least, n = min(least, r["score"]), n + r["n"]
        if n >= LEAST_ROWS and r["n"] >= LEAST_OF_CLASS:
            bounds[r["c"]] = min(highest, MARGIN * least)
    return Gate(bounds, found)
