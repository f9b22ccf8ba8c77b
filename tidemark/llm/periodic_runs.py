"""Periodic runs of words by sparse diagonals: earlier occurrences extend match lengths, lag by lag.

A text is read once from left to right. What stands at the current place is looked up among the
earlier places; every lag at which it stood before is an active diagonal, whose match grows, and a diagonal
that does not go on is closed at once and emitted if its match is long enough.

One step is a block of words. A run of period ``q`` matches at least ``max(q, least - q)`` words at lag ``q``, so
it covers a whole block of ``q / 4`` words or more that begins at a multiple of the block's length. Lags
are therefore taken in classes, each twice as wide as the one before and with blocks twice as long. A
block has at most as many earlier occurrences in its class as the class has lags, so that the work of a text of ``n``
words is of the order ``n log n`` also where one word, or one passage, makes up all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import as_bytes, without
from tidemark.llm.text_hashes import SLICE_ROWS, mix

#: shortest run in words
LEAST_WORDS = 12
#: the first class holds the lags below this number, with blocks of two words
FIRST_LAGS = 8
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SEEDS = mix(np.arange(1, 5, dtype=np.uint64))


def _repeats(ids: np.ndarray) -> bool:
    """Whether any four words in a row may stand at two places; equal hashes only cost time."""
    n = len(ids) - 3
    with np.errstate(over="ignore"):
        words = mix(ids.astype(np.uint64))
        grams = np.sort(sum(words[j : j + n] * _SEEDS[j] for j in range(4)))
    return bool((grams[1:] == grams[:-1]).any())


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs of numbers: equal where both parts are."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def _earlier(blocks: np.ndarray, step: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per place at a multiple of ``step`` the lags ``low <= lag < high`` at which its block stood before, where there are any."""
    n = len(blocks)
    places = np.arange(0, n, step)
    order = np.argsort(blocks, kind="stable")
    keys = blocks[order] * (n + 1) + order
    wanted = blocks[places] * (n + 1)
    first = np.searchsorted(keys, wanted + np.maximum(places - high + 1, 0), "left")
    last = np.searchsorted(keys, wanted + np.maximum(places - low + 1, 0), "left")
    for i in np.flatnonzero(last > first):
        yield int(places[i]), places[i] - order[first[i] : last[i]]


def find_runs(ids: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text given as word numbers, by start, then period.

    A run is a stretch of ``max(least, 2 * period)`` words or more that repeats with this smallest period and that no
    neighbouring word extends. ``least`` is 12 at least.
    """
    ids = np.asarray(ids, np.int64)
    n = len(ids)
    if n < least or not _repeats(ids):
        return []
    found: dict[tuple[int, int], int] = {}

    def close(lag: int, begin: int, end: int, step: int) -> None:
        """The blocks in ``begin..end`` match at ``lag`` and their neighbours do not: the words around decide."""
        if end - begin + 2 * (step - 1) < max(lag, least - lag):
            return
        back = min(step, begin - lag)
        unlike = np.flatnonzero(ids[begin - back : begin] != ids[begin - lag - back : begin - lag])
        begin -= back - 1 - int(unlike[-1]) if len(unlike) else back
        ahead = min(step, n - end)
        unlike = np.flatnonzero(ids[end : end + ahead] != ids[end - lag : end - lag + ahead])
        end += int(unlike[0]) if len(unlike) else ahead
        if end - begin >= max(lag, least - lag):
            # a multiple of the smallest period has the same stretch
            stretch = (begin - lag, end)
            found[stretch] = min(lag, found.get(stretch, lag))

    blocks, step, low, high = _pairs(ids[:-1], ids[1:]), 2, 1, FIRST_LAGS
    while 2 * low <= n and len(blocks):
        active: dict[int, int] = {}
        at = 0
        for place, lags in _earlier(blocks, step, low, high):
            if place > at:  # no lag goes on over a block that stood nowhere before
                for lag, begin in active.items():
                    close(lag, begin, at, step)
                active = {}
            at = place + step
            going = {lag: active.pop(lag, place) for lag in lags.tolist()}
            for lag, begin in active.items():
                close(lag, begin, place, step)
            active = going
        for lag, begin in active.items():
            close(lag, begin, at, step)
        blocks = _pairs(blocks[:-step], blocks[step:]) if len(blocks) > step else blocks[:0]
        step, low, high = 2 * step, high, 2 * high
    return sorted((start, stop - start, period) for (start, stop), period in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those in no run after its first period."""
    inside = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return np.cumsum(inside[:-1]) == 0


def _text_runs(text: bytes | None, least: int) -> tuple[list[tuple[int, int, int]], int, bytes]:
    words = (text or b"").split()  # bytes are split at U+0020 and U+0009 to U+000D
    numbers: dict[bytes, int] = {}
    runs = find_runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)), least)
    if runs:
        stays = kept_words(len(words), runs)
        return runs, len(words), b" ".join([w for w, s in zip(words, stays) if s])
    return runs, len(words), b" ".join(words)


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length and period in words, by start, then period) and ``collapsed``.

    ``collapsed`` is the text with one period left of every run: its kept words joined by one space. Words are
    runs of characters other than U+0020 and U+0009 to U+000D, compared as they are. A text is a row of its own: a null, empty or blank
    one has no words, no runs and an empty ``collapsed``; repeated rows give equal results. One task holds one text at a time,
    of any length. Columns named like the new ones are replaced; others stay. An empty table stays empty.
    """
    kept = without(docs, "n_words", "runs", "collapsed")
    place = kept.columns.index(text_col)
    run_type = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType([
        *kept.schema.fields, StructField("n_words", LongType()), StructField("runs", ArrayType(run_type)), StructField("collapsed", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(first, SLICE_ROWS)
                told = [_text_runs(text, least) for text in as_bytes(rows.column(place)).to_pylist()]
                listed = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs, _, _ in told]
                new = [
                    pa.array([n for _, n, _ in told], pa.int64()), pa.array(listed, RUN_TYPE),
                    pa.array([text for _, _, text in told], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], names=schema.names)

    return kept.mapInArrow(run, schema)
