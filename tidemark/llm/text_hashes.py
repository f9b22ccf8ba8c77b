"""Word and shingle hashes of text columns, computed in numpy over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.common import flat_bytes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15
SLICE_ROWS = 512
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, _BASE, np.uint64)])
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_marks(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and which of them begin one; a word ends with its row."""
    inside = ~_SPACE[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(flat)]
    first[edges] = inside[edges]
    return inside, first


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words of every row of a string column; 0 for null."""
    counts = [np.zeros(0, np.int64)]
    for at in range(0, len(column), SLICE_ROWS):
        flat, offsets = flat_bytes(column.slice(at, SLICE_ROWS))
        counts.append(np.diff(np.searchsorted(np.flatnonzero(_word_marks(flat, offsets)[1]), offsets)))
    return np.concatenate(counts)


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of non-space bytes, A-Z lower-cased), and the word offsets of the rows."""
    inside, first = _word_marks(flat, offsets)
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(inside)
    begins = np.flatnonzero(first[at])
    lengths = np.diff(np.r_[begins, len(at)])
    place = np.arange(len(at)) - np.repeat(begins, lengths)
    with np.errstate(over="ignore"):
        hashed = np.add.reduceat(_LOWER[flat[at]] * _powers(int(lengths.max()))[place], begins)
    return mix(hashed), np.searchsorted(starts, offsets)


def chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets) for runs of rows of about ``most`` bytes; a row is never cut.

    A few hundred rows are unpacked at a time, so that little is held twice.
    """
    for first in range(0, len(column), SLICE_ROWS):
        flat, offsets = flat_bytes(column.slice(first, SLICE_ROWS))
        row, rows = 0, len(offsets) - 1
        while row < rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
            part = offsets[row : end + 1]
            hashes, words = word_hashes(flat[part[0] : part[-1]], part - part[0])
            yield first + row, hashes, words
            row = end


def fold_words(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` words in a row."""
    size = max(0, len(hashes) - n + 1)
    out = np.full(size, n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * _STEP + hashes[j : j + size]
    return mix(out)


def shingle_rows(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per row the hashes of its ``n``-word shingles in order; a shorter row is one shingle, a row without words none."""
    for _, hashes, words in chunks(column):
        folded = fold_words(hashes, n)
        for a, b in zip(words[:-1], words[1:]):
            if b - a >= n:
                yield folded[a : b - n + 1]
            else:
                yield fold_words(hashes[a:b], b - a) if b > a else folded[:0]
