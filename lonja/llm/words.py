"""Hashes of words and word n-grams, vectorised over many texts at once.

A word is a maximal run of ASCII letters and digits and of non-ASCII characters in the lower-cased text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator: a bijection that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * _GOLDEN)


@dataclass
class Shapes:
    """Words of mixed case and the other visible ASCII characters (marks) of many texts.

    ``case`` of a word: 0 without capitals, 1 with a capital first letter only, 2 in capitals, 3 other. Hashes
    do not depend on ASCII case.
    """

    data: np.ndarray
    texts: int
    starts: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray
    case: np.ndarray
    marks: np.ndarray
    mark_rows: np.ndarray


#: Whether a byte belongs to a word, and the value of a byte in a hash. Plain arrays travel to the workers with the
#: functions that use them; a cached function would be looked up in the package, which workers need not have.
_INSIDE = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789")) | (np.arange(256) >= 128)
_VALUES = stream(1, 256)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15 | 1
    up, down = np.full(n, U64(base)), np.full(n, U64(pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hasher:
    """Word hashes of texts; keeps the powers for the longest input so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word and the n + 1 word offsets of the texts, for lower-cased UTF-8 bytes."""
        n = len(data)
        if n == 0:
            return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
        if len(self.up) < n + 1:
            self.up, self.down = _powers(n + 1)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = _INSIDE[data]
        # Where one text touches the next, a word ends and another may begin.
        touch = offsets[1:-1]
        touch = touch[(touch > 0) & (touch < n)]
        first = inside[1:-1] & ~inside[:-2]
        first[touch] |= inside[1:-1][touch]
        last = inside[1:-1] & ~inside[2:]
        last[touch - 1] |= inside[1:-1][touch - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, U64)
        weighted = _VALUES[data]
        weighted *= self.up[:n]
        np.cumsum(weighted, out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.down[starts])
        return hashes, np.searchsorted(starts, offsets)


    def shapes(self, data: np.ndarray, offsets: np.ndarray) -> Shapes:
        """The same for texts of mixed case, with the case of each word and all other visible characters."""
        small = data | (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
        hashes, at = self.words(small, offsets)
        texts = len(offsets) - 1
        rows = np.repeat(np.arange(texts), np.diff(at))
        if not len(data):
            none = np.zeros(0, np.int64)
            return Shapes(data, texts, none, hashes, rows, none, none, none)
        inside = _INSIDE[small]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        touch = offsets[1:-1]
        touch = touch[(touch > 0) & (touch < len(data))]
        first[touch] |= inside[touch]
        starts = np.flatnonzero(first)
        # Latin capitals beyond ASCII are C3 80 to C3 9E.
        capital = data != small
        capital[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        # Continuation bytes are not letters of their own.
        letter = inside & ((data & 0xC0) != 0x80) & ~((data >= 48) & (data <= 57))
        upper = np.add.reduceat(capital.astype(np.int32), starts) if len(starts) else np.zeros(0, np.int32)
        every = np.add.reduceat(letter.astype(np.int32), starts) if len(starts) else np.zeros(0, np.int32)
        case = np.full(len(starts), 3)
        case[upper == 0] = 0
        case[(upper == 1) & capital[starts]] = 1
        case[(upper > 1) & (upper == every)] = 2
        marks = np.flatnonzero((data > 32) & (data < 127) & ~inside)
        return Shapes(data, texts, starts, hashes, rows, case, marks, np.searchsorted(offsets, marks, side="right") - 1)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def shingles(words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words in text order, and the n + 1 offsets of the texts.

    A text with fewer words has one shingle, of all its words; a text without words has none.
    """
    counts = np.diff(at)
    sizes = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(sizes)])
    if len(words) == 0:
        return np.zeros(0, U64), out
    k = U64(0xD6E8FEB86659FD93)
    padded = np.concatenate([words, np.zeros(length, U64)])
    total = padded[: len(words)].copy()
    for step in range(1, length):
        total = total * k + padded[step : step + len(words)]
    owner = np.repeat(np.arange(len(counts)), counts)
    keep = np.arange(len(words)) + length <= at[1:][owner]
    short = np.flatnonzero((counts > 0) & (counts < length))
    for text in short:
        value = U64(counts[text])
        for word in words[at[text] : at[text + 1]]:
            value = value * k + word
        total[at[text]] = value
    keep[at[short]] = True
    return mix(total[keep]), out


def unique_in_rows(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each row: ``values, row of each value, offsets``."""
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[first], rows[first]
    return values, rows, np.searchsorted(rows, np.arange(len(at)))
