"""Whole Arrow batches of text as NumPy arrays of word hashes, without a Python loop over words.

A batch is cut into chunks of about a megabyte (one text at least, never part of one).  Word hashes are differences of
prefix sums of a byte-wise polynomial modulo 2**64, so one pass over the bytes hashes every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters (A-Z as a-z), digits and bytes of other scripts make words; ASCII punctuation separates like white space.
LETTERS_DIGITS = np.full(256, 0x20, np.uint8)
LETTERS_DIGITS[48:58] = np.arange(48, 58)
LETTERS_DIGITS[65:91] = np.arange(97, 123)
LETTERS_DIGITS[97:123] = np.arange(97, 123)
LETTERS_DIGITS[128:] = np.arange(128, 256)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, 1 << 20), base, U)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, 256, dtype=U)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_BYTE = byte_values(20240229)


@dataclass
class Chunk:
    """Rows first..first+n of a batch; word i has hash[i] and spans bytes start[i]:end[i] of data."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Words of row r: hash[bound[r]:bound[r + 1]].
    bound: np.ndarray


def hash_words(data: np.ndarray, offsets: np.ndarray, first: int = 0, word: np.ndarray = _WORD, fold: np.ndarray = _LOWER, cut: np.ndarray | None = None, values: np.ndarray = _BYTE) -> Chunk:
    """Hash the words of one chunk; ``word`` says which bytes make words, ``fold`` what each byte counts as, ``cut`` before
    which bytes a word ends; other ``values`` of bytes give other hashes."""
    n = len(data)
    is_word = word[data]
    head, tail = is_word.copy(), is_word.copy()
    head[1:] &= ~is_word[:-1]
    tail[:-1] &= ~is_word[1:]
    if cut is not None:
        head |= is_word & cut
        tail[:-1] |= is_word[:-1] & cut[1:]
    full = offsets[1:] > offsets[:-1]
    a, z = offsets[:-1][full], offsets[1:][full] - 1
    head[a] = is_word[a]
    tail[z] = is_word[z]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    power, inverse = _power(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(values[fold][data] * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start])
    return Chunk(first, len(offsets) - 1, data, offsets, h, start, end, np.searchsorted(start, offsets))


def byte_chunks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of parts of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        to = min(to, len(column))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def chunks(column: pa.Array, size: int = 1 << 20, word: np.ndarray = _WORD, fold: np.ndarray = _LOWER) -> Iterator[Chunk]:
    for at, data, offsets in byte_chunks(column, size):
        yield hash_words(data, offsets, at, word, fold)


_STEP = np.random.default_rng(5).integers(0, 2**63, 64, dtype=U) * U(2) + U(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash for each k-word window; the whole sequence as one where it is shorter; nothing for no words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U)
    width = min(k, n)
    h = np.full(n - width + 1, U(width), U)
    for i in range(width):
        h = h + words[i : n - width + 1 + i] * _STEP[i]
    return mix(h)
