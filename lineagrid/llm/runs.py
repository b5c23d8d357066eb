"""Runs of words that repeat with a period, by internal pattern matching.

A run of period q, at least four periods long, holds for the k with 2**k <= q < 2**(k + 1) a block of 2**k words that
begins at a multiple of 2**k, and the block again q and 2q words on.  So, for each k:

1. Prefix doubling orders the suffixes of a chunk of whole texts by their first 2**k words: a block's occurrences are one
   interval of the suffix array.  Suffixes that are alone in their interval are left out of all that follows.
2. Each block asks a wavelet tree over the suffix array for its next occurrences in the neighbouring window
   [2**k, 2**(k + 1)) words on, half of the window at a time (range successor).  Occurrences in such a half that overlap
   form one arithmetic progression, its difference being the block's own period; the run of that period which the block
   lies in must end q words before the one which the progression lies in, so a progression has one candidate period.
3. A candidate is extended both ways by comparing named blocks, longest first, and kept if it is long enough.  Of equal
   stretches the smallest period counts.

All steps are whole-array operations over a chunk; a chunk has WORDS words or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of texts that are searched together.
WORDS = 1 << 18


class WaveletTree:
    """A wavelet tree of a sequence of distinct numbers, a level a bit, as stable partitions by the highest bit first."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(int(values.max()).bit_length(), 1) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            zero = (values >> bit) & 1 == 0
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are under the bound."""
        n = np.zeros(len(lo), np.int64)
        over = bound >> self.bits > 0
        for bit, count in zip(reversed(range(self.bits)), self.zeros, strict=True):
            a, z = count[lo], count[hi]
            one = (bound >> bit) & 1 == 1
            n += np.where(one, z - a, 0)
            lo, hi = np.where(one, count[-1] + lo - a, a), np.where(one, count[-1] + hi - z, z)
        return np.where(over, -1, n)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of values[lo:hi], which has more than k."""
        out = np.zeros(len(lo), np.int64)
        for bit, count in zip(reversed(range(self.bits)), self.zeros, strict=True):
            a, z = count[lo], count[hi]
            one = k >= z - a
            k = np.where(one, k - (z - a), k)
            out |= np.where(one, 1 << bit, 0)
            lo, hi = np.where(one, count[-1] + lo - a, a), np.where(one, count[-1] + hi - z, z)
        return out

    def successors(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest of values[lo:hi] that is ``least`` or more and the one after it; -1 where there is none."""
        k = self.below(lo, hi, least)
        k = np.where(k < 0, hi - lo, k)
        out = []
        for rank in (k, k + 1):
            there = np.flatnonzero(rank < hi - lo)
            found = np.full(len(lo), -1, np.int64)
            found[there] = self.smallest(lo[there], hi[there], rank[there])
            out.append(found)
        return out[0], out[1]


class Names:
    """names[k][i] equals names[k][j] just if the 2**k words at i and at j are equal and of one text.

    ``order`` is the suffix array of the places whose first two words occur again in their text; with k >= 1, the name of
    such a place is where the interval of those that begin with the same 2**k words starts.  at[k] are the places whose
    interval has more than one, and size[k] the intervals' sizes.
    """

    def __init__(self, ids: np.ndarray, longest: int) -> None:
        n = len(ids)
        self.n, self.names, self.at, self.size = n, [np.append(ids, -1)], [np.arange(n)], [np.zeros(0, np.int64)]
        self.order = np.zeros(0, np.int64)
        slots, width = np.arange(n), 1
        while len(slots) and width < longest:
            old, at = self.names[-1], self.at[-1]
            key = old[at] * (2 * n + 2) + old[np.minimum(at + width, n)] + 1
            by = np.argsort(key, kind="stable")
            key, at = key[by], at[by]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(begin, append=len(key))
            again = np.repeat(size > 1, size)
            if width == 1:
                self.order, slots = at[again], np.arange(int(again.sum()))
                at = self.order
                begin, size = np.cumsum(size[size > 1]) - size[size > 1], size[size > 1]
                again = np.ones(len(at), bool)
            else:
                self.order[slots] = at
            # Names of places that were alone before are their place after all intervals' names.
            new = np.append(n + np.arange(n), -1)
            new[self.order] = np.arange(len(self.order))
            new[at] = np.repeat(slots[begin], size)
            size = np.repeat(size, size)
            self.names.append(new)
            self.at.append(at[again])
            self.size.append(size[again])
            slots = slots[again]
            width *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal (i < j)."""
        i, j, began = i.copy(), j.copy(), i
        for k in reversed(range(len(self.names))):
            while True:
                same = self.names[k][i] == self.names[k][j]
                same &= j < self.n
                if not same.any():
                    break
                i += same << k
                j = np.minimum(j + (same << k), self.n)
        return i - began

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are equal (i < j)."""
        i, j, began = i.copy(), j.copy(), i
        for k in reversed(range(len(self.names))):
            while True:
                same = (i >> k > 0) & (self.names[k][np.maximum(i - (1 << k), 0)] == self.names[k][np.maximum(j - (1 << k), 0)])
                if not same.any():
                    break
                i -= same << k
                j -= same << k
        return began - i


def runs_of(ids: np.ndarray, longest: int, least: int, periods: int) -> np.ndarray:
    """(start, end, period) rows of the runs, sorted; ids are equal for equal words of one text only, no text longer than given."""
    names = Names(ids, longest)
    found = []
    tree = WaveletTree(names.order)
    for k in range(1, len(names.names)):
        block = 1 << k
        if block * periods > longest and k > 1:
            break
        here = (names.at[k] & (block - 1) == 0) & (names.size[k] > 2)
        s, size = names.at[k][here], names.size[k][here]
        name = names.names[k]
        lo = name[s]
        windows = [(1, 1), (2, 1), (3, 1)] if k == 1 else [(block, block // 2), (block + block // 2, block // 2)]
        for away, width in windows:
            first, second = tree.successors(lo, lo + size, s + away)
            hit = (first >= 0) & (first < s + away + width)
            of, f, g = s[hit], first[hit], second[hit]
            d = f - of
            many = np.flatnonzero((g >= 0) & (g < of + away + width))
            if len(many):
                own = g[many] - f[many]
                d[many] += names.ahead(f[many], g[many]) - names.ahead(of[many], of[many] + own)
            fits = (d >= away) & (d < away + width)
            of, d = of[fits], d[fits]
            twice = of + 2 * d < names.n
            of, d = of[twice], d[twice]
            there = (name[of] == name[of + d]) & (name[of] == name[of + 2 * d])
            of, d = of[there], d[there]
            if len(of):
                start = of - names.behind(of, of + d)
                end = of + d + names.ahead(of, of + d)
                long = end - start >= np.maximum(least, periods * d)
                found.append(np.stack([start[long], end[long], d[long]], 1))
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    same = np.zeros(len(runs), bool)
    same[1:] = (runs[1:, :2] == runs[:-1, :2]).all(1)
    return runs[~same]


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of successive texts, in chunks."""
    chunk, n = [], 0
    for x in texts:
        words = x.as_buffer().to_pybytes().split() if x.is_valid else []
        chunk.append(words)
        n += len(words)
        if n >= WORDS:
            yield chunk
            chunk, n = [], 0
    if chunk:
        yield chunk


def _search(chunk: list[list[bytes]], least: int, periods: int) -> Iterator[tuple[list[dict], bytes]]:
    """Each text's runs and its words without what runs repeat."""
    ids, base = [], 0
    for words in chunk:
        seen: dict[bytes, int] = {}
        ids.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + base)
        base += len(seen)
    bounds = np.cumsum([0, *map(len, ids)])
    runs = runs_of(np.concatenate(ids), max(map(len, ids)), least, periods)
    begin = np.searchsorted(runs[:, 0], bounds)
    for r, words in enumerate(chunk):
        own = runs[begin[r] : begin[r + 1]] - [bounds[r], bounds[r], 0]
        if len(own):
            # A run's words after its first period are dropped; runs may overlap.
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        yield [{"start": s, "length": e - s, "period": p} for s, e, p in own[np.lexsort((own[:, 2], own[:, 0]))].tolist()], b" ".join(words)


def collapse_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 6, periods: int = 4) -> DataFrame:
    """(key, n_words, runs, collapsed), one row for each row of docs.

    A run is a stretch of words (split at ASCII white space; as they are written) with smallest period q, of ``least`` words
    (5 at least) and ``periods`` q (4 at least) or more, that no neighbouring word extends.  runs lists (start, length,
    period) by start, then period; collapsed are the words that no run holds after its first q, with one space between.
    A null, empty or white text has no words, no runs and an empty collapsed text.
    """
    if least < 5 or periods < 4:
        raise ValueError("runs under 5 words or 4 periods can hold no block three times")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            at = 0
            for chunk in _chunks(batch.column(1)):
                found, left = zip(*_search(chunk, least, periods), strict=True)
                columns = [batch.column(0).slice(at, len(chunk)), pa.array([len(w) for w in chunk], pa.int64()), pa.array(found, run), pa.array(left, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "runs", "collapsed"])
                at += len(chunk)

    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(make, f"key {kind}, n_words long, runs array<struct<start long, length long, period long>>, collapsed string")
    return out.withColumnRenamed("key", key)


def longest_run(runs: Column) -> Column:
    """The struct of the longest run; of equal ones the first to start, then of the smallest period; null without runs."""
    best = F.array_max(F.transform(runs, lambda x: F.struct(x["length"], -x["start"], -x["period"])))
    return F.when(F.size(runs) > 0, F.struct((-best["col2"]).alias("start"), best["length"].alias("length"), (-best["col3"]).alias("period")))
