"""Benchmark decontamination by spaced seeds.

Fixed masks over ``span`` words ignore some positions, so a window with a substituted word still has the hash of the
original under a mask that ignores it.  The hashes of the benchmark's windows are an index of bounded size that is sent
to every task; a benchmark beyond the bound is taken in blocks, each against all documents.  Tasks hash the windows of
whole documents in a vectorised pass, look them up, and verify each hit along its diagonal: word by word, allowing
substitutions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .textvec import LETTERS_DIGITS, U, chunks, hash_words, mix

#: Fixed masks by the words of a window (an item's, from 5 to 13; shorter items are compared whole): 1 compares a word, 0 ignores it.  Wherever words are
#: substituted with 75 % of the window left equal, one mask of its family still fits somewhere inside the window.
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("11011", "1111", "1100011"),
    9: ("111011", "1001111", "11010011", "111101"),
    10: ("111011", "11010011", "11111"),
    11: ("1110111", "111001011", "1011111", "111111"),
    12: ("111011", "110100011", "11001011", "110111"),
    13: ("11101011", "1100100111", "111111", "1011000111", "111000101001", "11101101"),
}
_WORD = LETTERS_DIGITS != 0x20
_STEP = mix(np.arange(1, 65, dtype=U)) | U(1)


def window_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of each window of len(mask) words, made of the words that the mask compares."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U)
    h = np.full(n, hash_of_mask(mask), U)
    for i, bit in enumerate(mask):
        if bit == "1":
            h = h + words[i : i + n] * _STEP[i]
    return mix(h)


def hash_of_mask(mask: str) -> int:
    return int(mask, 2) * 64 + len(mask)


class Index:
    """Window hashes of some benchmark items with their places, and the items' words."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.ids, self.words = [], []
        hashes, item, place = [], [], []
        self.masks: list[str] = []
        for i, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            w = hash_words(data, np.array([0, len(data)]), 0, _WORD, LETTERS_DIGITS).hash
            if len(w) < least:
                continue
            own = MASKS.get(min(len(w), max(MASKS)), ("1" * len(w),))
            self.masks += [m for m in own if m not in self.masks]
            for m in own:
                h = window_hashes(w, m)
                hashes.append(h)
                item.append(np.full(len(h), len(self.ids)))
                place.append(np.arange(len(h)))
            self.ids.append(i)
            self.words.append(w)
        if hashes:
            h = np.concatenate(hashes)
            order = np.argsort(h, kind="stable")
            self.hashes, self.item, self.place = h[order], np.concatenate(item)[order], np.concatenate(place)[order]
        else:
            self.hashes, self.item, self.place = np.zeros(0, U), np.zeros(0, int), np.zeros(0, int)
        self.bits = max(16, math.ceil(math.log2(len(self.hashes) + 1)) + 4)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.hashes >> U(64 - self.bits)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, row_of: np.ndarray) -> np.ndarray:
        """Distinct (row, item, diagonal) of windows inside one row whose hash is indexed; diagonals count words of the chunk."""
        found = []
        for m in self.masks:
            h = window_hashes(words, m)
            if not len(h):
                continue
            at = np.flatnonzero(self.maybe[(h >> U(64 - self.bits)).astype(np.int64)])
            at = at[row_of[at] == row_of[at + len(m) - 1]]
            lo, hi = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
            n = hi - lo
            of = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, int)
            start = np.repeat(at, n)
            found.append(np.stack([row_of[start], self.item[of], start - self.place[of]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), int)


def overlap(item: np.ndarray, words: np.ndarray, diagonal: int, lo: int, hi: int, width: int, percent: int) -> tuple[int, int]:
    """(matching words, first one's place) of the item laid at diagonal within words[lo:hi].

    Matching words count inside windows of ``width`` words (the item's length, if less) of which ``percent`` per cent
    match; with no such window, 0.
    """
    a, z = max(lo, diagonal), min(hi, diagonal + len(item))
    same = words[a:z] == item[a - diagonal : z - diagonal]
    width = min(width, len(item))
    percent = percent if len(item) >= min(MASKS) else 100
    if len(same) < width:
        return 0, -1
    total = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(100 * (total[width:] - total[:-width]) >= percent * width)
    if not len(good):
        return 0, -1
    inside = np.zeros(len(same) + 1, int)
    np.add.at(inside, good, 1)
    np.add.at(inside, good + width, -1)
    covered = np.flatnonzero(same & (np.cumsum(inside)[:-1] > 0))
    return len(covered), int(a - lo + covered[0])


def leaks(slim: DataFrame, index: Index, width: int, percent: int) -> DataFrame:
    """(rk, item, matched, at) of verified overlaps of (rk, _text) with the index."""
    sent = slim.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            keys = batch.column(0)
            out: dict[tuple[int, int], tuple[int, int]] = {}
            for c in chunks(batch.column(1), 1 << 20, _WORD, LETTERS_DIGITS):
                row_of = np.repeat(np.arange(c.n), np.diff(c.bound))
                for row, item, diagonal in index.hits(c.hash, row_of).tolist():
                    got = overlap(index.words[item], c.hash, diagonal, c.bound[row], c.bound[row + 1], width, percent)
                    if got[0] > out.get((c.first + row, item), (0, 0))[0]:
                        out[c.first + row, item] = got
            if out:
                rows = pa.array([r for r, _ in out])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(rows), pa.array([index.ids[i] for _, i in out], pa.int64()), pa.array([v[0] for v in out.values()], pa.int64()), pa.array([v[1] for v in out.values()], pa.int64())],
                    names=["rk", "item", "matched", "at"],
                )

    return slim.mapInArrow(find, "rk long, item long, matched long, at long")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    least: int = 1,
    width: int = 13,
    percent: int = 75,
    block_words: int = 500_000,
) -> DataFrame:
    """(rk, item_id, matched, at): each document's overlap with each benchmark item that it repeats.

    rk is ``xxhash64(key, text)`` of a row; rows that repeat both have their findings once.  Words are runs of letters
    and digits, A-Z lower-cased.  An overlap is a window of ``width`` words of an item (all of a shorter one) of which
    ``percent`` per cent stand at the same places in the document (all, of items under 5 words); ``at`` is the word where
    it begins.  Items of fewer than ``least`` words, null ones and ones without words included, match nothing.  Items with equal texts all count;
    null item keys are left out.  The benchmark is read in blocks of about ``block_words`` words.
    """
    slim = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("rk"), F.col(text).alias("_text"))
    items = benchmark.select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("t")).where("item is not null and t is not null")
    texts = stored(items.groupBy("t").agg(F.min("item").alias("rep"), F.collect_set("item").alias("items"), F.max(F.size(F.split("t", r"\s+"))).alias("w")), "benchmark")
    total = texts.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_words))
    found = None
    for b in range(blocks):
        block = texts.where(F.pmod(F.xxhash64("rep", "t"), F.lit(blocks)) == b).select("rep", "t").toLocalIterator()
        part = leaks(slim, Index([(r.rep, r.t) for r in block], least), width, percent)
        found = part if found is None else found.union(part)
    names = texts.select(F.col("rep").alias("item"), F.explode("items").alias("item_id"))
    best = stored(found.groupBy("rk", "item").agg(F.max(F.struct("matched", "at")).alias("x")).join(names, "item").select("rk", "item_id", "x.matched", "x.at"), "leaks")
    return best


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every row of docs with leaked_items (sorted ids), leaked_words (of the largest overlap) and kept.

    ``options`` are those of :func:`find_leaks`.  A row is kept if it repeats no item; a null or empty text is kept.
    Columns of docs with the added names are replaced.
    """
    docs = docs.drop("leaked_items", "leaked_words", "kept")
    found = find_leaks(docs, benchmark, key=key, text=text, **options)
    by_row = found.groupBy(F.col("rk").alias("_rk")).agg(F.array_sort(F.collect_set("item_id")).alias("leaked_items"), F.max("matched").alias("leaked_words"))
    out = docs.withColumn("_row", F.xxhash64(F.col(key), F.col(text))).join(by_row, F.col("_row") == F.col("_rk"), "left")
    return (
        out.withColumn("kept", F.col("_rk").isNull())
        .withColumn("leaked_items", F.coalesce("leaked_items", F.array().cast("array<bigint>")))
        .withColumn("leaked_words", F.coalesce("leaked_words", F.lit(0).cast("long")))
        .drop("_row", "_rk")
    )
