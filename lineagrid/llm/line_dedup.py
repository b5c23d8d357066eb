"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, edit similarity, connected groups.

1. Lines are normalised (letters A-Z lower-cased, ASCII punctuation and white space as one separator) and get a 64-bit
   id; equal lines of any length, one word or more, fall together by a sum per id.
2. The words of a line of ``min_words`` words or more are dealt by their hashes to the blocks of a SimHash; a word votes
   on the bits of its own block only, so a changed word leaves the other blocks as they were, wherever it stands.  Lines
   that share enough whole blocks meet: 3 of 6 for short lines, 2 of 8 for middling ones, 1 of as many as a line has room
   for where it is long.  Each character of a script without spaces counts as a word.
3. A line's keys, one for each choice of blocks with words enough, are sent in packed rows to buckets of about equal size;
   keys of one line only, nearly all, end there.
4. The lines of a short list are all compared with each other.  Those of a longer one are compared with a member of its
   largest group, which links most of any large group, then across what is still apart in the list: in the task that
   has the list, or in tasks that have a tile each of one too large.  Their pairs are verified in packs with their texts.
   Lines of which more than ``distance`` bits of a second SimHash differ (of 240; chance makes 120, of texts with common words 90) or whose lengths rule it out
   aren't compared.  The edit similarity of the normalised lines (Levenshtein over the longer length) decides.
5. The first occurrence of each connected group stays, in order of document key and line number; the others go.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .minhash import BROADCAST_IDS
from .shared import forget, stored
from .textvec import LETTERS_DIGITS, Chunk, U, byte_chunks, hash_words, mix

#: Up to so many documents that lose lines (8 lines each on average, under 32 MB) their line numbers are broadcast; else joined.
BROADCAST_ROWS = 300_000
#: (blocks, blocks of a key, letters a key needs, fewest words, most words) of short and middling lines; words under 4
#: letters don't count as letters.  Long lines have 16, 32, 64, ... blocks, one a key, from 1.5 to 5 words a block.
FAMILIES = ((6, 3, 7, 5, 12), (8, 2, 12, 8, 48))
LONG_BLOCKS, LONG_LETTERS, FEWEST, MOST = 16, 16, 1.5, 5
#: Postings of a packed bucket, and lines under one key in one part from which they don't go to the key's bucket.
BUCKET, HOT = 1 << 20, 32
#: Lines of a list up to which all its lines meet at once, and up to which one task compares a list or a tile of one.
LISTED, LARGE = 32, 1 << 14
#: Pairs that are compared together, some seconds of one task, and the lines and characters that they have at most.
PACKED, PACKED_LINES, PACKED_CHARS = 1 << 14, 1 << 13, 1 << 25
#: Pairs whose distances are counted side by side, for each block of 64 letters from which it is worth it, and the longest.
STACK, WORTH, STACKED = 1 << 10, 8, 1 << 12
#: Members that a longer list's lines are tried against before all that are still apart meet.
TURNS = 1
#: (words of one line, words of the other, equal words then) that an alignment tries to skip where they differ, nearest first.
SKIPS = sorted(((i, j, n) for i in range(5) for j in range(5) for n in (1, 2) if i or j), key=lambda x: (-x[2], max(x[:2]), abs(x[0] - x[1])))
#: Characters up to which and from which two lines are compared whatever their sketches: few words, or more than lanes hold.
SHORT_LINE, LONG_LINE = 80, 1 << 16
#: Characters from which the sketch, of more words, gets by with 8 bits less.
LONGER_LINE = 300
SIMS = ("sim0", "sim1", "sim2", "sim3")
SIDE = ("lid", "size", *SIMS)
_WORD = LETTERS_DIGITS != 0x20
_FOLD = LETTERS_DIGITS.tobytes()
_STEP = 0xD6E8FEB86659FD93


#: CJK and full-width punctuation, which separates too.
_WIDE = re.compile(rb"\xe3\x80[\x80-\x84\x88-\xa0\xb0]|\xef\xbc[\x81-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]")


def normalised(line: bytes) -> str:
    return b" ".join(_WIDE.sub(b" ", line).translate(LETTERS_DIGITS.tobytes()).split()).decode("utf-8", "replace")


def folded(data: np.ndarray) -> np.ndarray:
    """What each byte counts as, wide punctuation included."""
    out = np.frombuffer(bytearray(data.tobytes().translate(_FOLD)), np.uint8)
    if len(data) and data.max() >= 0xE3:
        for m in _WIDE.finditer(data.tobytes()):
            out[m.start() : m.end()] = 0x20
    return out


def unspaced_cuts(data: np.ndarray) -> np.ndarray | None:
    """Where a word begins because a character of a script without spaces does, or ends before it; None for no such text."""
    if not len(data) or data.max() < 0xE0:
        return None
    after = np.append(data[1:], np.uint8(0))
    # Kana and Han; Thai and Lao; Myanmar; Khmer; Han beyond the basic plane.
    begins = ((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xE0) & (after >= 0xB8) & (after <= 0xBB))
    begins |= (data == 0xE1) & (((after >= 0x80) & (after <= 0x82)) | (after == 0x9E) | (after == 0x9F))
    begins |= (data == 0xF0) & (after >= 0xA0)
    cut = begins.copy()
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    cut[chars[1:]] |= begins[chars[:-1]]
    return cut


def line_words(data: np.ndarray, offsets: np.ndarray) -> tuple[Chunk, np.ndarray, np.ndarray]:
    """The words of one chunk by lines, and each line's row and number in it."""
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)  # an empty text's start may be the next one's too
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, offsets[row])
    data = folded(data)
    return hash_words(data, np.append(starts, len(data)), 0, _WORD, LETTERS_DIGITS, unspaced_cuts(data)), row, number


def line_ids(c: Chunk) -> np.ndarray:
    """The word hashes times powers of an odd number, by position in the line."""
    count = np.diff(c.bound)
    if not len(c.hash):
        return np.zeros(len(count), U)
    place = np.arange(len(c.hash)) - np.repeat(c.bound[:-1], count)
    steps = np.multiply.accumulate(np.full(int(count.max()), _STEP, U))
    whole = np.zeros(len(c.hash) + 1, U)
    np.cumsum(c.hash * steps[place], out=whole[1:])
    return mix(whole[c.bound[1:]] - whole[c.bound[:-1]] + count.astype(U))


class Lanes:
    """Sums of bits, several side by side in one float64 of 53 exact bits: a sum of ``width`` bits for each of ``bits`` bits."""

    def __init__(self, bits: int, width: int):
        self.bits, self.width = bits, width
        values = np.arange(1 << bits)
        self.of = sum(((values >> j) & 1).astype(np.float64) * 2.0 ** (width * j) for j in range(bits))
        self.ones = sum(1 << (width * j) for j in range(bits))
        self.half = 1 << (width - 1)

    def majority(self, words: np.ndarray, shift: int, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each group the bits, spread over the lanes' upper ends, that more than half of its words have."""
        part = ((words >> U(shift)) & U((1 << self.bits) - 1)).astype(np.int64)
        sums = np.bincount(at, weights=self.of[part], minlength=len(size)).astype(np.int64)
        lift = (self.half - 1 - np.minimum(size >> 1, self.half - 1)) * self.ones
        return (sums + lift).astype(U) & U(self.ones * self.half)


_BLOCK, _SKETCH = Lanes(8, 6), Lanes(5, 10)


def dealt(words: np.ndarray, line: np.ndarray, lines: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words hashed anew for this number of blocks, the block that each is dealt to, and the words of each block."""
    h = mix(words + U(blocks))
    at = line * blocks + ((h >> U(40)) * U(blocks) >> U(24)).astype(np.int64)
    return h, at, np.bincount(at, minlength=lines * blocks)


def weighty_letters(c: Chunk) -> np.ndarray:
    """The bytes of each word that tells lines apart: of 4 letters or more, or a character of a script without spaces; else 0."""
    length = c.end - c.start
    lone = (length == 3) & (c.data[c.start] >= 0xE0) if len(length) else length
    return np.where((length >= 4) | lone, length, 0)


def line_keys(c: Chunk, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of each choice of blocks with letters enough, of lines of ``min_words`` words or more."""
    count = np.diff(c.bound)
    letters = weighty_letters(c).astype(float)
    line_of = np.repeat(np.arange(len(count)), count)
    families, blocks = list(FAMILIES), LONG_BLOCKS
    while len(count) and FEWEST * blocks <= count.max():
        families.append((blocks, 1, LONG_LETTERS, FEWEST * blocks, MOST * blocks))
        blocks *= 2
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for blocks, chosen, least, lo, hi in families:
        of = np.flatnonzero((count >= max(min_words, lo)) & (count < hi))
        if not len(of):
            continue
        seat = np.full(len(count), -1)
        seat[of] = np.arange(len(of))
        inside = np.flatnonzero(seat[line_of] >= 0)
        h, at, size = dealt(c.hash[inside], seat[line_of[inside]], len(of), blocks)
        held = np.bincount(at, weights=letters[inside], minlength=len(size)).reshape(-1, blocks)
        bits = size.astype(U)
        for shift in (0, 8, 16, 24):
            bits = bits * U(_STEP) + _BLOCK.majority(h, shift, at, size)
        bits = bits.reshape(-1, blocks)
        choices = np.array(list(itertools.combinations(range(blocks), chosen)))
        some, n = np.nonzero(held[:, choices].sum(2) >= least)
        key = (1_000_003 * blocks + n).astype(U)
        for i in range(chosen):
            key = mix(key + bits[some, choices[n, i]])
        rows.append(of[some])
        keys.append(key)
    return np.concatenate(rows), np.concatenate(keys)


def sketches(c: Chunk) -> list[np.ndarray]:
    """A second SimHash of every line in four parts of 60 bits: 8 blocks of 30 bits, of words that tell lines apart."""
    count = np.diff(c.bound)
    some = weighty_letters(c) > 0
    h, at, size = dealt(c.hash[some], np.repeat(np.arange(len(count)), count)[some], len(count), 8)
    bits = np.zeros(len(size), U)
    for k in range(6):
        # Lanes end at bits 9, 19, ...: five of them moved to bits k, k + 6, ... of the block's 30.
        spread = _SKETCH.majority(h, 5 * k, at, size)
        for j in range(5):
            bits |= ((spread >> U(10 * j + 9)) & U(1)) << U(6 * j + k)
    bits = bits.reshape(-1, 8)
    return [(bits[:, i] << U(30) | bits[:, i + 1]).view(np.int64) for i in range(0, 8, 2)]


def sizes(c: Chunk) -> np.ndarray:
    """The characters of every normalised line: those of its words, and one between two stretches of words."""
    # A word that begins where the one before ends is of a script without spaces.
    spaced = np.ones(len(c.start), np.int64)
    spaced[1:] -= c.start[1:] == c.end[:-1]
    spaced[c.bound[:-1][np.diff(c.bound) > 0]] = 0
    if len(c.data) and c.data.max() >= 0x80:
        chars = np.zeros(len(c.data) + 1, np.int64)
        np.cumsum((c.data & 0xC0) != 0x80, out=chars[1:])
        spaced += chars[c.end] - chars[c.start]
    else:
        spaced += c.end - c.start
    total = np.concatenate([[0], np.cumsum(spaced)])
    return total[c.bound[1:]] - total[c.bound[:-1]]


def lines(docs: DataFrame) -> DataFrame:
    """(rk, key, line, lid, size, sim0, ... sim3) of the lines with words, from (rk, key, _text); size in characters of the normalised line."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in byte_chunks(batch.column(2)):
                c, row, number = line_words(data, offsets)
                some = np.flatnonzero(np.diff(c.bound))
                made = [number[some].astype(np.int32), line_ids(c)[some].view(np.int64), sizes(c)[some].astype(np.int32), *(s[some] for s in sketches(c))]
                at = pa.array(first + row[some])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, made)], names=["rk", "key", "line", "lid", "size", *SIMS])

    return docs.mapInArrow(make, f"rk long, key {docs.schema['key'].dataType.simpleString()}, line int, lid long, size int, {', '.join(f'{x} long' for x in SIMS)}")


def edit_distance(a: str, b: str, limit: int | None = None) -> int:
    """Levenshtein distance by bit-parallel columns over the part between the common ends; more than the limit once it is known to be."""
    if a == b:
        return 0
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if len(a) > len(b):
        a, b = b, a
    if limit is None:
        limit = len(b)
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for k, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    # The diagonal that ends in the last cell never falls; it starts below as many columns as b is longer.
    at = len(a) - len(b)
    score = -at
    up, down = full, 0
    for ch in b:
        eq = where.get(ch, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        if at >= 0 and not diagonal >> at & 1:
            score += 1
            if score > limit:
                break
        at += 1
        right, left = down | (full & ~(diagonal | up)), up & diagonal
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down = left | (full & ~(diagonal | right)), right & diagonal
    return score


def words_align(a: list[str], b: list[str], limit: int) -> bool:
    """Whether an alignment of words, found by going on where two of them or one equal again, shows a distance up to the limit."""
    i = j = cost = 0
    skipped = []
    while True:
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j = i + 1, j + 1
        if i == len(a) and j == len(b):
            break
        for x, y, same in SKIPS:
            if a[i + x : i + x + same] == b[j + y : j + y + same] != []:
                break
        else:
            x, y = len(a) - i, len(b) - j
        # What is skipped is rewritten; where one side has no words there, with a separator each.
        old, new = " ".join(a[i : i + x]), " ".join(b[j : j + y])
        cost += max(len(old), len(new)) + (not x or not y)
        if cost > 2 * limit:
            return False
        skipped.append((old, new))
        i, j = i + x, j + y
    return cost <= limit or sum(edit_distance(x, y) + (not x or not y) for x, y in skipped) <= limit


def similar(a: str, b: str, percent: int) -> bool:
    most = max(len(a), len(b))
    limit = (100 - percent) * most // 100
    if abs(len(a) - len(b)) > limit:
        return False
    return words_align(a.split(" "), b.split(" "), limit) or edit_distance(a, b, limit) <= limit


def within(a: list[str], b: list[str], limit: np.ndarray) -> np.ndarray:
    """Which pairs, none longer apart than its limit and no text empty, have a Levenshtein distance up to it.

    Bit-parallel columns of all pairs at once, in blocks of 64 rows near the diagonal.  Pairs that are over, as the
    diagonal which ends in the last cell never falls, are left out every 32 columns.
    """
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    order = np.argsort(n, kind="stable")
    a, b, m, n, limit = [a[i] for i in order], [b[i] for i in order], m[order], n[order], limit[order]
    blocks, rows, most = -(-int(m.max()) // 64), len(a), int(limit.max())
    letters, flat = np.unique(np.frombuffer("".join(a + b).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    out, of, wide = np.zeros(rows, bool), order, len(letters)
    if rows > 1 and blocks * rows * wide > 1 << 20:
        half = rows // 2
        out[order] = np.concatenate([within(a[:half], b[:half], limit[:half]), within(a[half:], b[half:], limit[half:])])
        return out
    pair = np.repeat(np.arange(rows), m)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
    # The places of each letter in a, by blocks of 64, summed as two halves of exact floats.
    halves = np.bincount(((at >> 5) * rows + pair) * wide + flat[: len(at)], 2.0 ** (at & 31), 2 * blocks * rows * wide).astype(U).reshape(blocks, 2, -1)
    equal = halves[:, 0] | halves[:, 1] << U(32)
    pair = np.repeat(np.arange(rows), n)
    codes = np.zeros((int(n[-1]), rows), np.int64)
    codes[np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n), pair] = flat[len(at) :]
    codes += np.arange(rows) * wide
    up, down = np.full((blocks, rows), ~U(0)), np.zeros((blocks, rows), U)
    score, last, go = np.full(rows, 64), 0, np.arange(rows)

    def cell(row: np.ndarray, part: slice) -> np.ndarray:
        # From the last row of the last block up to this one.
        value = score[part].copy()
        for k in range(int(row.min()) // 64, last + 1):
            beyond = np.where(row < 64 * k, ~U(0), ~U(0) << np.clip(row - 64 * k, 0, 63).astype(U) << U(1))
            value += np.bitwise_count(down[k, part] & beyond).astype(np.int64) - np.bitwise_count(up[k, part] & beyond)
        return value

    for t in range(len(codes)):
        if t % 32 == 31 and len(n):
            row = t - 1 + m - n
            keep = (row < 0) | (cell(np.maximum(row, 0), slice(None)) <= limit)
            if 4 * keep.sum() < 3 * len(keep):
                up, down, score, go, of, m, n, limit = up[:, keep], down[:, keep], score[keep], go[keep], of[keep], m[keep], n[keep], limit[keep]
        if not len(n):
            break
        first, final = max(0, t - most) // 64, min(blocks - 1, (t + most) // 64)
        score += 64 * (final - last)
        last = final
        # What enters from above grows by one a column: the first row, or what is too far from the diagonal.
        code, more, less = codes[t, go], np.ones(len(n), U), None
        for k in range(first, final + 1):
            eq, pv, mv = equal[k].take(code), up[k], down[k]
            xv = eq | mv
            if less is not None:
                eq |= less
            xh = eq & pv
            xh += pv
            xh ^= pv
            xh |= eq
            ph = xh | pv
            np.invert(ph, ph)
            ph |= mv
            xh &= pv
            above, below = more, less
            more, less = ph >> U(63), xh >> U(63)
            ph <<= U(1)
            ph |= above
            xh <<= U(1)
            if below is not None:
                xh |= below
            np.bitwise_and(ph, xv, mv)
            xv |= ph
            np.invert(xv, xv)
            np.bitwise_or(xh, xv, pv)
        score += more.view(np.int64)
        score -= less.view(np.int64)
        ended = int(np.searchsorted(n, t + 1, side="right"))
        if ended:
            part = slice(0, ended)
            out[of[part]] = cell(m[part] - 1, part) <= limit[part]
            rest = slice(ended, None)
            up, down, score, go, of, m, n, limit = up[:, rest], down[:, rest], score[rest], go[rest], of[rest], m[rest], n[rest], limit[rest]
    return out


def similar_pairs(a: list[str], b: list[str], percent: int) -> np.ndarray:
    """What :func:`similar` says of each pair, faster for many pairs of which most are refused: words aren't aligned first."""
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    high = np.maximum(n, m)
    limit = (100 - percent) * high // 100
    out = high <= limit
    left = np.flatnonzero(~out & (np.abs(n - m) <= limit) & (np.minimum(n, m) > 0))
    left = left[np.argsort(high[left], kind="stable")]
    at = 0
    while at < len(left):
        # Of like lengths, as columns are as many as the longest has letters.
        part = left[at : min(at + STACK, int(np.searchsorted(high[left], 3 * high[left[at]] // 2 + 16)))]
        at += len(part)
        longest, band = int(high[part[-1]]), int(limit[part].max()) // 32 + 2
        x, y = [a[i] for i in part], [b[i] for i in part]
        if len(part) < WORTH * min(band, longest // 64 + 1) or longest > STACKED:
            out[part] = [edit_distance(*of) <= of[2] for of in zip(x, y, limit[part].tolist(), strict=True)]
        else:
            out[part] = within(x, y, limit[part])
    # Two empty texts are equal; one has no letter in common with any other.
    return out | ((n == 0) & (m == 0))


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lid, norm) of the wanted (rk, line, lid), from (rk, key, _text)."""
    by_doc = wanted.groupBy("rk").agg(F.collect_list(F.struct("line", "lid")).alias("of"))
    few = wanted.count() <= BROADCAST_IDS

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for text, of in zip(batch.column(0), batch.column(1), strict=True):
                split = (text.as_py() or "").encode().split(b"\n")
                for x in of.as_py():
                    ids.append(x["lid"])
                    texts.append(normalised(split[x["line"]]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["lid", "norm"])

    found = docs.select("rk", "_text").join(F.broadcast(by_doc) if few else by_doc, "rk").select("_text", "of")
    made, rows = stored(found.mapInArrow(make, "lid long, norm string"), "line-texts"), wanted.count()
    # A row of docs that is there twice gives its lines twice.
    return made if made.count() == rows else stored(made.dropDuplicates(["lid"]), "line-texts")


def verified(edges: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose lines, of texts (lid, norm), reach the edit similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(x, y, percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # Few edges go to the texts, so that only theirs are shuffled.
    given = F.broadcast(edges) if edges.count() <= BROADCAST_IDS else edges
    left, right = (given.join(texts.withColumnRenamed("lid", x), x).withColumnRenamed("norm", f"norm_{x}") for x in "ab")
    return left.join(right, ["a", "b"]).select("a", "b", "norm_a", "norm_b").mapInArrow(check, "a long, b long")


def verified_in_packs(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """What :func:`verified` returns of pairs (a, b, size_a, size_b) of which those of a list follow each other.

    Pairs go with the lines they are of, each once a pack: a text is shuffled for each pack and not for each pair.
    """

    def packs_of(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> Iterator[pa.RecordBatch]:
        start, most = 0, PACKED
        while start < len(a):
            to = min(start + most, len(a))
            while True:
                ids, first, at = np.unique(np.concatenate([a[start:to], b[start:to]]), return_index=True, return_inverse=True)
                chars = int(np.concatenate([na[start:to], nb[start:to]])[first].astype(np.int64).sum())
                if to - start == 1 or (len(ids) <= PACKED_LINES and chars <= PACKED_CHARS):
                    break
                to = start + (to - start) // 2
            x, y = at.astype(np.int32).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([x.tobytes()]), pa.array([y.tobytes()])], names=["lids", "x", "y"])
            start, most = to, min(PACKED, 2 * (to - start))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            if sum(len(x[0]) for x in held) >= 1 << 18:
                yield from packs_of(*map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield from packs_of(*map(np.concatenate, zip(*held, strict=True)))

    def check(pair: pa.Table, text: pa.Table) -> pa.Table:
        ids, of = pair["lids"][0].values, [""] * len(pair["lids"][0])
        for i, norm in zip(text["at"].to_pylist(), text["norm"].to_pylist(), strict=True):
            of[i] = norm
        x, y = (np.frombuffer(pair[c][0].as_py(), np.int32) for c in "xy")
        some = [np.zeros(0, np.int64)]
        for at in range(0, len(x), 1 << 15):
            part = slice(at, at + (1 << 15))
            some.append(at + np.flatnonzero(similar_pairs([of[i] for i in x[part].tolist()], [of[i] for i in y[part].tolist()], percent)))
        some = np.concatenate(some)
        return pa.table({"a": ids.take(pa.array(x[some])), "b": ids.take(pa.array(y[some]))})

    packs = stored(pairs.mapInArrow(pack, "lids array<long>, x binary, y binary").withColumn("pack", F.monotonically_increasing_id()), "line-packs")
    held = packs.select("pack", F.posexplode("lids").alias("at", "lid"))
    given = F.broadcast(held) if held.count() <= BROADCAST_IDS else held
    found = given.join(texts, "lid").select(F.col("pack").alias("of"), "at", "norm")
    # As many tasks as the session has them, whatever the bytes are worth.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packs.repartition(tasks, "pack").groupBy("pack").cogroup(found.repartition(tasks, "of").groupBy("of")).applyInArrow(check, "a long, b long")


def packed(keys: np.ndarray, ids: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(bucket, keys, ids, hot keys) rows of postings, each key in the bucket of its upper bits.

    The lines of a hot key come in rows with negative buckets of their own; the key's bucket gets two of them, so that a
    line that other parts hold isn't alone there, and is told that the key is hot.  A key is sent without its bucket's
    bits, as its next 32.
    """
    keys, ids = ordered(keys, ids)
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    held = np.diff(np.append(start, len(keys)))
    many = np.repeat(held >= HOT, held)
    lists = keys >> U(32 - bits)
    for at in range(0, int(many.sum()), 1 << 16):
        part = slice(at, at + (1 << 16))
        yield -1 - int(ids[many][at] >> U(33)), lists[many][part].tobytes(), ids[many][part].tobytes(), b""
    hot = lists[start[held >= HOT]]
    many[start] = False
    many[start[held >= HOT] + 1] = False
    lists, ids = lists[~many], ids[~many]
    bucket = (lists >> U(32)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(lists)) if len(lists) else np.zeros(0, int)
    for a, z in itertools.pairwise(edges.tolist()):
        of = hot[(hot >> U(32)).astype(np.int64) == bucket[a]]
        yield int(bucket[a]), lists[a:z].astype(np.uint32).tobytes(), ids[a:z].tobytes(), of.astype(np.uint32).tobytes()


def _once(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs, each once."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    return keys[new], ids[new]


def ordered(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs in order, each once; most keys are those of one pair."""
    order = np.argsort(keys)
    of = keys[order]
    same = np.zeros(len(of) + 1, bool)
    same[1:-1] = of[1:] == of[:-1]
    again = np.flatnonzero(same[1:] | same[:-1])
    some = order[again]
    order[again] = some[np.lexsort((ids[some], keys[some]))]
    return _once(of, ids[order])


def postings(docs: DataFrame, min_words: int, rows: int) -> DataFrame:
    """(list, lids) of the keys that two lines or more have, from (rk, key, _text) with ``rows`` lines.

    lids are all lines of a key, sorted, and list is null; of a hot key they are some, and list is the same in all its rows.
    A line has some 20 keys; buckets are as many as make BUCKET postings each, whatever keys are hot.
    """
    bits = min(31, max(0, int(np.ceil(np.log2(max(1, 20 * rows / BUCKET))))))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            made = list(packed(np.concatenate(keys), np.concatenate(ids), bits))
            keys.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "keys", "ids", "hot"])

        for batch in batches:
            for _, data, offsets in byte_chunks(batch.column(0)):
                c, _, _ = line_words(data, offsets)
                row, key = line_keys(c, min_words)
                keys.append(key)
                ids.append(line_ids(c)[row])
                if sum(map(len, keys)) >= 2 * BUCKET:
                    yield flush()
        if keys:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), U)
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), U if bucket < 0 else np.uint32)
        keys, ids = ordered(keys, ids)
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        size = np.diff(np.append(start, len(keys)))
        if bucket >= 0:
            hot = np.isin(keys[start], np.frombuffer(b"".join(table["hot"].to_pylist()), np.uint32))
            held = hot | (size > 1)
            ids, keys = ids[np.repeat(held, size)], keys.astype(U) + (U(bucket) << U(32))
            start, size, hot = start[held], size[held], hot[held]
        else:
            hot = np.ones(len(start), bool)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.table({"list": pa.array(keys[start].view(np.int64), mask=~hot), "lids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view(np.int64)))})

    made = docs.select("_text").mapInArrow(post, "bucket int, keys binary, ids binary, hot binary")
    return made.groupBy("bucket").applyInArrow(meet, "list long, lids array<long>")


def whole_lists(batches: Iterator[pa.RecordBatch], by: str = "list") -> Iterator[pa.Table]:
    """Rows in the order of their list, as tables that hold all rows of each of their lists."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        of = batch.column(by).to_numpy()
        # The last list may go on in the next batch.
        cut = int(np.searchsorted(of, of[-1])) if len(of) else 0
        if held and len(of) and (cut or held[-1].column(by)[-1].as_py() != of[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def in_lists(members: DataFrame, *order: str, by: str = "list", tasks: int | None = None) -> DataFrame:
    """The members with the rows of a list together, in the order of lists and in this order inside."""
    return (members.repartition(tasks, by) if tasks else members.repartition(by)).sortWithinPartitions(by, *order)


class Sides:
    """The sizes and sketches of lines, and which of them are near: compared further."""

    def __init__(self, table: pa.Table, distance: int, percent: int):
        self.size = table["size"].to_numpy().astype(np.int64)
        self.sims = [table[x].to_numpy().view(U) for x in SIMS]
        self.distance, self.percent = distance, percent

    def near(self, i, j) -> np.ndarray:
        """Of lines i and j, indices or slices that broadcast."""
        low, high = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        bits = sum(np.bitwise_count(x[i] ^ x[j]) for x in self.sims)
        most = np.where(low < LONGER_LINE, self.distance, self.distance - 8)
        most[(low < SHORT_LINE) | (low > LONG_LINE)] = 255
        return (bits <= most) & (100 * low >= self.percent * high)

    def near_in(self, at: int, to: int, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
        """The near lines of at:to and left:right, each stretch in order of size, as two arrays."""
        bits = np.bitwise_count(self.sims[0][at:to, None] ^ self.sims[0][None, left:right])
        for x in self.sims[1:]:
            bits += np.bitwise_count(x[at:to, None] ^ x[None, left:right])
        low, high = min(self.size[at], self.size[left]), min(self.size[to - 1], self.size[right - 1])
        x, y = np.nonzero(bits <= (255 if low < SHORT_LINE or high > LONG_LINE else min(self.distance, 255)))
        x, y = x + at, y + left
        some = self.near(x, y)
        return x[some], y[some]


def pairs_of_short_lists(members: DataFrame, distance: int, percent: int) -> DataFrame:
    """(a, b) of the near lines that share a list of LISTED lines at most, from (list, lid, size, sim0, ...)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_lists(batches):
            of, lid, sides = rows["list"].to_numpy(), rows["lid"].to_numpy(), Sides(rows, distance, percent)
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for apart in itertools.count(1):
                i = np.flatnonzero(of[:-apart] == of[apart:])
                if not len(i):
                    break
                i = i[sides.near(i, i + apart)]
                a.append(np.minimum(lid[i], lid[i + apart]))
                b.append(np.maximum(lid[i], lid[i + apart]))
            a, b = np.concatenate(a), np.concatenate(b)
            a, b = ordered(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return in_lists(members).mapInArrow(make, "a long, b long").where("a <> b").distinct()


def in_tiles(apart: DataFrame, percent: int) -> DataFrame:
    """The lines of lists too large for one task with the tiles in which two near lines of a list meet once, and their side there.

    Lines go by classes of size, of which near ones have one or two neighbours, and classes of many lines by parts.  In a
    tile of one part (side -1) all lines meet, in one of two parts those of side 0 meet those of side 1.
    """
    step = np.log(100 / percent) + 1e-6 if 0 < percent < 100 else 1e-6 if percent > 0 else 1e9
    apart = apart.withColumn("class", F.floor(F.log(F.greatest("size", F.lit(1))) / F.lit(float(step))))
    parts = apart.groupBy("list", "class").agg(F.ceil(F.count("*") / F.lit(LARGE)).alias("parts"))
    below = parts.select("list", (F.col("class") + 1).alias("class"), F.col("parts").alias("below"))
    apart = apart.join(parts, ["list", "class"]).join(below, ["list", "class"], "left")
    part = F.pmod(F.xxhash64("lid"), F.col("parts"))
    tile = lambda c, own, x, y: F.xxhash64("list", c, F.lit(own), x, y)
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    seats = [
        F.transform(every(F.col("parts")), lambda j: F.struct(tile(F.col("class"), True, F.least(part, j), F.greatest(part, j)).alias("tile"), F.when(part == j, -1).when(part < j, 0).otherwise(1).alias("side"))),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts_above") - 1), lambda j: F.struct(tile(F.col("class"), False, part, j).alias("tile"), F.lit(0).alias("side"))),
        F.transform(every(F.col("below")), lambda j: F.struct(tile(F.col("class") - 1, False, j, part).alias("tile"), F.lit(1).alias("side"))),
    ]
    above = parts.select("list", (F.col("class") - 1).alias("class"), F.col("parts").alias("parts_above"))
    apart = apart.join(above, ["list", "class"], "left")
    seat = F.concat(*[F.coalesce(x, F.array().cast("array<struct<tile:bigint,side:int>>")) for x in seats])
    return apart.withColumn("seat", F.explode(seat)).select("*", "seat.tile", "seat.side").drop("class", "parts", "below", "parts_above", "seat")


def in_first_list(of: int, lists: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the lines x and y, members of the list ``of``, share no list with a smaller number."""
    rows, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    held = lists.take(pa.array(rows))
    flat, line = held.flatten().to_numpy(), np.repeat(np.arange(len(rows)), np.diff(held.offsets.to_numpy()))
    line, flat = line[flat < of], flat[flat < of]
    _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    line, number = line[count[number] > 1], number[count[number] > 1]
    shared = np.zeros(len(x), bool)
    # 64 lists at a time are bits of a word.
    numbers, number = np.unique(number, return_inverse=True)
    for k in range(0, len(numbers), 64):
        some = (number >= k) & (number < k + 64)
        bits = np.zeros(len(rows), U)
        np.bitwise_or.at(bits, line[some], U(1) << (number[some] - k).astype(U))
        shared |= (bits[at[: len(x)]] & bits[at[len(x) :]]) != 0
    return ~shared


def near_in_lists(apart: DataFrame, distance: int, percent: int) -> DataFrame:
    """(a, b, size_a, size_b) of what :func:`pairs_apart` returns; lists are compared with NumPy in the task that has them.

    Lists that a column ``large`` names, if there is one, are divided into tiles before.
    """
    held, tiles = apart.groupBy("lid").agg(F.collect_set("list").alias("lists")), None
    if "large" in apart.columns:
        tiles = in_tiles(apart.where("large").drop("large"), percent)
        apart = apart.where("NOT large").drop("large")
    whole = apart.withColumn("tile", F.col("list")).withColumn("side", F.lit(-1))
    if tiles is not None:
        whole = whole.unionByName(tiles)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_lists(batches, "tile"):
            of, tile, side, lid, component = (rows[c].to_numpy() for c in ("list", "tile", "side", "lid", "component"))
            lists, sides = rows["lists"].combine_chunks(), Sides(rows, distance, percent)
            edges = np.append(np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), len(tile))
            for start, end in itertools.pairwise(edges.tolist()):
                # Each line against those of its size up to those too long for it, in blocks that a cache holds.
                middle = start + int(np.searchsorted(side[start:end], 1)) if side[start] >= 0 else end
                found, many = [], 0
                for at in range(start, middle, 64):
                    to, other, last = min(at + 64, middle), start if middle == end else middle, end
                    if side[start] < 0:
                        other = at
                    elif middle == end:
                        break
                    size = sides.size[other:last]
                    left = other + int(np.searchsorted(size, -(-sides.size[at] * percent // 100)))
                    until = other + int(np.searchsorted(size, sides.size[to - 1] * 100 // max(1, percent), side="right")) if percent > 0 else last
                    for left in range(left, until, 2048):
                        x, y = sides.near_in(at, to, left, min(left + 2048, until))
                        some = (x < y) & (component[x] != component[y])
                        found.append((x[some], y[some]))
                        many += len(found[-1][0])
                    if many and (many >= 1 << 18 or to == middle):
                        x, y = (np.concatenate(s) for s in zip(*found, strict=True))
                        some = in_first_list(of[start], lists, x, y)
                        x, y = x[some], y[some]
                        x, y = np.where(lid[x] < lid[y], x, y), np.where(lid[x] < lid[y], y, x)
                        made = [lid[x], lid[y], sides.size[x].astype(np.int32), sides.size[y].astype(np.int32)]
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, made)), names=["a", "b", "size_a", "size_b"])
                        found, many = [], 0

    # Few rows make much work: as many tasks as the session has them, not as many as the bytes are worth.
    tasks = int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_lists(whole.join(held, "lid"), "side", "size", by="tile", tasks=tasks).mapInArrow(make, "a long, b long, size_a int, size_b int")


def pairs_of_lists(apart: DataFrame, distance: int, percent: int) -> DataFrame:
    """What :func:`pairs_apart` returns, by :func:`near_in_lists`."""
    return near_in_lists(apart, distance, percent).select("a", "b")


def pairs_apart(apart: DataFrame, near) -> DataFrame:
    """(a, b) of the near lines of different components that share a list, from (list, lid, size, sim0, ..., component, most).

    A pair is made once, in the first of the lists that it shares: by the line outside the list's largest component, by the
    smaller one if both are.  Lines repeated in a list count once.
    """
    line = [c for c in apart.columns if c not in ("list", "most")]
    held = apart.groupBy(*line).agg(F.collect_set(F.struct("list", "most")).alias("of"))
    apart = held.select(*line, F.col("of.list").alias("lists"), F.explode("of").alias("of")).select(*line, "lists", "of.list", "of.most")
    x, y = apart.where("component <> most").alias("x"), apart.alias("y")
    once = (F.col("y.component") == F.col("y.most")) | (F.col("x.lid") < F.col("y.lid"))
    first = F.array_min(F.array_intersect("x.lists", "y.lists")) == F.col("x.list")
    across = (F.col("x.list") == F.col("y.list")) & (F.col("x.component") != F.col("y.component")) & once & near("x.", "y.") & first
    return x.join(y, across).select(F.least("x.lid", "y.lid").alias("a"), F.greatest("x.lid", "y.lid").alias("b"))


def regrouped(group: DataFrame, links: DataFrame) -> DataFrame:
    """The (id, component) of a group with further links (a, b) between any ids."""
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct().join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
    left, right = (ends.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    joined = components(links.join(left, "a").join(right, "b"), "ca", "cb").select(F.col("id").alias("component"), F.col("component").alias("next"))
    everyone = group.union(ends.join(group.select("id"), "id", "left_anti"))
    return stored(everyone.join(joined, "component", "left").select("id", F.coalesce("next", "component").alias("component")), "line-groups")


def fuzzy_groups(classes: DataFrame, docs: DataFrame, *, min_words: int, distance: int, percent: int) -> DataFrame:
    """(id, component) of the distinct lines that verified links connect."""

    def near(x: str, y: str):
        bits = sum(F.bit_count(F.col(x + s).bitwiseXOR(F.col(y + s))) for s in SIMS)
        low, high = F.least(f"{x}size", f"{y}size").cast("long"), F.greatest(f"{x}size", f"{y}size").cast("long")
        return (100 * low >= percent * high) & (~low.between(SHORT_LINE, LONG_LINE) | (bits <= F.when(low < LONGER_LINE, distance).otherwise(distance - 8)))

    met = stored(postings(docs, min_words, classes.count()), "line-postings")
    # Lists of the same lines are one.
    known = met.where("list IS NULL").select("lids").distinct()
    known = known.select(F.xxhash64("lids").alias("list"), (F.size("lids") <= LISTED).alias("short"), F.explode("lids").alias("lid"))
    hot = met.where("list IS NOT NULL").select("list", F.lit(False).alias("short"), F.explode("lids").alias("lid")).distinct()
    seated = stored(known.union(hot).join(classes.select("lid", "size", *SIMS), "lid").select("list", "short", *SIDE), "line-lists")
    forget(met)
    tried = stored(pairs_of_short_lists(seated.where("short"), distance, percent), "line-pairs")
    members = seated.where("NOT short").drop("short")
    ends = tried.select(F.col("a").alias("lid")).union(tried.select("b")).union(members.select("lid")).distinct()
    texts = line_texts(docs, stored(classes.join(ends, "lid").select("first.rk", "first.line", "lid"), "line-ends"))
    group, refused = components(stored(verified(tried, texts, percent), "line-links")), tried
    members = stored(members, "line-lists")
    forget(seated)
    for turn in range(TURNS + 1 if not members.isEmpty() else 0):
        labelled = members.join(group.withColumnRenamed("id", "lid"), "lid", "left").withColumn("component", F.coalesce("component", "lid"))
        # Of two members apart one is outside the list's largest component, so those inside needn't meet each other.
        parts = labelled.groupBy("list", "component").agg(F.count("*").alias("n"))
        mixed = parts.groupBy("list").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"), F.sum("n").alias("of"))
        mixed = mixed.where("parts > 1").select("list", F.col("most.component").alias("most"), (F.col("of") > LARGE).alias("large"))
        apart = stored(labelled.join(mixed, "list"), "line-lists")
        forget(members)
        members = apart.drop("component", "most", "large")
        if turn == TURNS:
            # What was refused before is in the same lists; it is a small part of these pairs and looked at once more.
            pairs = stored(near_in_lists(apart, distance, percent), "line-pairs")
            links = stored(verified_in_packs(pairs, texts, percent), "line-links")
        else:
            # A member of the largest component for each list: what it links needn't be tried against all others.
            order = F.struct(F.xxhash64("lid", F.lit(turn)).alias("o"), *SIDE)
            hubs = apart.where("component = most").groupBy("list").agg(F.min(order).alias("hub")).select("list", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in SIDE])
            pairs = apart.where("component <> most").join(hubs, "list").where(near("", "hub_")).select(F.least("lid", "hub_lid").alias("a"), F.greatest("lid", "hub_lid").alias("b")).distinct()
            # A pair that was refused needs no second look.
            pairs = stored(pairs.join(refused, ["a", "b"], "left_anti"), "line-pairs")
            links = stored(verified(pairs, texts, percent), "line-links")
            refused = refused.union(pairs)
        if not links.isEmpty():
            group = regrouped(group, links)
    forget(members)
    return group


def dedup_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 5,
    distance: int = 72,
    percent: int = 80,
) -> DataFrame:
    """Every row of docs with its text less the repeated lines, and n_lines, n_dropped (its lines, and those that went).

    Lines are what \\n separates.  A line stays where it is the first of its group in order of key (null first) and line
    number.  Rows that repeat both key and text count as one document and get equal results; rows that share a key but
    not the text are ordered by a hash of the text.  A null text stays null, with 0 lines; an empty one has one empty
    line and stays.  Columns of docs named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    row_key = F.xxhash64(F.col(key), F.col(text))
    slim = docs.select(row_key.alias("rk"), F.col(key).alias("key"), F.col(text).alias("_text"))
    found = stored(lines(slim), "lines")
    classes = stored(found.groupBy("lid").agg(F.min(F.struct("key", "rk", "line")).alias("first"), *[F.first(x).alias(x) for x in ("size", *SIMS)], F.count("*").alias("m")), "line-classes")
    group = fuzzy_groups(classes, slim, min_words=min_words, distance=distance, percent=percent).withColumnRenamed("id", "lid")
    # A class alone in its group is one of its own; only groups of two lines or more can lose any.
    grouped = classes.select("lid", "first", "m").join(group, "lid", "left")
    stays = grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("stays"))
    repeated = grouped.where("component IS NOT NULL").select("lid", "component").join(stays, "component").select("lid", "stays")
    repeated = repeated.union(grouped.where("component IS NULL AND m > 1").select("lid", "first"))
    repeated = repeated.select("lid", F.col("stays.rk").alias("stay_rk"), F.col("stays.line").alias("stay_line"))
    goes = found.select("rk", "line", "lid").join(repeated, "lid").where((F.col("rk") != F.col("stay_rk")) | (F.col("line") != F.col("stay_line")))
    dropped = stored(goes.groupBy("rk").agg(F.collect_set("line").alias("_dropped")), "dropped-lines").withColumnRenamed("rk", "_rk")
    rows, total = dropped.agg(F.count("*"), F.coalesce(F.sum(F.size("_dropped")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and total <= 8 * BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    split = F.split(F.col(text), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    out = docs.withColumn("_row", row_key).join(dropped, F.col("_row") == F.col("_rk"), "left")
    return (
        out.withColumn("_lines", F.when(F.col(text).isNotNull(), split))
        .withColumn(text, F.when(F.col("_dropped").isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")))
        .withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long"))
        .withColumn("n_lines", F.when(F.col("_lines").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_lines")))
        .withColumn("n_dropped", F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long"))
        .drop("_row", "_rk", "_dropped", "_lines")
    )
