"""Phrases of words that stand together, found by sorting suffix pointers one word deeper each round.

A suffix pointer is a place of a word in the texts of a task; its key at depth d is the word d places on.  A task sorts
its pointers by multikey three-way quicksort, and the sizes of the partitions of equal keys are its counts.  What tasks
count is routed by the leading words and summed, so that after round d the phrases of d words with fewer than the least
count are known; in round d + 1 no pointer is taken whose leading or trailing d words were abandoned.  Tasks learn that
from a bit table of fixed size: a bucket that two phrases share costs a little work, never a count.

Words are named by 64-bit hashes of language and word.  All words of the corpus are counted with their text, so two words
of one name are noticed, and another seed is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import forget, stored
from .textvec import U, Chunk, byte_chunks, byte_values, hash_words, mix

#: Fixed by the output contract: bytes that end a piece, and those that separate words inside one.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b" \t"

#: Words of a task that are sorted together.
WINDOW_WORDS = 1 << 19
#: Partitions up to this size are sorted at once.
LEAF = 1 << 13
#: The table of phrases that are frequent enough has 2**BITS bits (8 MB) at any size of the corpus.
BITS = 26
#: Parts of a language that are ranked apart before the language is.
PARTS = 32


def partitions(ids: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of the pointers ``at`` by ids[at], ids[at + 1], ... to the depth.

    Returns a pointer of each partition of equal keys, and the partition's size.
    """
    firsts, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    stack = [(at, 0)] if len(at) else []
    while stack:
        at, d = stack.pop()
        if len(at) <= LEAF:
            keys = [ids[at + i] for i in range(d, depth)]
            order = np.lexsort(keys[::-1])
            new = np.zeros(len(at), bool)
            new[0] = True
            for key in keys:
                key = key[order]
                new[1:] |= key[1:] != key[:-1]
            begin = np.flatnonzero(new)
            firsts.append(at[order[begin]])
            sizes.append(np.diff(begin, append=len(at)))
            continue
        key = ids[at + d]
        pivot = np.sort(key[:: len(key) // 32])[16]
        same = at[key == pivot]
        if d + 1 == depth:
            firsts.append(same[:1])
            sizes.append(np.array([len(same)]))
        else:
            stack.append((same, d + 1))
        stack += [(side, d) for side in (at[key < pivot], at[key > pivot]) if len(side)]
    return np.concatenate(firsts), np.concatenate(sizes)


class Words:
    """The words of some texts: ids[i] names word i, begins[i] says that it begins a piece.

    Where texts are asked for, the chunks and langs[i], the language of word i, are there too.
    """

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray | None, Chunk | None]]) -> None:
        ids, begins, langs, self.chunks = zip(*parts, strict=True)
        self.ids, self.begins = np.concatenate(ids), np.concatenate(begins)
        self.langs = np.concatenate(langs) if langs[0] is not None else None
        self.ends = np.cumsum([len(x) for x in ids])

    def texts(self, at: np.ndarray) -> list[str]:
        """The words at these places, A-Z lower-cased."""
        out = []
        of = np.searchsorted(self.ends, at, side="right")
        for k, i in zip(of.tolist(), at.tolist(), strict=True):
            c = self.chunks[k]
            j = i - int(self.ends[k]) + len(c.hash)
            out.append(c.data[c.start[j] : c.end[j]].tobytes().lower().decode("utf-8", "replace"))
        return out


_ENDS = np.zeros(256, np.int32)
_ENDS[list(PIECE_ENDS)] = 1
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(PIECE_ENDS + WORD_ENDS)] = False


def read_words(batches: Iterator[pa.RecordBatch], seed: int, texts: bool = False) -> Iterator[Words]:
    """Windows of whole texts from batches of (language hash, text)."""
    parts, n, values = [], 0, byte_values(seed)
    for batch in batches:
        lang = batch.column(0).to_numpy().view(U)
        for first, data, offsets in byte_chunks(batch.column(1)):
            c = hash_words(data, offsets, first, _IS_WORD, values=values)
            if not len(c.hash):
                continue
            row = np.repeat(np.arange(c.n), np.diff(c.bound))
            piece = np.cumsum(_ENDS[data])[c.start]
            begins = np.ones(len(row), bool)
            begins[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
            langs = lang[first + row]
            parts.append((mix(c.hash ^ langs), begins, langs if texts else None, c if texts else None))
            n += len(row)
            if n >= WINDOW_WORDS:
                yield Words(parts)
                parts, n = [], 0
    if n:
        yield Words(parts)


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of words."""
    h = columns[0]
    for x in columns[1:]:
        h = mix(h * U(0x9E3779B97F4A7C15) + x)
    return h


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """(id, lh, word, n) of all words of texts (lh, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in read_words(batches, seed, texts=True):
            at, n = partitions(w.ids, np.arange(len(w.ids)), 1)
            yield pa.RecordBatch.from_arrays([pa.array(w.ids[at].view(np.int64)), pa.array(w.langs[at].view(np.int64)), pa.array(w.texts(at), pa.string()), pa.array(n)], names=["id", "lh", "word", "n"])

    return texts.mapInArrow(make, "id long, lh long, word string, n long").groupBy("id", "lh", "word").agg(F.sum("n").alias("n"))


def bit_table(frequent: DataFrame, words: list[str]) -> bytes:
    """Bits of the hashes of frequent phrases, whatever their number in 2**BITS bits."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = phrase_hash([x.to_numpy().view(U) for x in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array((h >> U(64 - BITS)).astype(np.int64) + 1)], names=["bit"])

    bits = frequent.select(*words).mapInArrow(make, "bit long")
    # Rows of 4 KB, each for 32,768 bits: 2**(BITS - 15) rows at most come to the driver.
    rows = bits.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    table = bytearray(1 << (BITS - 3))
    for k, part in rows.collect():
        table[(k - 1) << 12 : k << 12] = part
    return bytes(table)


def count_phrases(texts: DataFrame, seed: int, words: int, frequent: bytes) -> DataFrame:
    """(w1, ..., n) of phrases of so many words whose leading and trailing words but one have their bit in ``frequent``."""
    table = texts.sparkSession.sparkContext.broadcast(frequent)
    names = [f"w{i + 1}" for i in range(words)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for w in read_words(batches, seed):
            n = len(w.ids) - words + 1
            if n <= 0:
                continue
            shorter = phrase_hash([w.ids[i : n + 1 + i] for i in range(words - 1)]) >> U(64 - BITS)
            known = (bits[shorter >> U(3)] >> (shorter & U(7)).astype(np.uint8)) & 1 > 0
            whole = known[:-1] & known[1:]
            for i in range(1, words):
                whole &= ~w.begins[i : n + i]
            at, size = partitions(w.ids, np.flatnonzero(whole), words)
            yield pa.RecordBatch.from_arrays([*(pa.array(w.ids[at + i].view(np.int64)) for i in range(words)), pa.array(size)], names=[*names, "n"])

    counted = texts.mapInArrow(make, ", ".join(f"{x} long" for x in [*names, "n"]))
    return counted.groupBy(*names).agg(F.sum("n").alias("n"))


def mine(docs: DataFrame, *, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``max_words`` words.

    Texts (null: empty; A-Z lower-cased) are cut into pieces at ``. , ; : ! ?`` and the bytes 0A to 0D, pieces into words at
    spaces and tabs.  n counts the words of a language (null: ``und``), a the places of a phrase inside pieces, overlapping
    ones too; phrases with ``least`` places or more are candidates.  A cut after k words has l places of the first and r of
    the second part and the score floor(1000000 a a / (l r)); the cut of the lowest score counts, of equal ones the first.
    A candidate goes if a longer candidate with 100 a' >= ``inside`` a holds it.  Ranks go by score and a, both descending,
    and by the bytes of the phrase.  Repeated rows count as often as they are there; no texts, or none with words, no rows.
    """
    for seed in range(8):
        texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
        texts = texts.select(F.xxhash64(F.lit(seed), "lang").alias("lh"), "text", "lang")
        langs = stored(texts.select("lh", "lang").distinct(), "languages")
        words = stored(count_words(texts.select("lh", "text"), seed), "words")
        if words.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").isEmpty() and langs.groupBy("lh").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
            break
        forget(words, langs)
    else:
        raise ValueError("two words share a hash under every seed")
    texts = texts.select("lh", "text")
    totals = words.groupBy("lh").agg(F.sum("n").alias("n")).join(langs, "lh")
    level = words.where(F.col("n") >= least).select(F.col("id").alias("w1"), "n")
    counts = level.select(F.array("w1").alias("p"), F.col("n").alias("a"))
    for d in range(2, max_words + 1):
        bits = bit_table(level, [f"w{i + 1}" for i in range(d - 1)])
        level = stored(count_phrases(texts, seed, d, bits).where(F.col("n") >= least), "phrases")
        counts = counts.union(level.select(F.array(*[f"w{i + 1}" for i in range(d)]).alias("p"), F.col("n").alias("a")))
    candidates = counts.where(F.size("p") > 1)

    # Both parts of a candidate have as many places as it, or more, and so are in ``counts``.
    cut = candidates.select("p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("first"), F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")).alias("rest"))
    cut = cut.join(counts.select(F.col("p").alias("first"), F.col("a").alias("l")), "first").join(counts.select(F.col("p").alias("rest"), F.col("a").alias("r")), "rest")
    score = F.expr("(CAST(1000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * a) div (CAST(l AS DECIMAL(38,0)) * r)")
    scored = cut.withColumn("score", score).groupBy("p").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x")).select("p", "x.*")

    def parts(p: str) -> Column:  # the phrases of 2 words or more inside a longer one
        return F.flatten(F.transform(F.sequence(F.lit(2), F.size(p) - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size(p) - m + 1), lambda i: F.slice(p, i, m))))

    held = candidates.where(F.size("p") > 2).select(F.explode(F.array_distinct(parts("p"))).alias("p"), "a").groupBy("p").agg(F.max("a").alias("most"))
    stay = scored.join(held, "p", "left").where(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a")))

    named = stay.join(words.select(F.col("id").alias("w"), "lh"), F.get("p", F.lit(0)) == F.col("w")).drop("w", "most")
    # First in parts of a language, so that the one task that ranks a language gets few rows.
    order = [F.desc("score"), F.desc("a")]
    ahead = named.withColumn("part", F.pmod(F.xxhash64("p"), F.lit(PARTS)))
    for keys in (["lh", "part"], ["lh"]):
        ahead = ahead.withColumn("place", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= top)
    ahead = stored(ahead, "ahead")
    spelt = ahead.select("p", F.posexplode("p").alias("i", "id")).join(words.select("id", "word"), "id").groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = ahead.join(spelt, "p").withColumn("rank", F.row_number().over(Window.partitionBy("lh").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lh").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
