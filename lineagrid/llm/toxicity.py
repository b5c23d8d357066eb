"""Toxicity by a noisy channel: restore disguised words with a character language model, then score restored text.

1. A character trigram model is counted over all documents (one vectorised pass, counts summed by Spark).
2. Tokens that may be disguised (a letter with digits or signs that stand for letters, doubled letters, letters spaced
   out, letters of other scripts or with marks) become character lattices; Viterbi decoding under the trigram model picks
   the reading.  A token of plain letters has a lattice of one path and stands for itself.  Where a token is pieces of
   letters with separators between, or words that follow each other make up a word with a weight, the lattice is only
   whether each gap is nothing or a space, and the model decides between the word and its pieces.
3. Words and word beginnings of the restored texts of labelled documents get log-odds weights, kept where the evidence
   is strong; a document's score is a logistic function of the sum of its distinct features' weights.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_sample, stored

#: Fixed readings of signs and digits that stand for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Fixed letters of other scripts that look like Latin ones.
ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
#: Letters of the model: class 0 is the space between words, 1 anything else that isn't a letter listed here.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêçàâîôûáíóúñ"
SIZE = 64
CODE = {c: i + 2 for i, c in enumerate(LETTERS)}
_TABLE = np.ones(0x2000, np.uint8)
for _c in " \t\n\x0b\f\r":
    _TABLE[ord(_c)] = 0
for _c, _i in CODE.items():
    _TABLE[ord(_c)] = _i
    if len(_c.upper()) == 1:
        _TABLE[ord(_c.upper())] = _i

#: Costs in nats of the channel's edits: a sign read as a letter, a repetition left out, a separator left out, and
#: anything left out that could be read as a letter.
SUBSTITUTE, SQUEEZE, DROP, LOSE = 0.7, 0.5, 2.5, 12.0
#: Cost in nats of a white space inside a word; other separators read as a space cost as much as read as nothing.
GAP = 0.5
PREFIXES = (4, 5, 6)
#: Signs that a word's first piece may stand behind.
OPENING = "\"'([*_-"
#: Letters of the longest word that is put together from pieces; insults are shorter.
LONGEST = 40


def trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of a partition's character trigrams; words are padded by the spaces around them."""
    total = np.zeros(SIZE**3, np.int64)

    def count(text: str) -> None:
        for at in range(0, len(text), 1 << 20):
            points = np.frombuffer(text[at : at + (1 << 20) + 2].encode("utf-32-le", "replace"), np.uint32)
            codes = _TABLE[np.minimum(points, len(_TABLE) - 1)].astype(np.int32)
            if len(codes) > 2:
                np.add(total, np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3), out=total)

    for batch in batches:
        held, size = [], 0
        for text in batch.column(0):
            held.append(text.as_py() or "")
            size += len(held[-1])
            if size > 1 << 20:
                count(f" {' '.join(held)} ")
                held, size = [], 0
        count(f" {' '.join(held)} ")
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["code", "n"])


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of a character after two others, interpolated with bigrams; 64**3 numbers at any input size."""
    counts = docs.select(F.col(text)).mapInArrow(trigram_counts, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(SIZE**3)
    n[counts["code"].to_numpy()] = counts["n"].to_numpy()
    n = n.reshape(SIZE, SIZE, SIZE)
    two = n.sum(0)
    one = two.sum(0)
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 2 * p1) / (two.sum(1, keepdims=True) + 2)
    p3 = (n + 2 * p2[None]) / (n.sum(2, keepdims=True) + 2)
    return np.log(p3).astype(np.float32)


_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(€£])(?:\s+(?:[^\W_]|[@$!|+(€£])){2,}(?!\S)")
_SEPARATED = re.compile(r"[^\W_](?:[.\-_*~]+[^\W_]){2,}")
_BETWEEN = re.compile(r"[\s.\-_*~]")
_RUN = re.compile(r"([^\W\d_])\1", re.I)
_LATIN = re.compile(r"[a-z]", re.I)
_ODD = re.compile(f"[^\\x00-\\x7f{LETTERS}{LETTERS.upper()}]")
_SIGN = re.compile(r"[\d@$!|+(€£]")
_WORDISH = re.compile(r"[^\W\d_]+")
_EDGE = re.compile(r"^[.,;:?\"'*#%&\-_()\[\]]+|(?:[.,;:?\"'*#%&\-_()\[\]!]|([|+])\1+|\${3,}|@{3,})+$")


def plain(ch: str) -> str:
    """The Latin letter under a letter's marks that the model doesn't know as it is; none if there is none."""
    base = "" if ch.isascii() or ch in CODE else unicodedata.normalize("NFD", ch)[0]
    return base if base in CODE else ""


@lru_cache(4096)
def readings(ch: str) -> tuple[tuple[str, int, float], ...]:
    """The letters that a character may be read as: itself, what it looks like and what is under its marks."""
    own = ((ch, CODE[ch], 0.0),) if ch in CODE else ()
    return own + tuple((c, CODE[c], SUBSTITUTE) for c in LEET.get(ch, "") or ALIKE.get(ch, "") or plain(ch))


def cost(text: str, lm: list[float]) -> float:
    """What the model charges for a text of words, spaces around it included."""
    codes = [0, 0, *(0 if c == " " else CODE.get(c, 1) for c in text), 0]
    return -sum(lm[(a * SIZE + b) * SIZE + c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))


def decode(token: str, lm: list[float], several: bool = False) -> str:
    """The likeliest reading of one token: Viterbi over its character lattice.

    Each input character offers itself (letters), the letters it may stand for (at a cost), or nothing (separators and
    repetitions, at a cost).  The state is the last two characters of the reading; the reading is wrapped in spaces.
    With ``several`` a space may follow any letter, so that the reading may be of several words.  Readings are chains of
    (chain before, character): time and memory grow with the length.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for ch in token.lower():
        options = readings(ch)
        skip = SQUEEZE if ch == before else None if ch in CODE else LOSE if options else DROP
        if not options and skip is None:
            options = (("", 1, DROP),)
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, read) in states.items():
            at = (a * SIZE + b) * SIZE
            if skip is not None and cost + skip < following.get((a, b), (math.inf,))[0]:
                following[a, b] = (cost + skip, read)
            for c, i, extra in options:
                total = cost + extra - lm[at + i]
                if total < following.get((b, i), (math.inf,))[0]:
                    following[b, i] = (total, (read, c) if c else read)
        if several:
            for (a, b), (cost, read) in list(following.items()):
                total = cost - lm[(a * SIZE + b) * SIZE]
                if b and total < following.get((b, 0), (math.inf,))[0]:
                    following[b, 0] = (total, (read, " "))
        states, before = following, ch
    chain = min(states.items(), key=lambda s: s[1][0] - (lm[(s[0][0] * SIZE + s[0][1]) * SIZE] if s[0][1] else 0.0))[1][1]
    out = []
    while chain:
        chain, c = chain
        out.append(c)
    return "".join(reversed(out))


class Restorer:
    """Restores texts under one model, with a bounded memory of decoded tokens."""

    def __init__(self, lm: np.ndarray):
        self.lm, self.known = lm.ravel().tolist(), {}  # a list is read faster than an array, one number at a time

    def token(self, token: str) -> list[str]:
        """The words that a token without white space reads as."""
        if not token.isascii() and _ODD.search(token):
            token = "".join(c for c in unicodedata.normalize("NFKC", token) if unicodedata.category(c) not in ("Cf", "Mn"))
        core = _EDGE.sub("", token)
        if core.isalpha() and not _RUN.search(core):
            return [core.lower(), *self.unmarked(core.lower())]
        if _SEPARATED.fullmatch(core):
            return self.run(core)
        words = _WORDISH.findall(core.lower())
        if not words or 2 * sum(c.isalnum() or c in LEET for c in core) < len(core):
            return words
        if _RUN.search(core) or _SIGN.search(core):
            return [decode(core, self.lm), *words]
        return [*words, *self.joined(words, 0.0)]

    def unmarked(self, word: str) -> list[str]:
        """A word of Latin letters and others that look like them as it reads in Latin ones, if it has such others."""
        if word.isascii() or not _ODD.search(word) or not _LATIN.search(word):
            return []
        return [decode(word, self.lm)]

    def joined(self, pieces: list[str], gap: float) -> list[str]:
        """Pieces as one word, if the model finds it likelier than the pieces as words, when a gap costs so much."""
        whole = "".join(pieces)
        if len(pieces) < 2 or len(whole) > LONGEST or cost(whole, self.lm) + gap * (len(pieces) - 1) > cost(" ".join(pieces), self.lm):
            return []
        return [whole]

    def across(self, tokens: list[str], starts: dict[str, str], heavy: dict[str, float], beginnings: set[str]) -> list[str]:
        """Words of ``heavy`` that tokens in a row make up.

        ``starts`` has the tokens that a word of heavy begins with, ``beginnings`` all beginnings of such words.
        """
        found: list[str] = []
        for i, token in enumerate(tokens):
            if (whole := starts.get(token)) is None:
                continue
            pieces = [whole]
            for after in tokens[i + 1 : i + LONGEST]:
                piece = _EDGE.sub("", after).lower()
                whole += piece
                pieces.append(piece)
                if not piece or whole not in beginnings:
                    break
                if whole in heavy:
                    found += self.joined(pieces, GAP)
                if not after[-1:].isalpha():
                    break
        return found

    def run(self, run: str) -> list[str]:
        """The words that letters set apart read as: as one word, and as the likeliest words."""
        letters = _BETWEEN.sub("", run)
        return [decode(letters, self.lm), *decode(letters, self.lm, several=True).split()]

    def spaced(self, text: str) -> list[str]:
        """Readings of runs of single letters or signs set apart by white space."""
        return [w for m in _SPACED.findall(text) for w in self.run(m)]

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        seen: set[str] = set()
        tokens = set(text.split())
        for token in tokens:
            if (read := self.known.get(token)) is None:
                read = self.token(token)
                if len(self.known) >= 100_000:
                    self.known.clear()
                self.known[token] = read
            seen.update(read)
        if sum(len(t) == 1 for t in tokens) > 1:
            seen.update(self.spaced(text))
        seen.discard("")
        return seen


def features(words: set[str]) -> set[str]:
    """Words, and beginnings of longer ones marked by a trailing hyphen."""
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "-" for w in words if len(w) > n)
    return out


def fit(docs: DataFrame, labels: DataFrame, lm: np.ndarray, *, key: str, text: str, label: str, fit_rows: int, least: int, evidence: float, strong: float) -> tuple[dict[str, float], float]:
    """Weights of features and the prior log-odds, from at most about ``fit_rows`` labelled rows (hashed choice).

    A feature is kept with ``least`` toxic documents or more, a likelihood-ratio statistic of ``evidence`` or more, and a
    log-odds weight of ``strong`` or more: weaker ones, many in a long text, would add up to a verdict by chance.
    The number kept is bounded by the words of the bounded sample over ``least``.
    """
    labelled = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_y"))
    # A broadcast of about fit_rows keys; equal texts count once.
    rows = docs.select(F.col(key), F.col(text).alias("_text")).join(bounded_sample(labelled, key, fit_rows), key)
    rows = rows.groupBy(F.xxhash64("_text").alias("_h")).agg(F.max_by("_text", F.length("_text")).alias("_text"), F.max("_y").alias("_y"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, held = Restorer(lm), {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(held)), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["f", "a", "n"])

        for batch in batches:
            for x, y in zip(batch.column("_text"), batch.column("_y"), strict=True):
                toxic = y.as_py()
                for f in features(restore.words(x.as_py() or "")):
                    if (v := held.get(f)) is None:
                        held[f] = [toxic, 1]
                    else:
                        v[0] += toxic
                        v[1] += 1
                if len(held) > 300_000:
                    yield flush()
        if held:
            yield flush()

    rows = stored(rows.select("_text", F.col("_y").cast("int").alias("_y")), "toxic-fit")
    n1, n0 = rows.agg(F.coalesce(F.sum("_y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("_y")), F.lit(0))).first()
    if not n1 or not n0:
        return {}, math.log((n1 + 0.5) / (n0 + 0.5))
    counts = rows.mapInArrow(extract, "f string, a long, n long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    share = F.lit(n1 / (n1 + n0))
    # Twice the log-likelihood ratio of this feature's documents against the base rate.
    g = 2 * (a * F.log(F.greatest(a, F.lit(1e-9)) / (F.col("n") * share)) + b * F.log(F.greatest(b, F.lit(1e-9)) / (F.col("n") * (1 - share))))
    kept = counts.where((a >= least) & (g >= evidence)).select("f", F.log((a + 0.1) / (n1 + 0.2)).alias("l1"), F.log((b + 0.1) / (n0 + 0.2)).alias("l0")).where(F.col("l1") - F.col("l0") >= strong).collect()
    return {r.f: r.l1 - r.l0 for r in kept}, math.log(n1 / n0)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    corpus: DataFrame | None = None,
    fit_rows: int = 40_000,
    least: int = 5,
    evidence: float = 25.0,
    strong: float = 4.0,
    keep_text: bool = True,
) -> DataFrame:
    """Every row of docs with toxicity (0 to 1) and the restored words that spoke for it (toxic_features).

    ``labels`` has the rows to learn from; leave held-out rows out of it.  Repeated labels of a document count once, at
    their largest; labels that are null or of null documents not at all.  Whole texts are scored; the score is a function
    of the text, so repeated rows get equal ones.  A null or empty text has no features and gets the prior's score.  With
    labels of one class only, every score is the prior's.  The weights of all distinct words count.
    """
    docs = docs.drop("toxicity", "toxic_features")
    lm = language_model(docs if corpus is None else corpus, text)
    weights, prior = fit(docs if corpus is None else corpus, labels, lm, key=key, text=text, label=label, fit_rows=fit_rows, least=least, evidence=evidence, strong=strong)
    floor = max(-6.0, min(0.0, prior - 1.0))
    sc = docs.sparkSession.sparkContext
    words = {w for w in weights if not w.endswith("-")}
    model = sc.broadcast((lm, weights, {w[:n] for w in words for n in range(1, len(w) + 1)}))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, weights, beginnings = model.value
        restore, memory = Restorer(lm), {}
        starts: dict[str, str] = {}

        def weigh(words: list[str]) -> list[tuple[float, str]]:
            best = [(max([weights.get(w, 0.0), *(weights.get(w[:n] + "-", 0.0) for n in PREFIXES if len(w) > n)]), w) for w in words]
            return [x for x in best if x[0] > 0]

        for batch in batches:
            at = batch.schema.get_field_index(text)
            scores, found = [], []
            for x in batch.column(at):
                heavy: set[tuple[float, str]] = set()
                tokens = set((whole := x.as_py() or "").split())
                for token in tokens:
                    if (v := memory.get(token)) is None:
                        if len(memory) >= 200_000:
                            memory.clear()
                            starts.clear()
                        v = memory[token] = weigh(restore.token(token))
                        if (low := token.lstrip(OPENING).lower()) in beginnings:
                            starts[token] = low
                    if v:
                        heavy.update(v)
                if sum(len(t) == 1 for t in tokens) > 1:
                    heavy.update(weigh(restore.spaced(whole)))
                if not starts.keys().isdisjoint(tokens):
                    heavy.update(weigh(restore.across(whole.split(), starts, weights, beginnings)))
                most = sorted(heavy, reverse=True)
                z = floor + sum(v for v, _ in most)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                found.append([w for _, w in most])
            keep = [i for i in range(batch.num_columns) if keep_text or i != at]
            columns, names = [batch.column(i) for i in keep], [batch.schema.names[i] for i in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.string()))], names=[*names, "toxicity", "toxic_features"])

    kept = docs if keep_text else docs.drop(text)
    schema = kept.withColumns({"toxicity": F.lit(0.0), "toxic_features": F.array(F.lit(""))}).schema
    return docs.mapInArrow(score, schema)
