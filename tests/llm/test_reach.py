"""What the corpus operators reach, counted without the filters that make them fast."""

import itertools
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lineagrid.llm import decontaminate, line_dedup, toxicity


def test_line_dedup_reaches_similar_lines(spark):
    """Lines with one word of n replaced, or a fifth: 80 % alike by edit similarity, so the second one goes."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))
    cases = {(8, 1): 0.95, (10, 1): 0.95, (12, 1): 0.95, (20, 1): 0.98, (40, 1): 1.0, (50, 1): 1.0, (200, 1): 1.0, (10, 2): 0.85, (30, 6): 0.8, (60, 12): 0.9}
    pairs = []
    for n, changed in cases:
        more = []
        while len(more) < 200:
            a = [word() for _ in range(n)]
            b = [*a]
            for i in rng.sample(range(n), changed):
                b[i] = word()
            if a != b and line_dedup.similar(" ".join(a), " ".join(b), 80):
                more.append((" ".join(a), " ".join(b)))
        pairs += more
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(x for p in pairs for x in p)], "doc_id long, text string")
    dropped = {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_dropped = 1").collect()}
    assert all(i % 2 for i in dropped)
    for k, (case, least) in enumerate(cases.items()):
        assert sum(400 * k <= i < 400 * (k + 1) for i in dropped) >= least * 200, case


def test_line_dedup_whole_table():
    """Against edit similarity alone, over all pairs of lines of five words or more of a table."""
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    seen = {}
    for text in table["text"].to_pylist():
        for line in (text or "").split("\n"):
            if len((norm := line_dedup.normalised(line.encode())).split()) >= 5:
                seen.setdefault(norm)
    names = list(seen)
    size = np.array([len(x) for x in names])
    bags = np.array([np.bincount(np.frombuffer(x.encode(), np.uint8), minlength=256) for x in names], np.int16)
    bags = bags[:, bags.any(0)]
    pairs = []
    for i in range(len(names)):
        close = np.flatnonzero(5 * np.minimum(size[:i], size[i]) >= 4 * np.maximum(size[:i], size[i]))
        more = bags[close] - bags[i]
        # Letters that one has more of than the other are edits at least.
        least = np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))
        pairs += [(i, j) for j in close[5 * least <= np.maximum(size[close], size[i])] if line_dedup.similar(names[i], names[j], 80)]
    raw = "\n".join(names).encode()
    c, *_ = line_dedup.line_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert line_dedup.sizes(c).tolist() == size.tolist()
    keys = [set() for _ in names]
    for i, k in zip(*line_dedup.line_keys(c, 5), strict=True):
        keys[i].add(k)
    parts = line_dedup.sketches(c)
    far = lambda i, j: min(size[i], size[j]) >= line_dedup.SHORT_LINE and sum((int(h[i]) ^ int(h[j])).bit_count() for h in parts) > 72
    near = sum(bool(keys[i] & keys[j]) and not far(i, j) for i, j in pairs)
    assert len(pairs) > 40 and near >= 0.95 * len(pairs)


def test_line_dedup_short_and_unspaced(spark):
    first, copy = "今天天气很好，我们一起去公园散步吧。", "今天天气很好、我们一起去公园散步！"
    rows = [(1, "All rights reserved.\nand\n\n" + first), (2, "all rights, reserved\nand more\n\n" + copy), (3, "and\n" + first)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "and more\n", 3: ""}


def test_toxicity_disguises(spark):
    plain = "what a moron he is and you idiot are so stupid that the trash was a good read for you and a man "
    restore = toxicity.Restorer(toxicity.language_model(spark.createDataFrame([(plain * 50,)], "text string")))
    sentence = " ".join("you are so stupid that the trash was good and you idiot are a moron he is and was a man".replace(" ", ""))
    cases = {
        "a m o r o n": "moron", "y o u i d i o t": "idiot", "i  d  i  o  t": "idiot", "m o r @ n s t u p ! d": "stupid", sentence: "idiot",
        "ssttuuppiidd": "stupid", "Iiddiioott": "idiot", "i--d--i--o--t": "idiot", "y.o.u.i.d.i.o.t": "idiot", "idi" + "o" * 200 + "t": "idiot",
    }
    assert [c for c, word in cases.items() if word not in restore.words(f"well {c} then")] == []
    assert len(sentence) > 128
    assert restore.words("x1" * 100_000)


INSULTS = ["idiot", "moron", "stupid", "pathetic", "dumbass"]
_PAIRS = dict(zip("oieast", "013457", strict=True))
DISGUISES = {
    "digits": lambda w: "".join(_PAIRS.get(c, c) for c in w),
    "signs": lambda w: w.replace("a", "@").replace("s", "$").replace("i", "!"),
    "two words": lambda w: f"{w[:2]} {w[2:]}",
    "pieces": lambda w: f"{w[0]} {w[1]} {w[2:]}",
    "full stop": lambda w: f"{w[:3]}.{w[3:]}",
    "hyphen": lambda w: f"{w[:3]}-{w[3:]}",
    "repeated": lambda w: w[:2] + w[1] * 4 + w[2:],
    "other script": lambda w: w.replace("i", "\u0456").replace("o", "\u043e").replace("a", "\u0430"),
    "marks": lambda w: w.replace("i", "\u00ef").replace("o", "\u00f5").replace("a", "\u00e3"),
    "unseen": lambda w: f"{w[:2]}\u200b{w[2:]}",
    "full width": lambda w: "".join(chr(ord(c) + 0xFEE0) for c in w),
}


def test_toxicity_planted_disguises(spark):
    """Of each kind of disguise, none of which is in what is learnt, nine in ten are caught; clean texts stay clean."""
    plain = "the meeting began at nine and the report of the year was read before the men of the station left for the sea it is on a us as so to id"
    rows = [(str(i), f"{i} {plain} you are a {INSULTS[i % 5]}" if i % 4 == 0 else f"{i} {plain} you are a friend", int(i % 4 == 0)) for i in range(400)]
    learnt = spark.createDataFrame(rows, "doc_id string, text string, toxic int")
    planted = [(f"{kind}/{w}", f"well the {disguise(w)} was here") for kind, disguise in DISGUISES.items() for w in INSULTS]
    clean = [(f"clean/{i}", t) for i, t in enumerate(["it is an id it saw at 10:30 on 2024-05-06", "the well-known 3rd report, 5h17 and 1d on", "mo and ron are here", "so to the sea", "", None])]
    got = toxicity.score_toxicity(spark.createDataFrame([*planted, *clean], "doc_id string, text string"), learnt.select("doc_id", "toxic"), corpus=learnt.select("doc_id", "text")).collect()
    caught = {kind: sum(r.toxicity >= 0.5 for r in got if r.doc_id.startswith(f"{kind}/")) for kind in [*DISGUISES, "clean"]}
    assert caught.pop("clean") == 0
    assert {k: n for k, n in caught.items() if n < len(INSULTS) - 1} == {} and sum(caught.values()) >= 0.9 * len(planted)


def test_decontaminate_seeds_reach_the_rule():
    """Every choice of substituted words that leaves 75 % of a window equal is hit by a seed."""
    for n in range(5, 17):
        width = min(n, 13)
        words = " ".join(f"w{i}" for i in range(n))
        index = decontaminate.Index([(1, words)], 5)
        for gone in itertools.combinations(range(width), width - -(-75 * width // 100)):
            text = " ".join("x" if i in gone or i >= width else f"w{i}" for i in range(n)).encode()
            found = decontaminate.hash_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 0, decontaminate._WORD, decontaminate.LETTERS_DIGITS).hash
            hits = index.hits(found, np.zeros(len(found), int)).tolist()
            assert [0, 0, 0] in hits and decontaminate.overlap(index.words[0], found, 0, 0, n, 13, 75)[0], (n, gone)


def test_line_dedup_makes_a_pair_once(spark):
    """Lines that share several lists, some repeated there, most outside the largest component, are paired in one of them."""
    rows = [(k, i, i % 9 if i > 4 else 0, 0) for k in range(6) for i in range(40) if (i + k) % 5]
    df = spark.createDataFrame(rows + rows[::3], "list long, lid long, component long, most long")
    want = {(i, j) for k, i, c, _ in rows for l, j, d, _ in rows if k == l and i < j and c != d}
    got = list(map(tuple, line_dedup.pairs_apart(df, lambda x, y: F.col(x + "lid") != F.col(y + "lid")).collect()))
    assert set(got) == want and len(got) == len(want)


def test_line_dedup_edit_similarity():
    """The alignment of words and the early stop decide as the full distance does."""
    rng = random.Random(11)

    def full(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], min(last + (x != y), row[j + 1] + 1, row[j] + 1)
        return row[-1]

    for _ in range(1500):
        letters = rng.choice(["ab ", "abc  de ", "aé漢字 😀"])
        a = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 9, 30, 64, 70])))
        b = list(a)
        for _ in range(rng.randrange(1 + len(a) // 3 + 1)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(3)] = rng.choice(["", rng.choice(letters), "a b"])
        b = "".join(b)
        d = full(a, b)
        assert line_dedup.edit_distance(a, b) == d
        for percent in (50, 70, 80, 90):
            assert line_dedup.similar(a, b, percent) == (100 * d <= (100 - percent) * max(len(a), len(b)))
        limit = rng.randrange(len(a) + 2)
        assert (line_dedup.edit_distance(a, b, limit) <= limit) == (d <= limit)
        assert d <= limit or not line_dedup.words_align(a.split(" "), b.split(" "), limit)


def test_line_dedup_lists_in_tasks_as_joined(spark):
    """The pairs of a list are the same from one task as from the join, in many batches too."""
    rng = random.Random(5)
    lines = [(i, rng.randrange(60, 400), *(rng.choice([0, 7, 2**59 - 1, rng.getrandbits(60)]) for _ in range(4)), i % 50) for i in range(400)]
    rows = [(k, *x, 0) for k in range(9) for x in lines if rng.random() < 0.5]
    side = "lid long, size int, sim0 long, sim1 long, sim2 long, sim3 long"
    df = spark.createDataFrame(rows, f"list long, {side}, component long, most long")

    def near(x, y):
        bits = sum(F.bit_count(F.col(x + s).bitwiseXOR(F.col(y + s))) for s in line_dedup.SIMS)
        low, high = F.least(x + "size", y + "size"), F.greatest(x + "size", y + "size")
        return (100 * low >= 80 * high) & ((low < 80) | (bits <= F.when(low < 300, 72).otherwise(64)))

    want = sorted(map(tuple, line_dedup.pairs_apart(df, near).collect()))
    got = sorted(map(tuple, line_dedup.pairs_of_lists(df, 72, 80).collect()))
    assert got == want and len(want) > 1000
    near_too = {(min(x[1], y[1]), max(x[1], y[1])) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1]}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = sorted(map(tuple, line_dedup.pairs_of_lists(df, 72, 80).collect()))
        short = sorted(map(tuple, line_dedup.pairs_of_short_lists(df.drop("component", "most"), 72, 80).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert again == want and set(want) <= set(short) <= near_too and len(short) == len(set(short))


def test_line_dedup_reads_texts_once(spark, monkeypatch):
    """Lists of more lines than meet at once are tried in turns; the texts of their lines are read in one pass over docs."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(400)]
    base = [rng.choice(words) for _ in range(20)]
    rows = [(i, "\n".join(" ".join(base[:12] + [rng.choice(words) for _ in range(1 if i % 2 else 8)]) for _ in range(3))) for i in range(60)]
    calls, real = [], line_dedup.line_texts
    monkeypatch.setattr(line_dedup, "line_texts", lambda *a: calls.append(1) or real(*a))
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()}
    assert len(calls) == 1
    lines = [(i, j, x) for i, text in rows for j, x in enumerate(text.split("\n"))]
    group = list(range(len(lines)))
    for p in range(len(lines)):
        for q in range(p):
            if group[p] != group[q] and line_dedup.similar(lines[p][2], lines[q][2], 80):
                group = [min(group[p], group[q]) if g in (group[p], group[q]) else g for g in group]
    lost = [i for k, (i, _, _) in enumerate(lines) if group[k] != k]
    assert sum(n for _, n in got.values()) >= 0.95 * len(lost) > 0
    assert all(got[i][1] <= lost.count(i) for i in got)


def test_line_dedup_distances_side_by_side():
    """Pairs compared all at once are decided as one by one: short and long, of few letters and of many."""
    rng = random.Random(23)
    a, b = ["", "", "x"], ["", "x", ""]
    for _ in range(3000):
        letters = rng.choice(["ab ", "abc  de ", "aé漢字 😀", "abcdefghijklmnopqrstuvwxyz    "])
        x = "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 9, 30, 63, 64, 65, 127, 128, 129, 200, 300])))
        y = list(x)
        for _ in range(rng.randrange(1 + len(x) // 3 + 1)):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randrange(3)] = rng.choice(["", rng.choice(letters), "a b"])
        a.append(x)
        b.append("".join(y) if rng.random() < 0.8 else "".join(rng.choice(letters) for _ in x))
    for percent in (50, 80, 90):
        want = [line_dedup.similar(x, y, percent) for x, y in zip(a, b, strict=True)]
        assert line_dedup.similar_pairs(a, b, percent).tolist() == want and 100 < sum(want) < len(want) - 100


def test_line_dedup_large_lists_in_tiles(spark, monkeypatch):
    """A list too large for one task goes by tiles, in which each pair meets once, and isn't joined with itself."""
    rng = random.Random(6)
    lines = [(i, rng.choice([60, 79, 80, 81, 99, 100, 101, 125, 126, 299, 301, rng.randrange(60, 400)]), *(rng.choice([0, 7, 2**59 - 1, rng.getrandbits(60)]) for _ in range(4)), i % 50) for i in range(400)]
    rows = [(k, *x, 0, k % 2 == 0) for k in range(6) for x in lines if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "list long, lid long, size int, sim0 long, sim1 long, sim2 long, sim3 long, component long, most long, large boolean")
    want = sorted(map(tuple, line_dedup.pairs_of_lists(df.drop("large"), 72, 80).collect()))
    for most in (5, 30, 1 << 14):
        monkeypatch.setattr(line_dedup, "LARGE", most)
        got = sorted(map(tuple, line_dedup.pairs_of_lists(df, 72, 80).collect()))
        assert got == want and len(want) > 1000
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(300)]
    base = [rng.choice(words) for _ in range(20)]
    docs = spark.createDataFrame([(i, " ".join(base[:12] + [rng.choice(words) for _ in range(1 if i % 2 else 8)])) for i in range(150)], "doc_id long, text string")
    want = sorted(map(tuple, line_dedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(line_dedup, "LARGE", 20)
    monkeypatch.setattr(line_dedup, "pairs_apart", None)
    assert sorted(map(tuple, line_dedup.dedup_lines(docs).collect())) == want and sum(r[-1] for r in want) > 0


def test_line_dedup_pairs_in_packs(spark, monkeypatch):
    """Pairs verified in packs of few lines, of texts that many pairs share, are those verified one by one."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc") for _ in range(4)) * 20 for _ in range(5)]
    texts = ["".join(rng.choice("xyz") if rng.random() < 0.12 else c for c in texts[i % 5]) for i in range(60)]
    norm = spark.createDataFrame(list(enumerate(texts)), "lid long, norm string")
    pairs = spark.createDataFrame([(i, j, len(texts[i]), len(texts[j])) for i in range(60) for j in range(i + 1, 60)], "a long, b long, size_a int, size_b int").coalesce(2)
    want = sorted(map(tuple, line_dedup.verified(pairs.select("a", "b"), norm, 80).collect()))
    for most in (2, 25, 1 << 13):
        monkeypatch.setattr(line_dedup, "PACKED_LINES", most)
        got = sorted(map(tuple, line_dedup.verified_in_packs(pairs, norm, 80).collect()))
        assert got == want and 0 < len(want) < 1770
