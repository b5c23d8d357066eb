"""SimHash, collocations and runs against brute force, with edges."""

import hashlib
import os
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from lineagrid.llm import collocations, queries, runs, simhash
from tests.oracle import connect, same

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


@pytest.fixture(scope="module")
def documents(data):
    return pq.read_table(f"{data}/documents.parquet").to_pylist()


def smallest_reachable(keys, linked):
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        parent[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        least[root(i)] = min(k, least.get(root(i), k))
    return [least[root(i)] for i in range(len(keys))]


def plain_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(len(w) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, data, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op11_simhash(spark, data).collect()}
    fps = [plain_fingerprint(d["text"]) for d in documents]
    keys = [d["doc_id"] for d in documents]
    want = smallest_reachable(keys, [(i, j) for i, j in combinations(range(len(keys)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert got == {k: (f"{f:016x}", c) for k, f, c in zip(keys, fps, want, strict=True)}
    assert len(got) == len(documents)


@pytest.mark.parametrize("size", [40, 900])
def test_lists_link_what_all_pairs_link(size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 2**64, dtype=np.uint64) & ~np.uint64(0xFFFF)
    fps = base | rng.choice(1 << 16, size, replace=False).astype(np.uint64)
    near = [(i, j) for i, j in combinations(range(size), 2) if int(fps[i] ^ fps[j]).bit_count() <= 2]
    at = {int(f): i for i, f in enumerate(fps)}
    links = [(at[a], at[b]) for a, b in simhash.list_links(fps, 2)]
    assert set(links) | {(b, a) for a, b in links} <= set(near) | {(b, a) for a, b in near}
    assert smallest_reachable(range(size), links) == smallest_reachable(range(size), near)
    assert len(links) < size


def test_every_link_shares_a_list(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    fps = [base] + [base ^ (1 << i) ^ (1 << j) for i, j in combinations(range(64), 2)]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = simhash.components(simhash.links(simhash.posting_lists(df, 2), 2))
    assert found.count() == len(fps) and found.select("component").distinct().count() == 1


def test_simhash_edges(spark):
    rows = [(1, WORDS, 0), (5, WORDS.upper(), 0), (5, WORDS.upper(), 0), (2, None, 0), (3, "", 0), (4, " \n", 0), (None, WORDS, 0), (6, "one two", 0), (7, "ONE\ttwo", 0), (8, "w " * 200_000, 0), (9, "w", 0)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, fp int, component_id string, key string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(1, 1), (5, 1), (2, 2), (3, 2), (4, 2), (None, 1), (6, 6), (7, 6), (8, 8), (9, 9)}
    assert simhash.near_duplicates(docs).count() == len(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert {r.component_id for r in simhash.near_duplicates(docs.where("doc_id is null")).collect()} == {None}


def test_collocations_equal_sql(spark, data):
    df = queries.op12_collocations(spark, data)
    assert df.count() > 50
    same(df, connect(data), queries.oracle_sql()["op12_collocations"])


def test_partitions_are_counts():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 60_000).astype(np.uint64) % np.uint64(500)
    at = np.flatnonzero(rng.random(len(ids) - 2) < 0.8)
    for depth in (1, 2, 3):
        first, size = collocations.partitions(ids, at, depth)
        keys = np.stack([ids[at + i] for i in range(depth)], 1)
        want = {tuple(k): n for k, n in zip(*np.unique(keys, axis=0, return_counts=True), strict=True)}
        assert {tuple(ids[f : f + depth]): n for f, n in zip(first, size, strict=True)} == want
    assert len(collocations.partitions(ids, at[:0], 2)[0]) == 0


def test_collocations_edges(spark, tmp_path):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("New York. New York, NEW YORK", None)] * 4 + [("new york " * 3 + "\n a b c\vd e", "und")] * 2 + [("", "en"), (None, "en"), ("?!.,", "fr"), ("é É x\ty " * 4000, "fr")] + [("ı K ﬀ z", "")] * 11)]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, lang string, n int, word int").repartition(3)
    docs.select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    con = connect(os.environ.get("TEST_DATA", "/root/testdata/sf0.001"))
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    same(collocations.mine(docs), con, queries.oracle_sql()["op12_collocations"])
    assert collocations.mine(docs.limit(0)).count() == 0
    assert collocations.mine(docs.where("lang = 'en'")).count() == 0
    assert collocations.mine(docs, top=1).count() == 3


def plain_phrases(texts, most, least=10, inside=50):
    """{phrase: (a, l, r, score)} of texts of one language without capitals."""
    f = {}
    for text in texts:
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = piece.split()
            for size in range(1, most + 1):
                for i in range(len(w) - size + 1):
                    f[tuple(w[i : i + size])] = f.get(tuple(w[i : i + size]), 0) + 1
    candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
    held = lambda p: any(len(q) > len(p) and 100 * b >= inside * candidates[p] and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
    cut = lambda p, a: min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
    return {" ".join(p): (a, f[p[: cut(p, a)[1]]], f[p[cut(p, a)[1] :]], cut(p, a)[0]) for p, a in candidates.items() if not held(p)}


def test_collocations_of_four_words(spark):
    texts = ["a b c d. x b c e"] * 10 + ["b c. a b. c d. b c d; q a b c d e"] * 15 + ["a a a a a a b"] + ["m n. n m; a"] * 12
    docs = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "'en' as lang")
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in collocations.mine(docs, max_words=4).collect()}
    assert got == plain_phrases(texts, 4)
    assert any(len(p.split()) == 4 for p in got) and any(len(p.split()) == 2 for p in got)


def plain_runs(words, least=6, periods=4):
    found = {}
    n = len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_runs_equal_brute_force(spark, data, documents):
    got = {r.doc_id: r for r in queries.op13_runs(spark, data).collect()}
    assert len(got) == len(documents)
    some = 0
    for d in documents:
        words = planted(d["doc_id"], d["text"])
        found = plain_runs(words)
        r = got[d["doc_id"]]
        assert r.n_runs == len(found), d["doc_id"]
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda x: (x[0], x[2]))))
        assert r.collapsed_sha256 == sha(collapsed(words, found))
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        some += bool(found)
    assert some > 5


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_runs(letters):
    rng = np.random.default_rng(letters)
    for trial in range(150):
        texts = []
        for _ in range(rng.integers(1, 5)):
            words = []
            for _ in range(rng.integers(0, 6)):
                word = rng.integers(0, letters, rng.integers(1, 14)).tolist()
                words += word * int(rng.integers(1, 8))
                words += word[: rng.integers(0, len(word) + 1)]
            texts.append([b"%d" % w for w in words])
        for words, (found, left) in zip(texts, runs._search(texts, 6, 4), strict=True):
            want = plain_runs(words)
            assert [(x["start"], x["length"], x["period"]) for x in found] == sorted(want, key=lambda x: (x[0], x[2])), (trial, words)
            assert left.decode() == collapsed([w.decode() for w in words], want)


def test_successors():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 100, 1000):
        values = rng.permutation(2 * n)[:n]
        tree = runs.WaveletTree(values)
        lo = rng.integers(0, n, 50)
        hi = np.minimum(lo + rng.integers(1, n + 1, 50), n)
        least = rng.integers(0, 4 * n, 50)
        first, second = tree.successors(lo, hi, least)
        for a, z, x, f, g in zip(lo, hi, least, first, second, strict=True):
            have = [*sorted(v for v in values[a:z] if v >= x), -1, -1]
            assert (f, g) == (have[0], have[1])


def test_runs_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "x " * 5), (5, "x " * 6), (5, "x " * 6), (None, "A a " * 4), (6, "x " * 300_000), (7, ("p q r s t " * 60_000) + "end"), (8, "é b " * 6)]
    docs = spark.createDataFrame([(*r, "r", "k", 1) for r in rows], "doc_id long, text string, runs string, key string, n_words int").repartition(3)
    out = runs.collapse_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=str)
    none = [(i, 0, [], "") for i in (1, 2, 3)]
    assert got == sorted([*none, (4, 5, [], "x x x x x"), *[(5, 6, [(0, 6, 1)], "x")] * 2, (None, 8, [(0, 8, 2)], "A a"), (6, 300_000, [(0, 300_000, 1)], "x"), (7, 300_001, [(0, 300_000, 5)], "p q r s t end"), (8, 6, [(0, 6, 1)], "é b")], key=str)
    assert runs.collapse_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.collapse_runs(docs, periods=3)
