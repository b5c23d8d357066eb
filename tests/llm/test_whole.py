"""Registered corpus queries on a whole table against SQL, brute force, or held-out labels."""

import base64
import collections
import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lineagrid.llm import line_dedup, queries, quality_rules, token_rollup, toxicity
from tests.oracle import connect, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, data, name):
    return {r[0]: r for r in queries.queries()[name](spark, data).collect()}


def test_mixing_sql(spark, data):
    same(queries.op10_mixing(spark, data), connect(data), queries.oracle_sql()["op10_mixing"])


def components(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_minhash_brute_force(spark, data, docs):
    ids, sets = list(docs), []
    for t in docs.values():
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    group = components(len(ids), pairs)
    least = {}
    for i, g in enumerate(group):
        least[g] = min(least.get(g, ids[i]), ids[i])
    got = run(spark, data, "op4_minhash")
    assert {i: (len(sets[k]), least[group[k]]) for k, i in enumerate(ids)} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_line_dedup_brute_force(spark, data, docs):
    seen = collections.defaultdict(list)
    for i, t in docs.items():
        for n, line in enumerate((t or "").split("\n")):
            if len((norm := line_dedup.normalised(line.encode())).split()) >= 5:
                seen[norm].append((i, n))
    names = list(seen)
    pairs = [(i, j) for i in range(len(names)) for j in range(i) if 5 * min(len(names[i]), len(names[j])) >= 4 * max(len(names[i]), len(names[j])) and line_dedup.similar(names[i], names[j], 80)]
    group = components(len(names), pairs)
    first = {}
    for k, g in enumerate(group):
        first[g] = min(first.get(g, (1 << 60, 0)), *seen[names[k]])
    gone = {o for k, g in enumerate(group) for o in seen[names[k]] if o != first[g]}
    got = run(spark, data, "op1_line_dedup")
    # Keys miss a pair now and then; equal lines they never do.
    equal = {o for k in names for o in seen[k] if o != min(seen[k])}
    where = {i: (t or "").split("\n") for i, t in docs.items()}
    lost = {(i, n) for i, t in docs.items() for n in _lost(where[i], (got[i].text or "").split("\n"), got[i].n_dropped)}
    long = {o for o in lost if len(line_dedup.normalised(where[o[0]][o[1]].encode()).split()) >= 5}
    assert long <= gone and equal <= lost and len(long) >= 0.97 * len(gone)


def _lost(before, after, n):
    """Numbers of the lines that after lacks, where after is before less n lines."""
    out, k = [], 0
    for i, line in enumerate(before):
        if len(out) < n and (k >= len(after) or line != after[k] or len(before) - i <= n - len(out)):
            out.append(i)
        else:
            k += 1
    return out


def test_quality_rules_brute_force(spark, data, docs):
    got = run(spark, data, "op2_quality_rules")
    good = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()}
    size = 1 << 16

    def grams(w):
        one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        pack = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
        signed = [x - (1 << 64) if x >> 63 else x for x in [*one, *(pack(a, b) for a, b in zip(one, one[1:], strict=False))]]
        return [x % size for x in signed]

    raw, target = collections.Counter(), collections.Counter()
    for i, t in docs.items():
        raw.update(g := grams(WORD.findall(t or "")))
        if i in good:
            target.update(g)
    import math

    scale = sum(target.values()) / sum(raw.values())
    for i, t in docs.items():
        w = WORD.findall(t or "")
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {k + d for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for d in range(8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        g = grams(w)
        score = sum(math.log(target[b] + 2) - math.log(raw[b] * scale + 2) for b in g) / len(g) if g else 0.0
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered), failed)
        assert r.n_symbols == sum((t or "").count(c) for c in quality_rules.SYMBOLS)
        assert r.quality_llr == pytest.approx(score, abs=1e-9) and r.kept == (not failed and r.quality_llr >= -0.1)


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.8), ("op5_quality_classifier", "quality", 0.95)])
def test_held_out(spark, name, label, least):
    data = "/root/testdata/sf0.01"
    held = queries.queries()[name](spark, data).where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").select("score", label).collect()
    one, zero = [r.score for r in held if r[label] == 1], [r.score for r in held if r[label] == 0]
    assert sum((a > b) + (a == b) / 2 for a in one for b in zero) / (len(one) * len(zero)) >= least


def test_restoring(spark, data):
    docs = spark.createDataFrame([("what an idiot he is and the moron said it was trash " * 50,)], "text string")
    restore = toxicity.Restorer(toxicity.language_model(docs))
    for disguised, word in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n!!", "moron"), ("tr@sh", "trash"), ("i d i o t", "idiot"), ("plain", "plain")):
        assert word in restore.words(f"he {disguised} was")


def test_pii_base(spark, data, docs):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, m):
        d = [int(c) for c in m if c.isdigit()]
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    got = run(spark, data, "op6_pii")
    for i, t in docs.items():
        base = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, t or "") if passes(kind, m[0]))
        text = ",".join(f"{kind}:{a}:{z}" for a, _, kind, z in base)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[1] == k for x in base) for k in range(4))
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_html_articles(spark, data):
    import html

    got = run(spark, data, "op7_html_text")
    for r in spark.read.parquet(f"{data}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inside[1])) if inside else []
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_tokens_brute_force(spark, data):
    import tiktoken

    with open(token_rollup.TOKENIZERS["byte_bpe_50k"], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=token_rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, seen = collections.Counter(), set()
    for r in sorted(spark.read.parquet(f"{data}/documents.parquet").collect(), key=lambda r: r.doc_id):
        if r.text not in seen:
            seen.add(r.text)
            short = "\n".join(dict.fromkeys(r.text.split("\n")))
            want[r.source, r.lang, "byte_bpe_50k"] += len(encoding.encode_ordinary(short))
            want[r.source, r.lang, "words"] += len(WORD.findall(short))
    got = {(r.source, r.lang, r.tokenizer): r.n_tokens for r in queries.op8_token_rollup(spark, data).collect()}
    assert got == dict(want)


def test_decontaminate_brute_force(spark, data, docs):
    words = lambda t: re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    got = run(spark, data, "op9_decontaminate")
    for i, t in docs.items():
        w, hit = words(t), []
        for k, item in items.items():
            width = min(13, len(item))
            for d in range(-len(item), len(w)):
                same_words = [0 <= d + j < len(w) and w[d + j] == x for j, x in enumerate(item)]
                if 100 * sum(same_words) >= 75 * width and any(100 * sum(same_words[j : j + width]) >= 75 * width for j in range(len(item) - width + 1)):
                    hit.append(k)
                    break
        assert list(got[i]["items"]) == sorted(hit) and got[i].kept == (not hit)


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        assert set(docs.columns) <= set(out.columns)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        kept = out.count()
        assert 0 < kept <= n
        n, docs = kept, out
    assert docs.where(F.col("copies") < 1).count() == 0
