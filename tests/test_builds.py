"""Build matrices, quotas, draws; the similarity join and the block comparison against plain versions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lineagrid.functions.scalars import simplify_name
from lineagrid.operators import builds as B
from lineagrid.operators import link as J
from lineagrid.operators import sequences as Q
from lineagrid.operators import windows as W
from lineagrid.plans import catalog


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(
        F.col("id"), (F.col("id") % 5).cast("string").alias("region"), F.element_at(F.array(F.lit("h1"), F.lit("h3"), F.lit("vic")), (F.col("id") % 3 + 1).cast("int")).alias("lineage"),
        (F.floor(F.sqrt("id")) % 12).alias("month"), F.when(F.col("id") % 50 > 0, F.col("id") % 7).alias("titers"),
    )


def plain_subsample(rows, most):
    """Even quotas over (region, month), one more for the first groups, higher titers first, then the MD5 of the id."""
    groups = {}
    for r in rows:
        groups.setdefault((r.region, r.month), []).append(r)
    quota = max((q for q in range(most + 1) if sum(min(len(g), q) for g in groups.values()) <= most), default=0)
    left = most - sum(min(len(g), quota) for g in groups.values())
    taken = set()
    for name in sorted(groups):
        more = len(groups[name]) > quota and left > 0
        left -= more
        order = sorted(groups[name], key=lambda r: (r.titers is None, -(r.titers or 0), hashlib.md5(f"{r.id}0".encode()).hexdigest(), r.id))
        taken |= {r.id for r in order[: quota + more]}
    return taken


def test_twenty_builds_in_one_plan_equal_their_own(spark, rows):
    table = B.matrix(spark, {"lineage": ["h1", "h3", "vic", None], "region": ["0", "1", "2", "3", None]}, "{lineage}_{region}", lambda lineage, region: 40 if lineage == "h3" else 75, since=lambda lineage, region: 3 if region == "1" else 0)
    assert table.count() == 20
    matched = B.match(rows, table, {"lineage": "lineage", "region": "region"}, F.col("month") >= F.col("b_since"))
    got = {}
    for r in B.subsample_builds(matched, ["region", "month"], "id", F.col("titers")).collect():
        got.setdefault(r.build, set()).add(r.id)
    every = rows.collect()
    for b in table.collect():
        own = [r for r in every if r.month >= b.since and b.lineage in (None, r.lineage) and b.region in (None, r.region)]
        assert got[b.build] == plain_subsample(own, b.max_rows), b.build
    alone = W.subsample(rows.where("lineage = 'h3' and region = '2'"), ["region", "month"], 40, "id", F.col("titers"))
    assert {r.id for r in alone.collect()} == got["h3_2"]


def test_matrix_names_and_writes(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="one name"):
        B.matrix(spark, {"a": [1, 2]}, "same")
    table = B.matrix(spark, {"lineage": ["h1", "vic"]}, "b_{lineage}")
    every = B.subsample_builds(B.match(rows, table, {"lineage": "lineage"}), ["month"], "id")
    B.write_builds(every, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.build, r["count"]) for r in back.groupBy("build").count().collect()} == {("b_h1", 1000), ("b_vic", 1000)}
    assert B.subsample_builds(B.match(rows.limit(0), table, {"lineage": "lineage"}), ["month"], "id").count() == 0


def test_draws_come_near_the_cap(spark):
    groups = spark.range(20_000).select(F.col("id"), (F.col("id") % 4000).alias("g"))
    sizes = [W.subsample(groups, ["g"], 1000, "id", seed=str(s), probabilistic=True).count() for s in range(2)]
    assert all(abs(n - 1000) < 3 * 1000**0.5 for n in sizes) and len(set(sizes)) > 1
    again = [sorted(r.id for r in W.subsample(df, ["g"], 1000, "id", seed="0", probabilistic=True).collect()) for df in (groups, groups.repartition(7))]
    assert again[0] == again[1] and len(again[0]) == sizes[0]
    # Some groups give more than one, none more than it has; with groups enough for the cap it is the even quota.
    per = W.subsample(groups, ["g"], 1000, "id", probabilistic=True).groupBy("g").count()
    assert 1 < per.agg(F.max("count")).first()[0] <= 5
    assert W.subsample(groups, ["g"], 9000, "id", probabilistic=True).count() == 9000
    assert W.subsample(groups, ["g"], 1000, "id").count() == 1000


def test_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "id int, g string")
    assert W.subsample(df, ["g"], 4, "id").count() == 4
    assert {r.id for r in W.subsample(df, ["g"], 99, "id").collect()} == {1, 2, 3, 4, 5}


def test_fuzzy_join_equals_all_pairs(spark):
    stems = ["brisbane", "brisbne", "brizbane", "singapore", "singapour", "sngapore", "sydney", "ab", "a", "", "abc", "abd", "abcd", "zzzzzzzzzz", "zzzzzzzzz", "new caledonia", "newcaledonia", "new-caledonja"]
    made = [f"A/{s.title()}/{k}" for s in stems for k in ("", "12", "0012", "20")] + stems + [s + "-egg" for s in stems] + [None, "é", "è"]
    names = spark.createDataFrame([(m,) for m in made], "n string")
    queries = names.withColumnRenamed("n", "q")
    key = lambda c: F.struct(F.translate(F.regexp_replace(c, "[^0-9]", ""), "0", ""), c.endswith("-egg"))
    both = queries.distinct().crossJoin(names.distinct()).where(key(F.col("q")) == key(F.col("n")))
    x, y = simplify_name(F.col("q")), simplify_name(F.col("n"))
    near = both.withColumn("s", F.round(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1)), 6))
    for least in (0.8, 0.5, 1.0):
        got = {(r.q, r.n, r.similarity) for r in J.fuzzy_candidates(queries, names, "q", "n", least, 1000).collect()}
        assert got == {(r.q, r.n, r.s) for r in near.where(F.col("s") >= least).collect()}, least
    assert J.fuzzy_candidates(queries, names, "q", "n", k=2).groupBy("q").count().agg(F.max("count")).first()[0] == 2


def test_fuzzy_join_makes_few_pairs(spark):
    names = spark.range(4000).select(F.concat(F.lit("A/"), F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789", "ghijklmnop").substr(1, 14)).alias("n"))
    queries = names.limit(50).withColumnRenamed("n", "q")
    assert J.fuzzy_pairs(queries, names, "q", "n").count() < 50 * 4000 / 20


def test_hamming_blocks(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK_ROWS", 7)
    monkeypatch.setattr(Q, "BLOCK_QUERIES", 3)
    rows = [(i, "2020-01-01" if i % 3 else "2020-02-01", "ACGT"[i % 4] * (i % 5) + "é" * (i % 2)) for i in range(40)] + [(98, None, "A"), (99, "2020-01-01", None), (97, "2021-01-01", "alone")]
    df = spark.createDataFrame(rows, "s int, t string, q string").withColumn("t", F.to_date("t"))
    plain = lambda x, y: sum(a != b for a, b in zip(x, y)) + abs(len(x) - len(y))  # noqa: E731, B905
    for months in (0, 1):
        later = {"2020-01-01": {"2020-01-01", "2020-02-01"} if months else {"2020-01-01"}, "2020-02-01": {"2020-02-01"}}
        want = sorted((a, b, plain(x, y)) for a, t, x in rows[:40] for b, u, y in rows[:40] if a != b and u in later[t] and a % 2 == 0)
        assert sorted(map(tuple, Q.pairwise_hamming(df, "t", months, "s", "q", F.col("s") % 2 == 0).collect())) == want
    assert Q.pairwise_hamming(df.limit(0), "t", 1, "s", "q").count() == 0


def test_hamming_shuffles_no_pairs(spark, data):
    """What is shuffled is rows; pairs, of which there may be thousands a row, go on as they are made, one for each two rows."""
    rows = [(1, "2020-01-01", "AC"), (1, "2020-01-01", "AC"), (2, "2020-01-01", "AG" * 200), (1, "2020-02-01", "AC"), (3, "2020-02-01", "AC")]
    df = spark.createDataFrame(rows, "s int, t string, q string").withColumn("t", F.to_date("t"))
    got = Q.pairwise_hamming(df, "t", 1, "s", "q", F.col("s") == 1)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 399)] * 2 + [(1, 3, 0)] * 3
    for df in (got, catalog.queries()["pairwise_hamming"](spark, data)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan[: plan.index("FlatMapGroupsInArrow")]


def test_site_counts(spark, monkeypatch):
    monkeypatch.setattr(Q, "COUNTED", 5)
    df = spark.createDataFrame([("AC", 1.0), ("é\U0001f600C", 2.0), ("", 5.0), (None, 7.0), ("A", None)], "s string, w double")
    assert sorted(map(tuple, Q.site_counts(df, "s", F.col("w")).collect())) == [(1, "A", 1.0), (1, "é", 2.0), (2, "C", 1.0), (2, "\U0001f600", 2.0), (3, "C", 2.0)]
    assert sorted(map(tuple, Q.site_counts(df, "s").collect()))[0] == (1, "A", 2.0)
    assert Q.site_counts(df.limit(0), "s").count() == 0
