"""Climbing trees against the closure and against plain walks, to a depth that the closure could not take."""

import random

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import trees as T

SCHEMA = "node long, parent long, is_terminal boolean, preorder long, v double"


def table(spark, parents):
    inner = set(parents.values())
    return spark.createDataFrame([(n, p, n not in inner, n, float(n % 13) - 3) for n, p in parents.items()], SCHEMA)


@pytest.fixture(scope="module")
def forest(spark):
    """Two random trees, and one node whose parent isn't there."""
    rng = random.Random(4)
    parents = {0: None, 500: None} | {n: rng.randrange(max(0, n - 30), n) for n in range(1, 300)} | {n: rng.randrange(500, n) for n in range(501, 560)}
    return parents, table(spark, parents)


def up(parents, n):
    while n is not None:
        yield n
        n = parents[n]


def test_climbing_equals_walking(spark, forest):
    parents, edges = forest
    sums = {r.node: r.total for r in T.path_sum(edges, edges, "v").collect()}
    assert sums == {n: sum(float(m % 13) - 3 for m in up(parents, n)) for n in parents}
    marks = edges.where("node % 7 = 3").select("node", F.concat(F.lit("m"), F.col("node").cast("string")).alias("mark"))
    near = {r.node: r.mark for r in T.nearest(edges, marks, "mark").collect()}
    assert near == {n: f"m{w}" for n in parents if (w := next((m for m in up(parents, n) if m % 7 == 3), None)) is not None}
    for hops in (0, 1, 5, 12):
        at = {r.node: r.ancestor for r in T.ancestor_at(edges, hops).collect()}
        assert at == {n: line[hops] for n in parents if len(line := list(up(parents, n))) > hops}
    rng = random.Random(1)
    pairs = [(rng.choice(list(parents)), rng.choice(list(parents))) for _ in range(300)] + [(7, 7), (0, 299), (299, 0), (3, 520)]
    got = {(r.a, r.b): r.common for r in T.common_ancestors(edges, spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {(a, b): next((m for m in up(parents, a) if m in set(up(parents, b))), None) for a, b in pairs}
    assert got == {k: m for k, m in want.items() if m is not None}


def test_keys_and_missing_values(spark):
    edges = spark.createDataFrame([(1, None, False, 0), (2, 1, False, 1), (3, 2, True, 2), (4, 99, True, 3)], "node int, parent int, is_terminal boolean, preorder int")
    branches = spark.createDataFrame([(1, "a", 1.0), (3, "a", 2.0), (3, "a", 0.5), (2, "b", None), (4, "b", 7.0)], "node int, k string, v double")
    got = sorted((r.node, r.k, r.total) for r in T.path_sum(edges, branches, "v", ["k"]).collect())
    assert got == [(1, "a", 1.0), (2, "a", 1.0), (2, "b", 0.0), (3, "a", 3.5), (3, "b", 0.0), (4, "b", 7.0)]
    assert T.path_sum(edges, branches.limit(0), "v").count() == 0
    assert T.path_sum(edges.limit(0), branches, "v", ["k"]).count() == 0


def test_star(spark):
    edges = spark.range(5000).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.lit(0)).cast("long").alias("parent"), F.lit(1).alias("v"))
    assert {(r.total, r["count"]) for r in T.path_sum(edges, edges, "v").groupBy("total").count().collect()} == {(1, 1), (2, 4999)}


def test_ladder_of_100_000_nodes(spark):
    n = 100_000
    edges = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1).alias("v")).repartition(4)
    sums = T.path_sum(edges, edges, "v")
    assert sums.where("total <> node + 1").count() == 0 and sums.count() == n
    assert sum(x.count() for x in T.lifts(edges)) < n * 17
    pairs = spark.range(0, n, 997).select(F.col("id").alias("a"), (n - 1 - F.col("id")).alias("b"))
    got = T.path_distance(edges, edges, "v", pairs)
    assert got.count() == pairs.count() and got.where("distance <> abs(a - b)").count() == 0


def test_pruning_to_what_all_have(spark):
    a = table(spark, {0: None, 1: 0, 2: 0, 3: 1, 4: 1, 5: 2})
    b = table(spark, {0: None, 1: 0, 3: 1, 6: 1, 5: 0})
    x, y = T.prune_to_common([(e, T.closure(e)) for e in (a, b)])
    assert sorted(r.node for r in x.collect()) == [0, 1, 2, 3, 5] and sorted(r.node for r in y.collect()) == [0, 1, 3, 5]
