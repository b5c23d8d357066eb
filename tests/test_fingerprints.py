"""Fingerprints of multisets: repeated rows, nulls, deltas without a rescan, the buckets that changed."""

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import fingerprints as P
from lineagrid.operators import quality as U


def sums(df):
    return tuple(P.fingerprint(df).first())


def test_repeated_rows_tell_apart(spark):
    one, two = (spark.createDataFrame([(k,), (k,)], "x int") for k in (1, 2))
    assert sums(one) != sums(two)
    assert U.record_change(one, two).first().changed and not U.record_change(one, one).first().changed
    x = spark.createDataFrame([("a", None), (None, "a"), ("a", "a")], "p string, q string")
    assert len({sums(x.where(F.monotonically_increasing_id() == i)) for i in [r[0] for r in x.select(F.monotonically_increasing_id()).collect()]}) == 3
    assert sums(x.limit(0)) == (0, 0, 0)
    assert sums(x.select("q", "p")) == sums(x)  # columns by name
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS m"), spark.sql("SELECT map('b', 2, 'a', 1) AS m"), spark.sql("SELECT map('b', 1, 'a', 2) AS m")
    assert sums(maps[0]) == sums(maps[1]) != sums(maps[2])


def test_updates_need_no_rescan(spark):
    rows = spark.range(5000).select((F.col("id") % 700).alias("key"), (F.col("id") % 7).cast("string").alias("v"))
    bucket = P.bucket_of("key", 256)
    before = P.tree(rows, bucket, 16)
    gone = rows.where("key = 13 or key = 400")
    new = spark.createDataFrame([(13, "x"), (13, "x"), (9999, None)], "key long, v string")
    after = P.updated(before, new, gone, bucket, 16)
    want = P.tree(rows.where("key <> 13 and key <> 400").union(new), bucket, 16)
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, want.collect()))
    buckets = P.changed_buckets(after, before, 16)
    touched = {r[0] for r in gone.union(new).select(bucket).distinct().collect()}
    assert {r.bucket for r in buckets.collect()} == touched
    now = rows.where("key <> 13 and key <> 400").union(new)
    a, b = P.changed_rows(now, rows, buckets, bucket)
    assert b.count() < rows.count() / 10
    assert a.exceptAll(b).count() == now.exceptAll(rows).count() and b.exceptAll(a).count() == rows.exceptAll(now).count()
    everything = P.updated(before, None, rows, bucket, 16)
    assert everything.count() == 0
    assert P.changed_buckets(before, before, 16).count() == 0


def test_nested_diff(spark):
    a = spark.createDataFrame([(1, "x", {"ha": ["e1", "e2"], "na": ["e3"]}), (2, "y", None), (3, "z", {"ha": ["e9"]})], "id int, f string, seqs map<string,array<string>>")
    b = spark.createDataFrame([(1, "x", {"ha": ["e2", "e4"], "pb2": []}), (2, "", {"ha": ["e5"]}), (4, "w", {})], "id int, f string, seqs map<string,array<string>>")
    got = sorted(map(tuple, U.diff_records(a, b, "id", sets=["seqs"]).collect()), key=repr)
    assert got == sorted([
        (1, "seqs changed", "ha removed", "e1", None), (1, "seqs changed", "ha added", None, "e4"), (1, "seqs changed", "na removed", "e3", None),
        (2, "removed", "f", "y", None), (2, "seqs changed", "ha added", None, "e5"), (3, "removed record", None, None, None), (4, "added record", None, None, None),
    ], key=repr)


def test_weights(spark):
    d = spark.createDataFrame([(1, "a", "A"), (2, "a", None), (3, "q", "r")], "id int, was string, now string")
    same = F.lower("was") == F.lower("now")
    out = U.explain_weighted(d, [("typo", F.length("was") == F.length("now"), 1.0), ("case", same, 1.0), ("case", F.col("was") != F.col("now"), 0.5)])
    assert {r.id: (r.reason, r.weight, r.lead) for r in out.collect()} == {1: ("case", 1.5, 0.5), 2: ("unexplained", 0.0, None), 3: ("typo", 1.0, pytest.approx(0.5))}
