"""Streams: restart, replay, late rows, expired keys, and equality with batches."""

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import frequencies as K
from lineagrid.streaming import streams


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def feed(spark, folder, schema, *batches):
    """Files are read one a batch in the order of their times."""
    import os

    os.makedirs(folder, exist_ok=True)
    n = len(os.listdir(folder))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).toPandas().to_parquet(f"{folder}/{n:04d}.parquet", coerce_timestamps="us")
        os.utime(f"{folder}/{n:04d}.parquet", (1_700_000_000 + 10 * n,) * 2)
        n += 1
    return streams.stream_batches(spark, folder, spark.createDataFrame([], schema).schema, per_trigger=1)


def collected(spark, df, name, folder):
    q = df.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/c-{name}").trigger(availableNow=True).start()
    q.awaitTermination(180)
    return spark.read.parquet(f"{folder}/{name}")


def test_upsert_restarts_and_replays(spark, tmp_path):
    schema = "id string, n int, v string"
    t = str(tmp_path)
    run = lambda s, c="c": streams.upsert_first(s, f"{t}/out", "id", ["n"], f"{t}/{c}", buckets=8).awaitTermination(180)
    run(feed(spark, f"{t}/in", schema, [(f"k{i}", 1, "old") for i in range(200)], [("k3", 0, "later batch"), ("new", 2, "b"), ("new", 1, "a"), (None, 5, "n")]))
    read = lambda: {r.id: (r.n, r.v) for r in spark.read.parquet(f"{t}/out").collect()}
    want = {f"k{i}": (1, "old") for i in range(200)} | {"new": (1, "a"), None: (5, "n")}
    assert read() == want and spark.read.parquet(f"{t}/out").count() == len(want)
    # A restart goes on after what was read.
    run(feed(spark, f"{t}/in", schema, [("new", 0, "z"), (None, 0, "z"), ("k999", 7, "c")]))
    want["k999"] = (7, "c")
    assert read() == want and spark.read.parquet(f"{t}/out").count() == len(want)
    # A replay of everything from another checkpoint writes the same.
    run(streams.stream_batches(spark, f"{t}/in", spark.createDataFrame([], schema).schema, per_trigger=1), "c2")
    assert read() == want and spark.read.parquet(f"{t}/out").count() == len(want)


def test_upsert_reads_only_buckets_it_hits(spark, tmp_path):
    schema = "id string, n int"
    t = str(tmp_path)
    s = feed(spark, f"{t}/in", schema, [(f"k{i}", 1) for i in range(400)], [("k7", 2), ("brand new", 2)])
    streams.upsert_first(s, f"{t}/out", "id", ["n"], f"{t}/c", buckets=16).awaitTermination(180)
    filters = spark.read.parquet(f"{t}/out/_filters/batch=1")
    asked = spark.createDataFrame([(f"k{i}",) for i in range(400)] + [(f"x{i}",) for i in range(400)] + [("brand new",)], "id string").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int"))
    p = streams._positions("id")
    found = {r.id: r.hit for r in asked.join(filters, "bucket", "left").select("id", (streams._has_bit(F.col("bits"), p[0]) & streams._has_bit(F.col("bits"), p[1])).alias("hit")).collect()}
    assert all(found[f"k{i}"] for i in range(400)) and found["brand new"]
    assert sum(bool(found[f"x{i}"]) for i in range(400)) < 20


def test_first_seen(spark, tmp_path):
    t = str(tmp_path)
    s = feed(spark, f"{t}/in", "key string, n int", [("a", 2), ("a", 1), ("b", 5)], [("a", 0), ("c", 9), (None, 1)])
    rows = {(r.key, r.n) for r in collected(spark, streams.stream_first_seen(s, "key"), "first", t).collect()}
    assert rows == {("a", 1), ("b", 5), ("c", 9), (None, 1)}


def at(text):
    import datetime

    return datetime.datetime.fromisoformat(text)


def test_keys_expire(spark, tmp_path):
    t = str(tmp_path)
    day = lambda d: at(f"2024-01-{d:02d}")
    batches = [[("a", day(1), 1)], [("a", day(2), 2), ("b", day(8), 3)], [("b", day(9), 4)], [("a", day(20), 5), ("late", day(1), 6)], [("b", day(21), 7)]]
    s = feed(spark, f"{t}/in", "key string, ts timestamp, n int", *batches)
    got = {(r.key, r.n) for r in collected(spark, streams.stream_first_seen(s, "key", "ts", "1 day", 3 * 86400), "keep", t).collect()}
    # a is forgotten at the watermark of the 5th, b at that of the 12th; "late" came after the watermark of the 8th.
    assert got == {("a", 1), ("b", 3), ("a", 5), ("b", 7)}
    got = {(r.key, r.n) for r in collected(spark, streams.first_within(s, "key", "ts", "3 days"), "within", t).collect()}
    assert {("a", 1), ("b", 3), ("a", 5)} <= got and ("a", 2) not in got and ("b", 4) not in got and ("late", 6) not in got


def test_monthly_counts_equal_the_batch(spark, tmp_path):
    t = str(tmp_path)
    batches = [
        [("x", at("2023-11-05")), ("x", at("2023-11-30T23:59:59")), ("y", at("2024-01-10"))],
        [("x", at("2024-02-01")), ("x", at("2023-12-31"))],
        [("x", at("2024-06-15")), ("y", at("2024-02-02")), (None, at("2024-05-05"))],
        [("x", at("2023-11-07")), ("y", at("2024-06-30")), ("y", at("2024-06-01"))],
        [("end", at("2025-03-01"))],
    ]
    s = feed(spark, f"{t}/in", "k string, ts timestamp", *batches)
    counts = streams.stream_monthly_counts(s, "ts", ["k"], "40 days")
    streams.write_monthly_counts(counts, f"{t}/out", f"{t}/late", f"{t}/c").awaitTermination(180)
    got = {(r.k, str(r.month)): r.n for r in spark.read.parquet(f"{t}/out").collect()}
    late = {(r.k, str(r.month)): r.n for r in spark.read.parquet(f"{t}/late").collect()}
    assert late == {("x", "2023-11-01"): 1}
    on_time = spark.createDataFrame([r for b in batches for r in b if r != ("x", at("2023-11-07"))], "k string, ts timestamp")
    want = {(r.k, str(r.month)): r.n for r in K.monthly_counts(on_time.fillna({"k": "none"}), ["k"], "ts").collect() if r.k != "end"}
    assert {("none" if k is None else k, m): n for (k, m), n in got.items()} == want
    assert spark.read.parquet(f"{t}/out").count() == len(got)
    assert want["x", "2024-03-01"] == 0
