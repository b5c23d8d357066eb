"""Operators that the catalogue's SQL doesn't reach: files, trees, linking, streams."""

import os

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import curate as C
from lineagrid.operators import link as J
from lineagrid.operators import sequences as Q
from lineagrid.operators import trees as T
from lineagrid.operators import windows as W
from lineagrid.operators.fingerprints import fingerprint
from lineagrid.sources import files
from lineagrid.streaming import streams


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fasta_and_items(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a first\nacg\nt\n>b\nNN-\n")
    (tmp_path / "items.txt").write_text("a # note\n\n#all\n b\n")
    (tmp_path / "t.tsv").write_text("# c\nx\ty\n1\t\n")
    assert rows(files.read_fasta(spark, str(tmp_path / "x.fasta"))) == [("a", "a first", "ACGT"), ("b", "b", "NN-")]
    assert rows(files.read_items(spark, str(tmp_path / "items.txt"))) == [("a",), ("b",)]
    assert rows(files.read_table(spark, str(tmp_path / "t.tsv"))) == [("1", "")]


def test_json_sources(spark, tmp_path):
    (tmp_path / "n.json").write_text('{"nodes": {"a": {"x": 1}, "b": {"x": "y"}}}')
    (tmp_path / "f.json").write_text('{"pivots": [1.0, 2.0], "a": {"frequencies": [0.1, 0.9]}}')
    (tmp_path / "t.json").write_text('{"titers": {"r": {"s": {"u": [1.5, 80]}}}}')
    (tmp_path / "m.json").write_text('{"name": "w", "default": 0, "map": {"HA1": {"145": 1, "3": [{"from": "A", "to": "B", "weight": 0.5}]}}}')
    assert rows(files.read_node_data(spark, str(tmp_path / "n.json"))) == [("a", {"x": "1"}), ("b", {"x": "y"})]
    assert rows(files.read_frequencies(spark, str(tmp_path / "f.json"))) == [("a", 0, 1.0, 0.1), ("a", 1, 2.0, 0.9)]
    assert rows(files.read_titer_model(spark, str(tmp_path / "t.json"))) == [("r", "s", "u", 1.5, 80.0)]
    assert rows(files.read_distance_map(spark, str(tmp_path / "m.json"))) == [("w", "HA1", 145, None, None, 1.0), ("w", "HA1", 3, "A", "B", 0.5)]


def test_trees(spark, tmp_path):
    (tmp_path / "a.nwk").write_text("((x:1,y:2)in:0.5,'z z':1)root;")
    edges = files.read_trees(spark, str(tmp_path / "a.nwk")).drop("tree_id")
    assert rows(edges) == sorted([("root", None, False, 0), ("in", "root", False, 1), ("x", "in", True, 2), ("y", "in", True, 3), ("z z", "root", True, 4)], key=repr)
    assert T.closure(edges).count() == 1 + 2 + 3 + 3 + 2


def test_ladder(spark):
    edges = spark.range(200).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), (F.col("id") == 199).alias("is_terminal"), F.col("id").alias("preorder"))
    paths = T.closure(edges)
    assert paths.count() == 200 * 201 // 2
    assert paths.agg(F.max("hops")).first()[0] == 199
    assert T.prune_to_common([(edges, paths), (edges, paths)])[0].count() == 200


def test_link_and_split(spark):
    meta = spark.createDataFrame([("i1", "EPI1|x,EPI2", ""), ("i2", "", None)], "id string, ha_ids string, na_ids string")
    seqs = spark.createDataFrame([("EPI1", "AA"), ("EPI2", "AAA")], "accession string, sequence string")
    linked = J.link_sequences(meta, seqs, {"ha": "ha_ids", "na": "na_ids"}, "id")
    assert rows(J.link_report(linked, ["ha", "na"])) == [(2, 1, 2, 1)]
    assert rows(W.split_segments(linked, ["ha", "na"]).select("id", "ha", "accession_ha", "na", "n_segments")) == [("i1", "True", "EPI2", "False", 1)]


def test_checks(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    good, bad = C.check(df, {"positive": F.col("x") > 0}, "quarantine")
    assert (rows(good), rows(bad)) == ([(1,)], [(None, ["positive"])])
    with pytest.raises(Exception, match="broken rules: positive"):
        C.check(df, {"positive": F.col("x") > 0}).collect()


def test_translate_and_interval(spark):
    assert spark.range(1).select(Q.translate(F.lit("ATGAAATAGNNNAC"))).first()[0] == "MK*X"
    df = spark.createDataFrame([("a", float(x)) for x in (0, 1, 1.1, 1.2, 9)], "k string, v double")
    assert rows(T.interval(df, ["k"], "v", 0.6)) == [("a", pytest.approx(2.46), 1.0, 1.2)]


def test_partitions_do_not_matter(spark, data):
    e = spark.read.parquet(f"{data}/events.parquet")
    first = rows(W.dedup_first(e, "user_id", ["ts", "event_id"]).select("event_id"))
    assert first == rows(W.dedup_first(e.repartition(7), "user_id", ["ts", "event_id"]).select("event_id"))
    assert rows(fingerprint(e)) == rows(fingerprint(e.repartition(5)))


def test_streams_equal_batches(spark, data, tmp_path):
    e = spark.read.parquet(f"{data}/events.parquet")
    e.repartition(6).write.parquet(f"{tmp_path}/in")
    stream = streams.stream_batches(spark, f"{tmp_path}/in", e.schema, per_trigger=2)
    for _ in range(2):
        streams.upsert_first(stream, f"{tmp_path}/out", "user_id", ["event_id"], f"{tmp_path}/c1").awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == e.select("user_id").distinct().count()
    streams.record_delta(stream, f"{tmp_path}/delta", f"{tmp_path}/c2").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/delta").agg(F.sum("records")).first()[0] == e.count()
    counts = streams.stream_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", ["event_type"], "60 days")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == e.count()
    assert os.path.isdir(f"{tmp_path}/out/batch=0")
