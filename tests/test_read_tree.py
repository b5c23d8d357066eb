"""One Newick text read by byte ranges equals the sequential reader."""

import random

import pytest

from lineagrid.sources import files


def newick(tips, seed):
    """A random tree text: ladders, stars, named and unnamed groups, lengths, comments, quotes, white space."""
    rng = random.Random(seed)
    parts = [f"t{i}" if i % 5 else f"'q {i}'" for i in range(tips)]
    while len(parts) > 1:
        if rng.random() < 0.2:
            at, n = 0, min(len(parts), rng.randrange(2, 5))
        else:
            at = rng.randrange(len(parts) - 1)
            n = min(len(parts) - at, rng.randrange(2, 6))
        name = rng.choice(["", f"n{len(parts)}_{at}", f"x{len(parts)}:0.5", ":1.25", f"c{len(parts)}[&rate=1]:2"])
        parts[at : at + n] = ["(" + ", ".join(parts[at : at + n]) + ")" + name]
    return parts[0] + ";\n"


def plain(text):
    names, out = {}, []
    for node, parent, terminal, pre in files.newick_edges(text):
        names[pre] = node
        out.append((node, parent, terminal, pre))
    return sorted(out, key=repr)


@pytest.mark.parametrize("text", ["a;", "(a,b)r;", "((a,b),(c,(d,e)x)y);", "(((((a)))));", "(a,((b,c),d)e,f)g:1;\n"])
def test_small(spark, tmp_path, text):
    (tmp_path / "t.nwk").write_text(text)
    assert sorted(map(tuple, files.read_tree(spark, f"{tmp_path}/t.nwk").collect()), key=repr) == plain(text)


def test_large_from_many_ranges(spark, tmp_path):
    import sys

    text = "(" + newick(3000, 1).rstrip(";\n") + "," + "(" * 800 + "deep" + "".join(f",l{i})" for i in range(800)) + "," + ",".join(f"s{i}" for i in range(20_000)) + ")root;"
    (tmp_path / "t.nwk").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 12))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.option("lineSep", ",").text(f"{tmp_path}/t.nwk").rdd.getNumPartitions() >= 8
        got = sorted(map(tuple, files.read_tree(spark, f"{tmp_path}/t.nwk").collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    sys.setrecursionlimit(10_000)
    assert got == plain(text)
