"""Predictors by name: order of needs, one climb, values against plain sums."""

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import predictors as N
from lineagrid.operators import trees as T


@pytest.fixture(scope="module")
def inputs(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 1), (5, 4)], "node int, parent int")
    seqs = spark.createDataFrame([(1, "AAAA"), (2, "CAAA"), (3, "CCAT"), (4, "AAAA"), (5, "AAGA")], "node int, seq string")
    nodes = spark.createDataFrame([(1, 0.5, 0.1), (3, 1.0, None), (4, None, 0.2)], "node int, lbi double, frequency double")
    prefs = spark.createDataFrame([(1, "A", 0.5), (1, "C", 0.25), (2, "A", 0.5)], "site int, aa string, preference double")
    return N.Inputs(edges, seqs, nodes, "0110", prefs, missing=0.125)


def test_order():
    assert N.in_order(["ep_share", "ep"]) == ["ep_path", "mutations", "ep_share", "ep"]
    with pytest.raises(ValueError, match="no predictor 'x'"):
        N.in_order(["x"])
    loop = {"a": N.Predictor("derived", needs=("b",)), "b": N.Predictor("derived", needs=("a",))}
    with pytest.raises(ValueError, match="a > b > a"):
        N.in_order(["a"], loop)


def test_values_from_one_climb(inputs, monkeypatch):
    climbs = []
    plain = T.climb
    monkeypatch.setattr(T, "climb", lambda *a: climbs.append(1) or plain(*a))
    out = N.compute(["ep", "ne", "mutations", "dms", "cum_lbi", "ep_share", "log_freq", "null"], inputs)
    # One for the sums; one each for the roots that sequences are compared with.
    assert len(climbs) <= 3
    got = {r.node: tuple(r)[1:] for r in out.collect()}
    small = pytest.approx(-13.815510557964274)
    # Node 3: C, C, A, T against the root; its path changes site 1 (0.5 to 0.25), site 2 (0.5 to missing), site 4 (neither known).
    assert got[1] == (0, 0, 0, 0.0, 0.5, 0.0, pytest.approx(-2.302585092994046), 0.0)
    assert got[2] == (0, 1, 1, -1.0, 0.5, 0.0, small, 0.0)
    assert got[3] == (1, 2, 3, -3.0, 1.5, pytest.approx(1 / 3), small, 0.0)
    assert got[4][:5] == (0, 0, 0, 0.0, 0.5) and got[5][:4] == (1, 0, 1, 0.0)


def test_random_is_told_by_the_seed(inputs):
    one = {r.node: r.random for r in N.compute(["random"], inputs).collect()}
    again = {r.node: r.random for r in N.compute(["random"], inputs).collect()}
    inputs.settings = {"seed": 1}
    other = {r.node: r.random for r in N.compute(["random"], inputs).collect()}
    assert one == again != other and all(0 <= v < 1 for v in one.values())


def test_missing_settings(inputs):
    inputs = N.Inputs(inputs.edges, inputs.seqs.limit(0), inputs.nodes)
    with pytest.raises(ValueError, match="preferences"):
        N.compute(["dms"], inputs)
    assert {tuple(r)[1:] for r in N.compute(["ep", "mutations"], inputs).collect()} == {(0, 0.0)}
    assert N.compute(["null"], N.Inputs(inputs.edges.limit(0), inputs.seqs, inputs.nodes)).where(F.col("node") > 0).count() == 0
