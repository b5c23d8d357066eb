"""Cross-validation: known coefficients are found, rounds agree with the whole search, edges."""

import math

import pytest
from pyspark.sql import functions as F

from lineagrid.operators import crossval as V
from lineagrid.operators import forecast as M

BETA = {"x": 0.8, "y": -0.4}


@pytest.fixture(scope="module")
def panel(spark):
    """24 months of 12 strains in 4 clades, whose observed frequencies follow from BETA exactly."""
    rows = []
    for m in range(24):
        raw = [(m, f"s{k}", f"c{k % 4}", 1.0 + (k * 7 + m * 3) % 11, math.sin(k * 3.0 + m), math.cos(k * k + 2.0 * m)) for k in range(12)]
        total = sum(r[3] for r in raw)
        rows += [(*r[:3], r[3] / total, *r[4:]) for r in raw]
    df = spark.createDataFrame(rows, "m int, strain string, clade string, f double, x double, y double").withColumn("t", F.add_months(F.lit("2020-01-01").cast("date"), F.col("m")))
    observed = M.project_clades(df, "t", "clade", BETA, "f", 1.0).select("t", "clade", F.col("projected").alias("observed"))
    return df, observed


def splits_of(df):
    return M.train_validate_splits(df.select("t").distinct(), "t", 2, 1)


def test_search_finds_the_coefficients(spark, panel):
    df, observed = panel
    grid = [(f"{a}/{b}", a / 5, b / 5) for a in range(-5, 6) for b in range(-5, 6)]
    p = V.Panel(df, observed, ["x", "y"], "t", "clade", "f", 1.0, "sse")
    candidates = spark.createDataFrame(grid, "candidate string, x double, y double")
    splits = splits_of(df)
    whole = V.search(p, candidates, splits)
    assert whole.count() == len(grid) * splits.select("validate").distinct().count()
    best = V.best_per_split(whole).collect()
    assert {(r.x, r.y) for r in best} == {(0.8, -0.4)} and max(r.loss for r in best) < 1e-20
    halved = V.search(p, candidates, splits, rounds=4)
    assert {(r.x, r.y) for r in V.best_per_split(halved).collect()} == {(0.8, -0.4)}
    # 121, 61, 31, 16 candidates a split, each with the loss of the whole search.
    assert {r["count"] for r in halved.groupBy("validate").count().collect()} == {16}
    want = {(r.validate, r.candidate): r.loss for r in whole.collect()}
    assert all(abs(r.loss - want[r.validate, r.candidate]) < 1e-12 for r in halved.collect())


def test_zooming_comes_nearer(spark, panel):
    df, observed = panel
    p = V.Panel(df, observed, ["x", "y"], "t", "clade", "f", 1.0, "sse")
    coarse = spark.createDataFrame([("o", 0.5, 0.0), ("p", -1.0, -1.0)], "candidate string, x double, y double")
    splits = splits_of(df)
    start = {r.validate: r.loss for r in V.best_per_split(V.search(p, coarse, splits)).collect()}
    for r in V.best_per_split(V.search(p, coarse, splits, zooms=5, step=0.4)).collect():
        assert r.loss < start[r.validate] / 10 and abs(r.x - 0.8) < 0.15 and abs(r.y + 0.4) < 0.15


def test_cross_validation_beside_the_null_model(spark, panel):
    df, observed = panel
    p = V.Panel(df, observed, ["x", "y"], "t", "clade", "f", 1.0)
    candidates = spark.createDataFrame([("good", 0.8, -0.4), ("null too", 0.0, 0.0)], "candidate string, x double, y double")
    rows = V.cross_validate(p, candidates, splits_of(df)).collect()
    assert len(rows) == 24 - 14 and {r.candidate for r in rows} == {"good"}
    assert all(r.training_error < 1e-12 and r.validation_error < 1e-12 < r.null_validation_error and r.training_n == 13 * 4 and r.validation_n == 4 for r in rows)
    # So large a norm that no growth is better.
    assert {r.candidate for r in V.cross_validate(p, candidates, splits_of(df), l1=100.0).collect()} == {"null too"}
    assert [r.null_error > r.error for r in V.score_model(p, BETA).collect()] == [True] * 24


def test_losses_equal_the_plain_ones(spark, panel):
    df, observed = panel
    one = M.align_observed(M.project_clades(df, "t", "clade", {"x": 0.3, "y": 0.1}, "f", 1.0), observed, ["t", "clade"])
    for name in V.LOSSES:
        p = V.Panel(df, observed, ["x", "y"], "t", "clade", "f", 1.0, name)
        want = {r.t: r.loss for r in M.loss(one, name, "observed", "projected", "initial", ["t"]).collect()}
        got = {r.t: r.error for r in V.score_model(p, {"x": 0.3, "y": 0.1}).collect()}
        assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want), name


def test_edges(spark, panel):
    df, observed = panel
    candidates = spark.createDataFrame([("big", 1e6, 0.0)], "candidate string, x double, y double")
    splits = splits_of(df)
    p = V.Panel(df, observed, ["x", "y"], "t", "clade", "f", 1.0)
    assert V.search(p, candidates, splits).where("loss is null or isnan(loss)").count() == 0  # infinite growth is capped
    assert V.search(p, candidates, splits.limit(0)).count() == 0
    assert V.cross_validate(p, candidates.limit(0), splits).count() == 0
    none = V.Panel(df.limit(0), observed, ["x", "y"], "t", "clade", "f", 1.0)
    assert V.search(none, candidates, splits).count() == 0 and V.score_model(none, BETA).count() == 0
    # Nothing observed: all clades died.
    gone = V.Panel(df, observed.limit(0), ["x", "y"], "t", "clade", "f", 1.0)
    assert abs(V.score_model(gone, BETA).first().error - 0.25) < 1e-12


def test_infinite_growth_counts_as_the_cap(spark):
    df = spark.createDataFrame([(1, 0.25, 1e6), (1, 0.25, 0.0), (1, 0.5, 0.0)], "t int, f double, fit double")
    got = sorted(r.projected for r in M.project(df, "f", "fit", 1.0, ["t"]).collect())
    assert got == pytest.approx([0.25 / 1000.75, 0.5 / 1000.75, 1000 / 1000.75])
