"""Growth-model forecasts on a panel of (timepoint, strain, frequency, clade, predictors), and their scores.

Horizons, coefficients and models are columns or joined tables of bounded size, never loops over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_sd(df: DataFrame, predictors: Sequence[str], t: str) -> DataFrame:
    """One row: each predictor's standard deviation per timepoint, averaged over timepoints."""
    return df.groupBy(t).agg(*[F.stddev_samp(p).alias(p) for p in predictors]).agg(*[F.avg(p).alias(p) for p in predictors])


def standardise(df: DataFrame, predictors: Sequence[str], weight: str, t: str) -> DataFrame:
    """Predictors less their weighted mean over their weighted deviation per timepoint; those of no deviation stay.

    Moments are sums per timepoint, made before the shuffle and joined back.
    """
    w = F.col(weight)
    sums = df.groupBy(t).agg(F.sum(w).alias("_w"), *[x for p in predictors for x in (F.sum(w * F.col(p)).alias(f"_1_{p}"), F.sum(w * F.col(p) * F.col(p)).alias(f"_2_{p}"))])
    out = df.join(sums, t)
    mean = {p: F.try_divide(F.col(f"_1_{p}"), F.col("_w")) for p in predictors}
    sd = {p: F.sqrt(F.greatest(F.try_divide(F.col(f"_2_{p}"), F.col("_w")) - mean[p] * mean[p], F.lit(0.0))) for p in predictors}
    return out.withColumns({p: F.when(sd[p] > 1e-12, (F.col(p) - mean[p]) / sd[p]).otherwise(F.col(p)) for p in predictors}).drop("_w", *[f"_{k}_{p}" for p in predictors for k in (1, 2)])


def fitness(df: DataFrame, beta: Mapping[str, float | Column], name: str = "fitness") -> DataFrame:
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(p) * b for p, b in beta.items()], F.lit(0.0)))


def project(df: DataFrame, frequency: str, fit: str, dt: float | Column, keys: Sequence[str], name: str = "projected", cap: float = 1000.0) -> DataFrame:
    """Frequencies times exp(fitness dt), ``cap`` where that is infinite, over the sum per group of keys."""
    ahead = F.col(frequency) * F.exp(F.col(fit) * dt)
    grown = df.withColumn("_g", F.when(ahead == float("inf"), F.lit(cap)).otherwise(ahead))
    totals = grown.groupBy(*keys).agg(F.sum("_g").alias("_t"))
    return grown.join(totals, list(keys)).withColumn(name, F.try_divide("_g", "_t")).drop("_g", "_t")


def project_clades(df: DataFrame, t: str, clade: str, predictors: Mapping[str, float], frequency: str, dt: float) -> DataFrame:
    """(t, clade, initial, projected) of standardised predictors and their coefficients."""
    out = project(fitness(standardise(df, list(predictors), frequency, t), predictors), frequency, "fitness", dt, [t])
    return out.groupBy(t, clade).agg(F.sum(frequency).alias("initial"), F.sum("projected").alias("projected"))


def expected_distance(tips: DataFrame, future: DataFrame, distances: DataFrame, sample: str, frequency: str) -> DataFrame:
    """(sample, expected) of the frequency-weighted distance of each tip to the future ones."""
    weight = future.select(F.col(sample).alias("other_sample"), F.col(frequency).alias("_f"))
    return tips.select(sample).join(distances.withColumnRenamed("sample", sample), sample).join(weight, "other_sample").groupBy(sample).agg(F.sum(F.col("_f") * F.col("distance")).alias("expected"))


def weighted_distances(tips: DataFrame, distances: DataFrame, t: str, months: int, sample: str, frequency: str) -> DataFrame:
    """(sample, to_present, to_future, log2_ratio): mean distances weighted by frequency; null without a future."""
    other = tips.select(F.col(t).alias("_t"), F.col(sample).alias("other_sample"), F.col(frequency).alias("_f"))
    pairs = tips.select(t, sample).join(distances.withColumnRenamed("sample", sample), sample).join(other, "other_sample")
    now = pairs.where(F.col("_t") == F.col(t)).groupBy(sample).agg(F.sum(F.col("_f") * F.col("distance")).alias("to_present"))
    later = pairs.where(F.col("_t") == F.add_months(t, months)).groupBy(sample).agg(F.sum(F.col("_f") * F.col("distance")).alias("to_future"))
    out = tips.select(sample).distinct().join(now, sample, "left").join(later, sample, "left")
    return out.withColumn("log2_ratio", F.log2(F.try_divide("to_future", "to_present")))


def forecast(df: DataFrame, frequency: str, fit: str, t: str, horizons: Sequence[int]) -> DataFrame:
    """Rows once a horizon in months, with projected and future_timepoint."""
    out = df.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return project(out, frequency, fit, F.col("horizon") / 12.0, [t, "horizon"]).withColumn("future_timepoint", F.add_months(t, F.col("horizon")))


def cross_immunity(pairs: DataFrame, current: str, distance: str, t: str, t_past: str, max_frequency: str, d0: float, years: float) -> DataFrame:
    """Per current strain, minus the sum over past strains of waning times largest frequency times exp(-d / d0)."""
    effect = F.greatest(1 - (F.col(t) - F.col(t_past)) / years, F.lit(0.0)) * F.col(max_frequency) * F.exp(-F.col(distance) / d0)
    return pairs.groupBy(current).agg((-F.sum(effect)).alias("cross_immunity"))


def train_validate_splits(timepoints: DataFrame, t: str, gap: int, window_years: int) -> DataFrame:
    """(validate, train): for each validation timepoint, the training ones of the window that ends ``gap`` months before it.

    Only timepoints whose window is whole (its first month is at or after the first timepoint) validate.
    """
    first = timepoints.agg(F.min(t)).scalar()
    v = timepoints.select(F.col(t).alias("validate")).withColumn("_first", first)
    last = F.add_months("validate", -gap)
    v = v.withColumns({"_last": last, "_from": F.add_months(last, -12 * window_years)}).where("_from >= _first")
    return v.join(timepoints.select(F.col(t).alias("train")), (F.col("train") <= F.col("_last")) & (F.col("train") >= F.col("_from"))).select("validate", "train")


#: Losses by name: aggregates of observed, estimated and initial frequencies.
LOSSES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "sse": lambda o, e, i: F.sum((o - e) * (o - e)),
    "rmse": lambda o, e, i: F.sqrt(F.avg((o - e) * (o - e))),
    "mae": lambda o, e, i: F.avg(F.abs(o - e)),
    "information_gain": lambda o, e, i: -F.sum(F.when(o != 0, o * F.ln(e / i))),
    "difference": lambda o, e, i: F.sum(o - e),
}


def loss(df: DataFrame, name: str, observed: str, estimated: str, initial: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(LOSSES[name](F.col(observed), F.col(estimated), F.col(initial)).alias("loss"))


def align_observed(estimated: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimates with the observed frequency of the same keys, 0 where there is none."""
    return estimated.join(observed.select(*keys, "observed"), list(keys), "left").withColumn("observed", F.coalesce("observed", F.lit(0.0)))


def distance_score(df: DataFrame, t: str, distance: str, estimated: str, observed: str, initial: str) -> DataFrame:
    """Mean over timepoints of (estimated - observed) over initial distance, each weighted by its frequency."""
    sums = df.groupBy(t).agg(*[F.sum(F.col(f) * F.col(distance)).alias(n) for f, n in ((estimated, "e"), (observed, "o"), (initial, "i"))])
    return sums.agg(F.avg(F.try_divide(F.col("e") - F.col("o"), F.col("i"))).alias("score"))


def growth_mcc(df: DataFrame, initial: str, observed: str, estimated: str) -> DataFrame:
    """Counts of grown and declined clades, observed against estimated, and the Matthews coefficient."""
    o, e = F.col(observed) > F.col(initial), F.col(estimated) > F.col(initial)
    out = df.agg(F.count_if(o & e).alias("tp"), F.count_if(~o & ~e).alias("tn"), F.count_if(~o & e).alias("fp"), F.count_if(o & ~e).alias("fn"))
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    return out.withColumn("mcc", F.coalesce(F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), F.lit(0.0)))


def correlations(df: DataFrame, initial: str, observed: str, estimated: str) -> DataFrame:
    i, o, e = F.col(initial), F.col(observed), F.col(estimated)
    return df.agg(F.corr(i, o).alias("initial_observed"), F.corr(o, e).alias("observed_estimated"), F.corr(F.try_divide(o, i), F.try_divide(e, i)).alias("growth"))


def summarise_scores(df: DataFrame, error: str, coefficients: Sequence[str]) -> DataFrame:
    """(name, mean, sd) over splits of the error and of each coefficient; population deviations."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in (error, *coefficients)])).alias("x")).select("x.*")
    return long.groupBy("name").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))


def scores_by_timepoint(df: DataFrame, t: str, names: str, values: str) -> DataFrame:
    """(t, predictor, coefficient) of paired arrays."""
    return df.select(t, F.explode(F.arrays_zip(F.col(names).alias("predictor"), F.col(values).alias("coefficient"))).alias("x")).select(t, "x.*")


def search_coefficients(df: DataFrame, candidates: DataFrame, predictors: Sequence[str], t: str, clade: str, frequency: str, observed: DataFrame, dt: float, name: str = "mae", l1: float = 0.0) -> DataFrame:
    """(candidate, loss), every candidate's coefficients scored in one job, the L1 norm added.

    ``candidates`` (candidate, one column a predictor) meet standardised rows by timepoint, of which they are given each.
    """
    ready = standardise(df, predictors, frequency, t)
    beta = candidates.select("candidate", *[F.col(p).alias(f"_b_{p}") for p in predictors])
    every = beta.withColumn(t, F.explode(df.agg(F.collect_set(t)).scalar()))
    tried = fitness(ready.join(every, t), {p: F.col(f"_b_{p}") for p in predictors})
    projected = project(tried, frequency, "fitness", dt, ["candidate", t]).groupBy("candidate", t, clade).agg(F.sum(frequency).alias("initial"), F.sum("projected").alias("estimated"))
    scored = loss(align_observed(projected, observed, [t, clade]), name, "observed", "estimated", "initial", ["candidate"])
    norm = reduce(lambda a, b: a + b, [F.abs(f"_b_{p}") for p in predictors])
    return scored.join(beta, "candidate").select("candidate", (F.col("loss") + l1 * norm).alias("loss"))


def best_candidate(scored: DataFrame) -> DataFrame:
    return scored.orderBy("loss", "candidate").limit(1)


def test_model(df: DataFrame, beta: Mapping[str, float], t: str, clade: str, frequency: str, observed: DataFrame, dt: float, name: str = "mae") -> DataFrame:
    """Losses of a fixed model and of the one without growth."""
    rows = [("model", *[float(b) for b in beta.values()]), ("naive", *[0.0] * len(beta))]
    candidates = df.sparkSession.createDataFrame(rows, "candidate string, " + ", ".join(f"`{p}` double" for p in beta))
    return search_coefficients(df, candidates, list(beta), t, clade, frequency, observed, dt, name)


def project_tree(df: DataFrame, paths: DataFrame, node: str, frequency: str, fit: str, deltas: Sequence[float]) -> DataFrame:
    """(node, delta, projected) of all nodes: tips projected over each delta, inner nodes the sums below them."""
    tips = project(df.withColumn("delta", F.explode(F.array(*[F.lit(float(d)) for d in deltas]))), frequency, fit, F.col("delta"), ["delta"])
    return paths.join(tips.select(F.col(node).alias("node"), "delta", "projected"), "node").groupBy(F.col("ancestor").alias("node"), "delta").agg(F.sum("projected").alias("projected"))


def validate_trajectories(df: DataFrame, trajectories: DataFrame, t: str, clade: str, frequency: str, fit: str, deltas: Sequence[float], unit: float = 1.0) -> DataFrame:
    """(t, clade, delta, observed, predicted) of clades before and after each timepoint t, a number.

    ``observed`` lies on the clade's trajectory (clade, pivot, frequency), inside its pivots; ``predicted`` equals it before
    t and is the clade's projected share after, growing by fitness times delta.
    """
    ahead = F.explode(F.array(*[F.lit(float(d)) for d in deltas]))
    predicted = project(df.withColumn("delta", ahead), frequency, fit, F.greatest(F.col("delta"), F.lit(0.0)) * unit, [t, "delta"])
    sums = predicted.groupBy(t, clade, "delta").agg(F.sum("projected").alias("_p"))
    # The straight line between the pivots around a time; both ends are found in one array for each clade.
    line = trajectories.groupBy(clade).agg(F.array_sort(F.collect_list(F.struct("pivot", "frequency"))).alias("_line"))
    at = F.col(t) + F.col("delta")
    low = F.try_element_at(F.filter("_line", lambda x: x["pivot"] <= at), F.lit(-1))
    high = F.get(F.filter("_line", lambda x: x["pivot"] >= at), F.lit(0))
    share = F.coalesce(F.try_divide(at - F.col("_low.pivot"), F.col("_high.pivot") - F.col("_low.pivot")), F.lit(0.0))
    out = sums.join(line, clade).withColumns({"_low": low, "_high": high}).where("_low is not null and _high is not null")
    out = out.withColumn("observed", F.col("_low.frequency") + share * (F.col("_high.frequency") - F.col("_low.frequency")))
    return out.select(t, clade, "delta", "observed", F.when(F.col("delta") < 0, F.col("observed")).otherwise(F.col("_p")).alias("predicted"))
