"""Frequencies over time: pivots, kernel estimates, shares, interpolation, smoothing."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def pivots(spark: SparkSession, lo: str, hi: str, step: int, unit: str) -> DataFrame:
    """(pivot_idx, pivot) of evenly spaced dates."""
    dates = F.sequence(F.to_date(F.lit(lo)), F.to_date(F.lit(hi)), F.expr(f"interval {int(step)} {unit}"))
    return spark.range(1).select(F.posexplode(dates).alias("pivot_idx", "pivot"))


def _at_pivots(df: DataFrame, grid: DataFrame, near: Callable[[Column], Column], name: str = "pivot") -> DataFrame:
    """Each row once for each value of a small grid that is near it: the grid is one array, and no rows are joined."""
    listed = grid.agg(F.collect_list(name)).scalar()
    return df.withColumn("_grid", listed).withColumn(name, F.explode(F.filter("_grid", near))).drop("_grid")


def kde_frequencies(df: DataFrame, key: str, x: str, grid: DataFrame, narrow: float, wide: float, share: float, reach: float = 8.0) -> DataFrame:
    """(key, pivot, frequency): a mixture of two normal kernels around each row's x at every pivot, over the pivot's sum.

    The mixture is ``share`` of the narrow kernel and the rest of the wide.  Pivots further than ``reach`` wide bandwidths
    are left out before the kernel is computed.  Keys that are zero at all pivots don't appear.
    """
    pairs = _at_pivots(df.select(F.col(key).alias("_key"), F.col(x).alias("_x")), grid, lambda p: F.abs(F.col("_x") - p) <= reach * wide)
    normal = lambda s: F.exp(-0.5 * F.pow((F.col("_x") - F.col("pivot")) / s, 2)) / (s * math.sqrt(2 * math.pi))
    mass = pairs.groupBy("_key", "pivot").agg(F.sum(share * normal(narrow) + (1 - share) * normal(wide)).alias("_m"))
    totals = mass.groupBy("pivot").agg(F.sum("_m").alias("_t"))
    return mass.join(totals, "pivot").select(F.col("_key").alias(key), "pivot", F.try_divide("_m", "_t").alias("frequency")).where("frequency > 0")


def censored_frequencies(df: DataFrame, key: str, x: str, timepoints: DataFrame, grid: DataFrame, narrow: float, wide: float, share: float) -> DataFrame:
    """(timepoint, key, pivot, frequency) of what was known before each timepoint, at pivots up to it."""
    known = _at_pivots(df.select(key, x), timepoints, lambda p: p > F.col(x), "timepoint")
    pairs = _at_pivots(known, grid, lambda p: p <= F.col("timepoint"))
    normal = lambda s: F.exp(-0.5 * F.pow((F.col(x) - F.col("pivot")) / s, 2)) / (s * math.sqrt(2 * math.pi))
    mass = pairs.groupBy("timepoint", key, "pivot").agg(F.sum(share * normal(narrow) + (1 - share) * normal(wide)).alias("_m"))
    totals = mass.groupBy("timepoint", "pivot").agg(F.sum("_m").alias("_t"))
    return mass.join(totals, ["timepoint", "pivot"]).select("timepoint", key, "pivot", F.try_divide("_m", "_t").alias("frequency"))


def group_frequency_delta(df: DataFrame, group: str, pivot: str, value: str, k: int = 1) -> DataFrame:
    """Per group: frequency at the last pivot, at the k-th before, and the difference."""
    sums = df.groupBy(group, pivot).agg(F.sum(value).alias("f"))
    last = Window.partitionBy(group).orderBy(F.desc(pivot))
    ranked = sums.withColumn("r", F.row_number().over(last))
    out = ranked.groupBy(group).agg(F.max(F.when(F.col("r") == 1, F.col("f"))).alias("current"), F.max(F.when(F.col("r") == k + 1, F.col("f"))).alias("previous"))
    return out.withColumn("delta", F.col("current") - F.col("previous"))


def delta_frequency(df: DataFrame, clade: str, pivot: str, value: str, k: int, tips: DataFrame) -> DataFrame:
    """Tips with their clade's change over the last k pivots per unit of time."""
    sums = df.groupBy(clade, pivot).agg(F.sum(value).alias("f"))
    order = Window.partitionBy(clade).orderBy(pivot)
    rate = sums.withColumn("_d", (F.col("f") - F.lag("f", k).over(order)) / (F.col(pivot) - F.lag(pivot, k).over(order)))
    return tips.join(rate.groupBy(clade).agg(F.max_by("_d", pivot).alias("delta_frequency")), clade, "left")


def global_frequency(regional: DataFrame, weights: DataFrame, keys: Sequence[str], region: str, value: str) -> DataFrame:
    """Sum of regional frequencies times weights over the sum of all weights; a missing region counts 0."""
    total = weights.agg(F.sum("weight")).scalar()
    out = regional.join(weights, region).groupBy(*keys).agg(F.sum(F.col(value) * F.col("weight")).alias("_s"))
    return out.withColumn("_t", total).select(*keys, (F.col("_s") / F.col("_t")).alias("frequency"))


def monthly_counts(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """(keys, month, n), 0 in months between a group's first and last without rows."""
    counts = df.groupBy(*keys, F.trunc(date, "month").alias("month")).agg(F.count("*").alias("n"))
    ends = counts.groupBy(*keys).agg(F.min("month").alias("a"), F.max("month").alias("z"))
    grid = ends.select(*keys, F.explode(F.sequence("a", "z", F.expr("interval 1 month"))).alias("month"))
    return grid.join(counts, [*keys, "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def monthly_share(df: DataFrame, region: str, clade: str, date: str, min_n: int = 5, least: float = 0.05) -> DataFrame:
    """(region, clade, month, share) of months' rows; null in months of fewer than min_n; clades that exceed ``least`` somewhere."""
    counts = df.groupBy(region, clade, F.trunc(date, "month").alias("month")).agg(F.count("*").alias("n"))
    totals = counts.groupBy(region, "month").agg(F.sum("n").alias("t"))
    clades = counts.select(region, clade).distinct()
    grid = totals.join(clades, region).join(counts, [region, clade, "month"], "left")
    shares = grid.select(region, clade, "month", F.when(F.col("t") >= min_n, F.coalesce("n", F.lit(0)) / F.col("t")).alias("share"))
    kept = shares.groupBy(clade).agg(F.max("share").alias("m")).where(F.col("m") > least).select(clade)
    return shares.join(kept, clade, "left_semi")


def interpolate(df: DataFrame, key: str, pivot: str, value: str, timepoints: DataFrame) -> DataFrame:
    """(key, timepoint, value) on the straight line between the pivots around it; the end values beyond them."""
    order = Window.partitionBy(key).orderBy(pivot)
    seg = df.select(key, F.col(pivot).alias("x0"), F.col(value).alias("y0"), F.lead(pivot).over(order).alias("x1"), F.lead(value).over(order).alias("y1"), F.row_number().over(order).alias("i"))
    t = F.col("timepoint")
    hit = _at_pivots(seg, timepoints, lambda p: ((p >= F.col("x0")) & (p < F.col("x1"))) | (F.col("x1").isNull() & (p >= F.col("x0"))) | ((F.col("i") == 1) & (p < F.col("x0"))), "timepoint")
    line = F.col("y0") + (F.col("y1") - F.col("y0")) * (t - F.col("x0")) / (F.col("x1") - F.col("x0"))
    return hit.select(key, "timepoint", F.when(F.col("x1").isNull() | (t < F.col("x0")), F.col("y0")).otherwise(line).alias(value))


def logit_slope(df: DataFrame, key: str, pivot: str, value: str, last: int, clip: float = 25.0) -> DataFrame:
    """(key, slope) of the logit of the last pivots' frequencies, logits clipped."""
    p = F.col(value)
    logit = F.when(p <= 0, -clip).when(p >= 1, clip).otherwise(F.greatest(F.lit(-clip), F.least(F.lit(clip), F.ln(p / (1 - p)))))
    recent = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(pivot)))).where(F.col("_r") <= last)
    return recent.groupBy(key).agg(F.regr_slope(logit, F.col(pivot)).alias("slope"))


def add_pseudocounts(df: DataFrame, t: str, clade: str, value: str, c: float) -> DataFrame:
    """Each row's value plus c over its clade's rows, over the timepoint's new total; timepoints of total 0 are left as they are."""
    n = df.groupBy(t, clade).agg(F.count("*").alias("_n"))
    up = df.join(n, [t, clade]).withColumn("_u", F.col(value) + c / F.col("_n"))
    totals = up.groupBy(t).agg(F.sum("_u").alias("_t"), F.sum(value).alias("_o"))
    return up.join(totals, t).withColumn(value, F.when(F.col("_o") > 0, F.col("_u") / F.col("_t")).otherwise(F.col(value))).drop("_n", "_u", "_t", "_o")


def future_frequency(df: DataFrame, t: str, clade: str, value: str, months: int) -> DataFrame:
    """(t, clade, frequency, future): sums now and ``months`` later; a clade without a later row in a sampled timepoint has 0."""
    sums = df.groupBy(t, clade).agg(F.sum(value).alias("frequency"))
    later = sums.select(F.add_months(t, -months).alias(t), clade, F.col("frequency").alias("_f"))
    sampled = sums.select(F.add_months(t, -months).alias(t)).distinct()
    return sums.join(sampled, t).join(later, [t, clade], "left").select(t, clade, "frequency", F.coalesce("_f", F.lit(0.0)).alias("future"))


def active_clades(df: DataFrame, clade: str, sample: str, pivot: str, value: str, at: Column, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Clades within [lo, hi] in every sample at a pivot."""
    now = df.where(F.col(pivot) == at)
    samples = now.agg(F.count_distinct(sample)).scalar()
    inside = now.where(F.col(value).between(lo, hi)).groupBy(clade).agg(F.count_distinct(sample).alias("_n")).withColumn("_s", samples)
    return inside.where("_n = _s").select(clade)


def active_futures(df: DataFrame, clade: str, sample: str, pivot: str, value: str, observed: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """(clade, sample, current, future) of the clades active at the last observed pivot: their values there and at the last of all.

    Rows of one clade, sample and pivot are summed; a clade without rows at the last pivot has the future 0.
    """
    ends = df.agg(F.max(F.when(F.col(observed), F.col(pivot))).alias("now"), F.max(pivot).alias("then"))
    now, then = ends.select("now").scalar(), ends.select("then").scalar()
    both = df.withColumns({"_now": F.col(pivot) == now, "_then": F.col(pivot) == then}).where("_now or _then")
    sums = both.groupBy(clade, sample).agg(F.sum(F.when(F.col("_now"), F.col(value))).alias("current"), F.coalesce(F.sum(F.when(F.col("_then"), F.col(value))), F.lit(0.0)).alias("future"))
    active = active_clades(sums.withColumn("_at", F.lit(0)), clade, sample, "_at", "current", F.lit(0), lo, hi)
    return sums.join(active, clade, "left_semi").where("current is not null")
