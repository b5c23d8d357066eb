"""Deduplication, ranking, sampling and framed windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.operators.builds import subsample_builds


def dedup_first(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in order; an aggregate, so a key of many rows is reduced before the shuffle."""
    by = F.struct(*[c if isinstance(c, Column) else F.col(c) for c in order])
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), by).alias("x")).select("x.*")


def dropped_duplicates(df: DataFrame, key: str, row: str, order: Sequence[str]) -> DataFrame:
    """The rows that :func:`dedup_first` leaves out."""
    return df.join(dedup_first(df, key, order).select(row), row, "left_anti")


def prioritise(df: DataFrame, strain: str, row: str, flags: Sequence[Column], hard: Column | None = None) -> DataFrame:
    """One row of each strain: a hard-coded one, else the first by flags (true first), else by row; an error on two hard-coded."""
    marked = df.withColumn("_hard", hard if hard is not None else F.lit(False))
    order = F.struct(*[F.coalesce((~f).cast("int"), F.lit(1)).alias(f"o{i}") for i, f in enumerate([F.col("_hard"), *flags])], F.col(row))
    out = marked.groupBy(strain).agg(F.min_by(F.struct(*df.columns), order).alias("x"), F.count_if("_hard").alias("_n"))
    return out.where(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("two fixed choices for "), F.col(strain).cast("string"))).cast("boolean")).otherwise(True)).select("x.*")


def select_sequence(column: str, mode: str = "best") -> Column:
    """One (accession, sequence) of an array: the longest, then the highest accession number; mode ``error`` allows one only."""
    number = lambda x: F.regexp_extract(x["accession"], r"(\d+)", 1).try_cast("long")
    best = F.array_max(F.transform(column, lambda x: F.struct(F.length(x["sequence"]).alias("n"), F.coalesce(number(x), F.lit(0)).alias("a"), x["accession"].alias("accession"), x["sequence"].alias("sequence"))))
    if mode == "error":
        return F.when(F.size(column) > 1, F.raise_error(F.lit("several sequences for a segment")).cast("struct<n:int,a:bigint,accession:string,sequence:string>")).otherwise(best)
    return best


def split_segments(df: DataFrame, segments: Sequence[str], column: str = "sequences", mode: str = "best") -> DataFrame:
    """Per segment a ``True``/``False`` flag and an accession (``N/A`` if none); n_segments; records without any left out."""
    chosen = {s: select_sequence(F.try_element_at(F.col(column), F.lit(s)), mode) for s in segments}
    out = df.withColumns({f"_{s}": v for s, v in chosen.items()})
    has = {s: F.col(f"_{s}.accession").isNotNull() for s in segments}
    out = out.withColumns({s: F.when(h, "True").otherwise("False") for s, h in has.items()} | {f"accession_{s}": F.coalesce(f"_{s}.accession", F.lit("N/A")) for s in segments})
    n = sum((h.cast("int") for h in has.values()), F.lit(0))
    return out.withColumn("n_segments", n).where("n_segments > 0").drop(column, *[f"_{s}" for s in segments])


def subsample(df: DataFrame, by: Sequence[str], max_rows: int, row: str, priority: Column | None = None, seed: str = "0", probabilistic: bool = False) -> DataFrame:
    """At most max_rows, spread evenly over groups: the largest equal quota whose total fits, then one more row for the
    groups that are first by name while rows are left.

    Within a group, higher priority first, then the smallest MD5 of (row, seed).  With more groups than max_rows the quota
    is 0 and the first groups give one row each, or, if ``probabilistic``, each as many as a Poisson draw says
    (:func:`lineagrid.operators.builds.quotas`), max_rows in all on average.
    """
    one = df.withColumns({"build": F.lit("all"), "max_rows": F.lit(max_rows).cast("long")})
    return subsample_builds(one, by, row, priority, seed, probabilistic).select(*df.columns)


def top_references(df: DataFrame, key: str, n: int, include: DataFrame, exclude: DataFrame, item: str = "item") -> DataFrame:
    """The n keys of most rows (ties by key) with the included, less the excluded."""
    top = df.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(n).select(F.col(key).alias(item))
    return top.union(include.select(item)).distinct().join(exclude.select(item), item, "left_anti")


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, n: int) -> DataFrame:
    """Rows among the first k of their group or the first n of all."""
    inside = df.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_k") <= k).drop("_k")
    overall = df.orderBy(*order).limit(n)
    return inside.union(overall).distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], date: str, tie: str, positive: str | None = None) -> DataFrame:
    """The latest row of each key, whole; optionally only where a value is positive."""
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(date, tie)).alias("x")).select("x.*")
    return out.where(F.col(positive) > 0) if positive else out


def duplicates(df: DataFrame, key: Column, source: str) -> DataFrame:
    """Derived keys of more than one row, with their sources in order."""
    return df.select(key.alias("key"), F.col(source).alias("s")).groupBy("key").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("s")).alias("sources")).where("n > 1")


def order_missing(df: DataFrame, year: str, count: Column, name: str) -> DataFrame:
    """Latest years first, ``<=`` years then ``unknown`` last; larger counts first."""
    rank = F.when(F.col(year) == "unknown", 0).when(F.col(year).startswith("<="), 1).otherwise(F.col(year).try_cast("int"))
    return df.orderBy(rank.desc(), count.desc(), name)


def delta(df: DataFrame, keys: Sequence[str], order: str, value: str, k: int = 1, name: str = "delta") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value, k).over(Window.partitionBy(*keys).orderBy(order)))


def normalise(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """The value over its group's sum; sums are made before the shuffle and joined back."""
    sums = df.groupBy(*by).agg(F.sum(value).alias("_t"))
    return df.join(sums, list(by)).withColumn(name, F.try_divide(F.col(value), F.col("_t"))).drop("_t")


def smooth(df: DataFrame, keys: Sequence[str], order: str, value: str, width: int = 6, name: str = "smoothed") -> DataFrame:
    """A centred moving average of ``width`` values, always divided by the width."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(width // 2), width - width // 2 - 1)
    return df.withColumn(name, F.sum(value).over(frame) / width)


def beats_naive(df: DataFrame, keys: Sequence[str], order: str, error: str, naive: str) -> DataFrame:
    """The share of splits so far in which the model's error is under the naive one's."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("beats_naive", F.avg((F.col(error) < F.col(naive)).cast("double")).over(frame))


def rising(df: DataFrame, key: str, order: str, value: str, last: int, n: int, offset: float = 0.01) -> DataFrame:
    """The n keys of the steepest last stretch: mean, rise, and rise over the first value plus an offset."""
    back = Window.partitionBy(key).orderBy(F.desc(order))
    recent = df.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= last)
    out = recent.groupBy(key).agg(F.avg(value).alias("mean"), (F.max_by(value, order) - F.min_by(value, order)).alias("rise"), F.min_by(value, order).alias("_f"))
    return out.withColumn("log_derivative", F.col("rise") / (F.col("_f") + offset)).drop("_f").orderBy(F.desc("log_derivative"), key).limit(n)
