"""Fingerprints of tables as multisets: sums of row hashes, which rows that come and go add to and subtract from.

Two 64-bit hashes of a row are summed exactly, so equal rows count as often as they are there and order doesn't matter.
Kept for each of many buckets of keys, and for groups of buckets, they name what changed between two versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

SUMS = ("records", "sum_a", "sum_b")


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row, from all columns in the order of their names; which of them are null counts too."""
    columns = [F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in sorted(df.columns)]
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in sorted(df.columns)])
    return tuple(F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2))


def _sums(a: Column, b: Column) -> list[Column]:
    # 28 digits hold a hash and leave room for 10**19 rows.
    return [F.count("*").alias("records"), *[F.coalesce(F.sum(h.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).alias(n) for n, h in (("sum_a", a), ("sum_b", b))]]


def fingerprint(df: DataFrame) -> DataFrame:
    """(records, sum_a, sum_b), one row; equal for tables of the same rows, each as often, in any order."""
    return df.agg(*_sums(*row_hashes(df)))


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def tree(df: DataFrame, bucket: Column, fan_out: int = 64) -> DataFrame:
    """(level, bucket, records, sum_a, sum_b): fingerprints of buckets (level 1) and of each ``fan_out`` buckets (level 0).

    ``bucket`` numbers a row from 0, by its key for instance (:func:`bucket_of`).  Rows are summed in the task that reads
    them; a bucket without rows has no row here.
    """
    a, b = row_hashes(df)
    leaves = df.select(bucket.cast("long").alias("bucket"), a.alias("_a"), b.alias("_b")).groupBy("bucket").agg(*_sums(F.col("_a"), F.col("_b")))
    return _with_groups(leaves, fan_out)


def _with_groups(leaves: DataFrame, fan_out: int) -> DataFrame:
    level = F.explode(F.array(F.struct(F.lit(1).alias("level"), F.col("bucket").alias("of")), F.struct(F.lit(0).alias("level"), F.floor(F.col("bucket") / fan_out).alias("of"))))
    both = leaves.withColumn("x", level).groupBy(F.col("x.level").alias("level"), F.col("x.of").alias("bucket"))
    return both.agg(F.sum("records").alias("records"), *[F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c) for c in SUMS[1:]])


def updated(old: DataFrame, inserted: DataFrame | None, deleted: DataFrame | None, bucket: Column, fan_out: int = 64) -> DataFrame:
    """The tree after these rows came and those went; only they are read.  Buckets that are left without rows go."""
    parts = [old.where("level = 1").select("bucket", *SUMS)]
    for rows, sign in ((inserted, 1), (deleted, -1)):
        if rows is not None:
            parts.append(tree(rows, bucket, fan_out).where("level = 1").select("bucket", *[(F.col(c) * sign).cast("long" if c == "records" else "decimal(38,0)").alias(c) for c in SUMS]))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    leaves = every.groupBy("bucket").agg(*[F.sum(c).cast("long" if c == "records" else "decimal(38,0)").alias(c) for c in SUMS]).where("records <> 0 or sum_a <> 0 or sum_b <> 0")
    return _with_groups(leaves, fan_out)


def changed_buckets(now: DataFrame, before: DataFrame, fan_out: int = 64) -> DataFrame:
    """(bucket, records, previous) where two trees differ; only buckets whose group differs are compared."""
    def differing(x: DataFrame, y: DataFrame) -> DataFrame:
        old = y.select("bucket", *[F.col(c).alias(f"_{c}") for c in SUMS])
        both = x.select("bucket", *SUMS).join(old, "bucket", "full_outer")
        same = F.lit(True)
        for c in SUMS:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return both.where(~same)

    groups = differing(now.where("level = 0"), before.where("level = 0")).select(F.col("bucket").alias("_g"))
    inside = lambda t: t.where("level = 1").join(groups, F.floor(F.col("bucket") / fan_out) == F.col("_g"), "left_semi")
    out = differing(inside(now), inside(before))
    return out.select("bucket", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("_records", F.lit(0)).alias("previous"))


def changed_rows(now: DataFrame, before: DataFrame, buckets: DataFrame, bucket: Column) -> Sequence[DataFrame]:
    """The rows of both versions in the buckets (bucket, ...) that changed: what a comparison has to look at."""
    names = buckets.select(F.col("bucket").alias("_b"))
    return [df.join(names, bucket.cast("long") == F.col("_b"), "left_semi") for df in (now, before)]
