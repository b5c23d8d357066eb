"""Many builds of one table at once: a matrix of patterns, rows matched to builds by a join, and quotas for each build.

A build is a row (build, its pattern values, max_rows); the build is one more key of every shuffle, so twenty builds cost
one scan and one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def matrix(spark: SparkSession, patterns: Mapping[str, Sequence[object]], name: str, max_rows: int | Callable[..., int] | None = None, **derived: Callable[..., object]) -> DataFrame:
    """(build, a column each pattern, derived columns, max_rows): the product of the patterns' values.

    ``name`` is formatted with them (``"{centre}_{lineage}"``), derived columns and max_rows are functions of them; a null
    max_rows takes all.  The product is a configuration, made on the driver.
    """
    rows = []
    for values in product(*patterns.values()):
        of = dict(zip(patterns, values, strict=True))
        most = max_rows(**of) if callable(max_rows) else max_rows
        rows.append({"build": name.format(**of), **of, **{k: f(**of) for k, f in derived.items()}, "max_rows": most})
    if len({r["build"] for r in rows}) < len(rows):
        raise ValueError(f"two builds of the matrix have one name under {name!r}")
    kinds = {str: "string", int: "long", float: "double", bool: "boolean"}
    kind = lambda c: next((kinds[type(r[c])] for r in rows if type(r[c]) in kinds), "date" if c != "max_rows" else "long")
    columns = ["build", *patterns, *derived, "max_rows"]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], ", ".join(f"`{c}` {kind(c)}" for c in columns))


def match(df: DataFrame, builds: DataFrame, on: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Rows of df once for each build they belong to, with ``build`` and ``max_rows``.

    ``on`` maps columns of df to pattern columns they equal; ``where`` may say more about both sides (pattern columns under
    ``b_`` and their name).  A pattern value that is null fits any row: builds are grouped by which of their patterns are
    null, and each such group is one equality join.
    """
    own = builds.select("build", "max_rows", *[F.col(c).alias(f"b_{c}") for c in builds.columns if c not in ("build", "max_rows")])
    mask = F.concat(F.lit(""), *[F.when(F.col(f"b_{p}").isNull(), "0").otherwise("1") for p in on.values()])
    shapes = [r[0] for r in own.select(mask.alias("m")).distinct().collect()]
    out = None
    for shape in sorted(shapes):
        some = own.where(mask == shape)
        fixed = [(c, p) for (c, p), bit in zip(on.items(), shape, strict=True) if bit == "1"]
        if fixed:
            part = df.join(some, [df[c] == some[f"b_{p}"] for c, p in fixed])
        else:  # builds of all rows: the rows are taken once for each
            listed = some.agg(F.collect_list(F.struct(*some.columns))).scalar()
            part = df.withColumn("_b", F.explode(listed)).select(*df.columns, "_b.*")
        out = part if out is None else out.union(part)
    out = out.where(where) if where is not None else out
    return out.select(*df.columns, "build", "max_rows")


def quotas(matched: DataFrame, by: Sequence[str], probabilistic: bool = False, seed: str = "0") -> DataFrame:
    """(build, by, take): how many rows of each group a build takes.

    The quota is the largest equal one whose total fits max_rows; the groups first by name that have more get one more
    while rows are left.  It is found from how many groups have each size, a table much smaller than that of groups.

    ``probabilistic``: a build with more groups than max_rows has a quota under 1, max_rows over groups, and a group's take
    is a Poisson draw of that mean, told by a hash of (build, group, seed), so the total is max_rows on average.
    """
    sizes = matched.groupBy("build", *by).agg(F.count("*").alias("_n"), F.first("max_rows").alias("max_rows"))
    shape = sizes.groupBy("build", "_n").agg(F.count("*").alias("_c"), F.first("max_rows").alias("max_rows"))
    order = Window.partitionBy("build").orderBy("_n")
    run = shape.withColumns({
        "_below": F.coalesce(F.sum(F.col("_n") * F.col("_c")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_left": F.sum("_c").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    fits = run.withColumn("_q", F.floor((F.col("max_rows") - F.col("_below")) / F.col("_left")))
    # The first size above its quota fixes it; where none is, everything fits.
    quota = fits.groupBy("build").agg(F.min_by("_q", F.when(F.col("_q") < F.col("_n"), F.col("_n"))).alias("_q0"), F.max(F.col("_q") < F.col("_n")).alias("_bent"), F.sum("_c").alias("_groups"), F.first("max_rows").alias("_cap"))
    quota = quota.select("build", F.when(F.col("_bent"), F.col("_q0")).alias("_quota"), (F.col("_cap") / F.col("_groups")).alias("_mean"), (F.col("_groups") > F.col("_cap")).alias("_sparse"), "_cap")
    sized = sizes.drop("max_rows").join(quota, "build").withColumn("_take", F.coalesce(F.least("_n", "_quota"), F.col("_n")))
    spare = sized.groupBy("build").agg((F.first("_cap") - F.sum("_take")).alias("_rest"))
    more = sized.where(F.col("_n") > F.col("_quota")).withColumn("_place", F.row_number().over(Window.partitionBy("build").orderBy(*by))).join(spare, "build").where("_place <= _rest").select(F.col("build").alias("_build"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_place")
    same = sized["build"] == more["_build"]
    for i, c in enumerate(by):
        same = same & sized[c].eqNullSafe(more[f"_k{i}"])
    out = sized.join(more, same, "left").select(sized["build"], *[sized[c] for c in by], "_n", "_mean", "_sparse", (F.col("_take") + F.when(F.col("_place").isNotNull(), 1).otherwise(0)).alias("take"))
    if probabilistic:
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "build", *[F.col(c).cast("string") for c in by]), 11) + 0.5) / F.lit(float(1 << 53))
        # The mean is under 1: a draw of 18 or more has a probability under 1e-16.
        terms = [F.exp(-F.col("_mean"))]
        for k in range(1, 18):
            terms.append(terms[-1] * F.col("_mean") / k)
        drawn, upto = F.lit(0), F.lit(0.0)
        for t in terms:
            upto = upto + t
            drawn = drawn + (u >= upto).cast("int")
        out = out.withColumn("take", F.when(F.col("_sparse"), F.least(F.col("_n"), drawn.cast("long"))).otherwise(F.col("take")))
    return out.select("build", *by, "take")


def subsample_builds(matched: DataFrame, by: Sequence[str], row: str, priority: Column | None = None, seed: str = "0", probabilistic: bool = False) -> DataFrame:
    """Of rows matched to builds, what each build takes: within a group higher priority first, then the smallest MD5 of (row, seed).

    One number comes to the driver, the largest take of all: no task then passes on more rows of a group than that.
    """
    take = quotas(matched, by, probabilistic, seed)
    most = take.agg(F.max("take")).first()[0] or 0
    within = Window.partitionBy("build", *by).orderBy(*([priority.desc_nulls_last()] if priority is not None else []), F.md5(F.concat(F.col(row).cast("string"), F.lit(seed))), row)
    ranked = matched.withColumn("_r", F.row_number().over(within)).where(F.col("_r") <= F.lit(int(most)))
    named = take.select(F.col("build").alias("_build"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "take")
    same = ranked["build"] == named["_build"]
    for i, c in enumerate(by):
        same = same & ranked[c].eqNullSafe(named[f"_k{i}"])
    return ranked.join(named, same).where("_r <= take").select(*[c for c in matched.columns if c != "max_rows"])


def write_builds(taken: DataFrame, path: str) -> None:
    """One folder a build, of one write."""
    taken.write.mode("overwrite").partitionBy("build").parquet(path)
