"""Comparison of dataset versions and data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.operators.fingerprints import fingerprint


def diff_records(a: DataFrame, b: DataFrame, key: str, ignore: Sequence[str] = (), sets: Sequence[str] = ()) -> DataFrame:
    """(key, change, field, was, now): records added or removed, and fields added, removed or modified; empty counts as missing.

    Columns named in ``sets`` are maps from a part (a segment) to an array of names (accessions).  Of records in both
    versions their parts are compared as sets, in the same pass: change is ``<column> changed``, field ``<part> removed``
    with the names that are gone in was, or ``<part> added`` with the new ones in now, sorted and joined by a comma and a
    space.  A null map, and a part that a map lacks, has no names.
    """
    fields = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c != key and c not in ignore and c not in sets]
    maps = {c: next(df.schema[c].dataType.simpleString() for df in (a, b) if c in df.columns) for c in sets}

    def side(df: DataFrame, n: str) -> DataFrame:
        plain = [(F.nullif(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit(None).cast("string")).alias(f"_{n}_{c}") for c in fields]
        return df.select(F.col(key), F.lit(True).alias(f"_{n}"), *plain, *[(F.col(c) if c in df.columns else F.lit(None).cast(kind)).alias(f"_{n}_{c}") for c, kind in maps.items()])

    def parts(c: str) -> Column:
        none = F.map_from_arrays(F.array(), F.array()).cast(maps[c])
        name = lambda x: F.array_join(F.sort_array(x), ", ")
        lost = lambda x, y: F.array_except(F.coalesce(x, F.array().cast("array<string>")), F.coalesce(y, F.array().cast("array<string>")))
        pairs = F.map_entries(F.map_zip_with(F.coalesce(F.col(f"_a_{c}"), none), F.coalesce(F.col(f"_b_{c}"), none), lambda k, x, y: F.struct(lost(x, y).alias("gone"), lost(y, x).alias("new"))))
        row = lambda x, of, word, was: F.struct(F.lit(f"{c} changed").alias("change"), F.concat(x["key"], F.lit(f" {word}")).alias("field"), (name(of) if was else F.lit(None).cast("string")).alias("was"), (F.lit(None).cast("string") if was else name(of)).alias("now"), (F.size(of) > 0).alias("there"))
        both = F.flatten(F.transform(pairs, lambda x: F.array(row(x, x["value"]["gone"], "removed", True), row(x, x["value"]["new"], "added", False))))
        return F.filter(both, lambda x: x["there"])

    def field(c: str) -> Column:
        was, now = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        kind = F.when(was.isNull(), "added").when(now.isNull(), "removed").otherwise("modified")
        return F.struct(kind.alias("change"), F.lit(c).alias("field"), was.alias("was"), now.alias("now"), (~was.eqNullSafe(now)).alias("there"))

    both = side(a, "a").join(side(b, "b"), key, "full_outer")
    nothing = F.lit(None).cast("string")
    whole = F.array(F.struct(F.when(F.col("_b").isNull(), "removed record").otherwise("added record").alias("change"), nothing.alias("field"), nothing.alias("was"), nothing.alias("now"), F.lit(True).alias("there")))
    changes = F.filter(F.array(*map(field, fields)), lambda x: x["there"]) if fields else F.slice(whole, F.lit(1), F.lit(0))
    for c in sets:
        changes = F.concat(changes, parts(c))
    rows = both.select(key, F.explode(F.when(F.col("_a").isNull() | F.col("_b").isNull(), whole).otherwise(changes)).alias("x"))
    return rows.select(key, "x.change", "x.field", "x.was", "x.now")


def diff_accessions(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """(key, added, removed) of array columns that differ as sets."""
    both = a.select(key, F.col(column).alias("_a")).join(b.select(key, F.col(column).alias("_b")), key)
    return both.select(key, F.sort_array(F.array_except("_b", "_a")).alias("added"), F.sort_array(F.array_except("_a", "_b")).alias("removed")).where("size(added) + size(removed) > 0")


def diff_summary(diff: DataFrame, key: str, by: Sequence[str] = ("change", "field")) -> DataFrame:
    """Records per kind of change, with the key where there is one only."""
    out = diff.groupBy(*by).agg(F.count_distinct(key).alias("n"), F.min(F.col(key).cast("string")).alias("_k"))
    return out.withColumn("only", F.when(F.col("n") == 1, F.col("_k"))).drop("_k")


def diff_one_sided(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, was, now, kind) where a's value isn't b's; kind case_only or different; a's empty values are skipped."""
    both = a.select(key, *[F.col(c).cast("string").alias(f"_a_{c}") for c in fields]).join(b.select(key, *[F.col(c).cast("string").alias(f"_b_{c}") for c in fields]), key)
    rows = both.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_a_{c}").alias("was"), F.col(f"_b_{c}").alias("now")) for c in fields])).alias("x")).select(key, "x.*")
    differ = rows.where("was is not null and was <> '' and not (was <=> now)")
    return differ.withColumn("kind", F.when(F.lower("was") == F.lower("now"), "case_only").otherwise("different"))


def explain(diff: DataFrame, cascade: Sequence[tuple[str, Column]], default: str = "unexplained") -> DataFrame:
    """Each difference with the first reason that holds for it."""
    return diff.withColumn("reason", reduce(lambda rest, x: F.when(x[1], F.lit(x[0])).otherwise(rest), reversed(list(cascade)), F.lit(default)))


def explain_weighted(diff: DataFrame, evidence: Sequence[tuple[str, Column, float]], least: float = 0.0, default: str = "unexplained") -> DataFrame:
    """Each difference with the reason of most evidence, its weight, and the lead over the next reason.

    ``evidence`` lists (reason, condition, weight); a reason's weight is the sum over its conditions that hold, null as
    not.  Reasons need more than ``least``; of equal ones the first listed counts; without any, reason is the default, its
    weight 0, its lead null.
    """
    reasons = list(dict.fromkeys(r for r, _, _ in evidence))
    weight = {r: reduce(lambda x, y: x + y, [F.when(c, F.lit(float(w))).otherwise(0.0) for q, c, w in evidence if q == r]) for r in reasons}
    every = F.array(*[F.struct((-weight[r]).alias("w"), F.lit(i).alias("i"), F.lit(r).alias("reason")) for i, r in enumerate(reasons)])
    out = diff.withColumn("_e", F.filter(F.array_sort(every), lambda x: -x["w"] > least))
    best, next_ = F.get("_e", F.lit(0)), F.get("_e", F.lit(1))
    return out.withColumns({
        "reason": F.coalesce(best["reason"], F.lit(default)),
        "weight": F.coalesce(-best["w"], F.lit(0.0)),
        "lead": F.when(best.isNotNull(), -best["w"] + F.coalesce(next_["w"], F.lit(0.0))),
    }).drop("_e")


def record_change(now: DataFrame, before: DataFrame) -> DataFrame:
    """(records, previous, delta, changed) of two tables by their fingerprints."""
    x, y = fingerprint(now), fingerprint(before).withColumnsRenamed({"records": "previous", "sum_a": "_a", "sum_b": "_b"})
    differ = (F.col("records") != F.col("previous")) | (F.col("sum_a") != F.col("_a")) | (F.col("sum_b") != F.col("_b"))
    return x.join(F.broadcast(y)).select("records", "previous", (F.col("records") - F.col("previous")).alias("delta"), differ.alias("changed"))  # one row each
