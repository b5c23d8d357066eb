"""Projections, filters and checks on record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.functions.scalars import lineage_match, relative_date


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def subset(df: DataFrame, columns: Sequence[str], segments: Sequence[str] = (), per_segment: Sequence[str] = ("accession",)) -> DataFrame:
    """The columns in order, then each segment's flag and its ``<name>_<segment>`` columns."""
    return df.select(*columns, *[c for s in segments for c in (s, *(f"{p}_{s}" for p in per_segment))])


def conform(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Exactly the columns, missing ones and nulls empty, and which were dropped or added."""
    have = set(df.columns)
    report = {"dropped": sorted(have - set(columns)), "added": [c for c in columns if c not in have]}
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns]), report


def drop_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.drop(*fields)


def annotate_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def suffix_columns(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns})


def lowercase_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"no such fields: {missing}")
    return df.withColumns({f: F.lower(f) for f in fields})


def include_by_value(df: DataFrame, field: str, items: DataFrame, item: str = "item") -> DataFrame:
    return df.join(items.select(F.col(item).alias("_item")), F.col(field) == F.col("_item"), "left_semi")


def exclude_by_value(df: DataFrame, field: str, items: DataFrame, item: str = "item") -> DataFrame:
    return df.join(items.select(F.col(item).alias("_item")), F.col(field) == F.col("_item"), "left_anti")


def filter_records(df: DataFrame, field: str, patterns: Sequence[str], extra_field: str | None = None, values: Sequence[str] = ()) -> DataFrame:
    """Rows whose subtype fits a pattern and, if named, whose other field is one of the values in any case."""
    keep = lineage_match(F.col(field), patterns)
    if extra_field:
        keep &= F.lower(extra_field).isin(*[v.lower() for v in values])
    return df.where(keep)


def query(df: DataFrame, expression: str) -> DataFrame:
    return df.where(F.expr(expression))


def where_conditions(conditions: Sequence[str]) -> Column:
    """Any of ``col=value`` and ``col!=value``, compared as text without case; null never equals."""

    def one(text: str) -> Column:
        negated = "!=" in text
        name, value = text.split("!=" if negated else "=", 1)
        same = F.coalesce(F.lower(F.col(name).cast("string")) == value.lower(), F.lit(False))
        return ~same if negated else same

    return reduce(lambda a, b: a | b, map(one, conditions), F.lit(False))


def exclude_where(df: DataFrame, conditions: Sequence[str], include: Sequence[str] = ()) -> DataFrame:
    """Rows that meet no exclusion, or meet an inclusion, which overrides."""
    keep = ~where_conditions(conditions)
    return df.where(keep | where_conditions(include) if include else keep)


def date_between(df: DataFrame, column: str, lo: str | None, hi: str | None, as_of: Column) -> DataFrame:
    """Rows whose date, as a range if ambiguous, reaches into [lo, hi]; bounds may be relative to as_of."""
    # As text: an unknown part is 00 for the earliest day and 99 for the latest, which no bound lies between.
    text = F.col(column).cast("string")
    end = lambda part: F.replace(F.concat(F.substring(text, 1, 10), F.substr(F.lit(f"0000-{part}-{part}"), F.length(F.substring(text, 1, 10)) + 1)), F.lit("XX"), F.lit(part))
    bound = lambda x: F.date_format(relative_date(x, as_of), "yyyy-MM-dd")
    keep = text.rlike(r"^\d{4}")
    if lo:
        keep &= end("99") >= bound(lo)
    if hi:
        keep &= end("00") <= bound(hi)
    return df.where(keep)


def exclude_ambiguous(df: DataFrame, column: str, by: str = "any") -> DataFrame:
    pattern = {"year": "^[^-]*X", "month": "^[^-]*X|^[^-]*-[^-]*X", "day": "X", "any": "X"}[by]
    return df.where(~F.col(column).rlike(pattern))


def select_strains(df: DataFrame, key: str, lists: Sequence[DataFrame], item: str = "item") -> DataFrame:
    """Nothing but the rows on one of the lists."""
    wanted = reduce(lambda a, b: a.union(b), [x.select(item) for x in lists]).distinct()
    return include_by_value(df, key, wanted, item)


def select_by_host(titers: DataFrame, column: str, host: str) -> DataFrame:
    name = F.lower(column)
    if host == "ferret":
        return titers.where(~F.contains(name, F.lit("mouse")) & ~F.contains(name, F.lit("human")))
    return titers.where(F.contains(name, F.lit(host)))


def drop_bad_dates(df: DataFrame, column: str, bad: Sequence[str] = ()) -> DataFrame:
    keep = F.col(column).isNotNull() & ~F.col(column).rlike("[X?]")
    return df.where(keep & ~F.col(column).isin(*bad) if bad else keep)


def check(df: DataFrame, rules: Mapping[str, Column], mode: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Rows all rules hold for.  ``fail`` raises on the first other row; ``quarantine`` also returns those, with the rules broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    if mode == "fail":
        return df.where(F.when(F.size(broken) > 0, F.raise_error(F.concat(F.lit("broken rules: "), F.array_join(broken, ", "))).cast("boolean")).otherwise(True))
    marked = df.withColumn("broken", broken)
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def split_invalid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def missing_places(df: DataFrame, level: str, known: DataFrame, filters: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct non-empty places of a level without coordinates in ``known`` (level, place)."""
    for k, v in (filters or {}).items():
        df = df.where(F.col(k) == v)
    places = df.select(F.lit(level).alias("level"), F.col(level).alias("place")).where("place <> ''").distinct()
    return places.join(known.select("level", "place"), ["level", "place"], "left_anti")


def offset_sites(df: DataFrame, offset: int) -> DataFrame:
    return df.withColumn("site", F.when(F.col("gene").rlike("nuc"), F.col("site") + offset).otherwise(F.col("site")))


def floor_and_renormalise(df: DataFrame, column: str, least: float, by: Sequence[str] = ()) -> DataFrame:
    """Values under the floor become 0 and the others are divided by their sum (per group, or over all); all 0 where none is left."""
    kept = df.withColumn(column, F.when(F.col(column) < least, 0.0).otherwise(F.col(column)))
    if not by:
        total = kept.agg(F.sum(column)).scalar()
        return kept.withColumn("_total", total).withColumn(column, F.coalesce(F.try_divide(F.col(column), F.col("_total")), F.lit(0.0))).drop("_total")
    totals = kept.groupBy(*by).agg(F.sum(column).alias("_total"))
    return kept.join(totals, list(by)).withColumn(column, F.coalesce(F.try_divide(F.col(column), F.col("_total")), F.lit(0.0))).drop("_total")


def filter_by_region(seqs: DataFrame, region: str, gene: str, genes: Sequence[str]) -> DataFrame:
    """The sequences of regions that have one of every gene; nulls are no region."""
    full = seqs.where(F.col(gene).isin(*genes) & F.col(region).isNotNull()).groupBy(region).agg(F.count_distinct(gene).alias("_n")).where(F.col("_n") == len(set(genes))).select(region)
    return seqs.where(F.col(gene).isin(*genes)).join(full, region, "left_semi")
