"""Joins and lookups: linking records, merging tables, rules with wildcards, as-of and offset joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineagrid.functions.scalars import simplify_name


def link_sequences(meta: DataFrame, seqs: DataFrame, segments: Mapping[str, str], key: str, pattern: str = r"(EPI\d+)") -> DataFrame:
    """meta with ``sequences``: segment -> array of (accession, sequence), empty where a segment has none.

    Segment columns hold comma-separated ids; the accession is what the pattern finds in one.  ``seqs`` has accession
    and sequence.
    """
    long = meta.select(key, F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(c).alias("ids")) for s, c in segments.items()])).alias("x")).select(key, "x.*")
    ids = long.select(key, "segment", F.explode(F.split(F.coalesce("ids", F.lit("")), ",")).alias("_id"))
    found = ids.select(key, "segment", F.regexp_extract("_id", pattern, 1).alias("accession")).where("accession <> ''").join(seqs.select("accession", "sequence"), "accession")
    lists = found.groupBy(key, "segment").agg(F.array_sort(F.collect_list(F.struct("accession", "sequence"))).alias("of"))
    maps = lists.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("segment", "of"))).alias("_found"))
    empty = F.array().cast("array<struct<accession:string,sequence:string>>")
    entries = [x for s in segments for x in (F.lit(s), F.coalesce(F.try_element_at("_found", F.lit(s)), empty))]
    return meta.join(maps, key, "left").withColumn("sequences", F.create_map(*entries)).drop("_found")


def link_report(linked: DataFrame, required: Sequence[str]) -> DataFrame:
    """Records, and how many lack each required segment and all of them."""
    lacks = {s: F.size(F.try_element_at("sequences", F.lit(s))) <= 0 for s in required}
    return linked.agg(F.count("*").alias("records"), *[F.count_if(v).alias(f"without_{s}") for s, v in lacks.items()], F.count_if(reduce(lambda a, b: a & b, lacks.values())).alias("without_any"))


def merge_header_fields(headers: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One value of each field per record, which its headers must agree on; an error where they don't."""
    agreed = lambda f: F.when(F.count_distinct(f) > 1, F.raise_error(F.concat(F.lit(f"{f} differs in "), F.first(F.col(key).cast("string")))).cast("string")).otherwise(F.max(f))
    return headers.groupBy(key).agg(*[agreed(f).alias(f) for f in fields])


def link_by_composite(meta: DataFrame, seqs: DataFrame, key: str, segments: Sequence[int]) -> DataFrame:
    """meta with segment and sequence found under ``<key>_<segment>``; null where there is none."""
    long = meta.withColumn("segment", F.explode(F.array(*[F.lit(s) for s in segments]))).withColumn("_id", F.concat_ws("_", F.col(key), F.col("segment").cast("string")))
    return long.join(seqs.select(F.col("id").alias("_id"), "sequence"), "_id", "left").drop("_id")


def lineage_dimension(spark: SparkSession, ha: int = 19, na: int = 11, unknown: str = "n/a") -> DataFrame:
    """(subtype, lineage, type, subtype_name, name) for :func:`map_lineage`, of all combinations of HA and NA numbers.

    The type A names follow a rule; the other rows are fixed values.
    """
    both = spark.range(1, ha + 1).select(F.col("id").alias("h"), F.explode(F.array(F.lit(None).cast("long"), *[F.lit(n) for n in range(1, na + 1)])).alias("n"))
    named = both.select(F.concat(F.lit("h"), "h", F.coalesce(F.concat(F.lit("n"), "n"), F.lit(""))).alias("k")).union(spark.range(1, na + 1).select(F.concat(F.lit("n"), "id")))
    a = named.select(F.concat(F.lit("a / "), "k").alias("subtype"), F.lit("").alias("lineage"), F.lit("a").alias("type"), F.col("k").alias("subtype_name"), F.col("k").alias("name"))
    # Subtypes and lineages as sources write them, and their standard names.
    fixed = [
        ("a", "", "a", unknown, unknown),
        ("a / h1n1", "pdm09", "a", "h1n1", "h1n1pdm"),
        ("b", "", "b", unknown, unknown),
        ("b", "victoria", "b", unknown, "vic"),
        ("b", "yamagata", "b", unknown, "yam"),
        ("c", "", "c", unknown, unknown),
    ]
    return a.union(spark.createDataFrame(fixed, a.schema))


def map_lineage(df: DataFrame, subtype: str, lineage: str, note: Column, dim: DataFrame, default: str = "tbd") -> DataFrame:
    """type and subtype_lineage by (subtype, lineage) from ``dim``; an empty lineage is read from the note; default if unknown.

    ``seasonal`` says nothing and counts as empty.
    """
    given = F.when(F.lower(lineage) == "seasonal", F.lit("")).otherwise(F.coalesce(F.lower(lineage), F.lit("")))
    keyed = df.withColumn("_l", F.when(given == "", note).otherwise(given)).withColumn("_s", F.lower(subtype))
    look = dim.select(F.col("subtype").alias("_s"), F.col("lineage").alias("_l"), F.col("type").alias("_type"), F.col("name").alias("_name"))
    out = keyed.join(look, ["_s", "_l"], "left")
    return out.withColumns({"type": F.coalesce("_type", F.lit(default)), "standard_lineage": F.coalesce("_name", F.lit(default))}).drop("_s", "_l", "_type", "_name")


def apply_annotations(df: DataFrame, annotations: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Per-key overrides (key, field, value; the last by ``rule_order`` wins) put over the fields."""
    last = annotations.groupBy(key, "field").agg(F.max_by("value", "rule_order").alias("value"))
    maps = last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_over"))
    return df.join(maps, key, "left").withColumns({f: F.coalesce(F.try_element_at("_over", F.lit(f)), F.col(f)) for f in fields}).drop("_over")


def unnecessary_annotations(df: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """Overrides that say what a record says already."""
    values = F.to_json(F.struct(*[c for c in df.columns if c != key]))
    return annotations.join(df.select(key, F.from_json(values, "map<string,string>").alias("_v")), key).where(F.try_element_at("_v", F.col("field")).eqNullSafe(F.col("value"))).drop("_v")


def apply_location_rules(df: DataFrame, parts: str, rules: DataFrame, row_key: str) -> DataFrame:
    """The parts rewritten by the first rule (raw, new, rule_order) of the same length that fits; ``*`` fits any part and copies it.

    Rules with wildcards are grouped by the places they fix, so each group is an equality join on those parts.
    """
    places = F.filter(F.transform("raw", lambda x, i: F.when(x != "*", i)), lambda x: x.isNotNull())
    keyed = rules.withColumn("mask", places).withColumn("n", F.size("raw")).withColumn("fixed", F.filter("raw", lambda x: x != "*"))
    masks = keyed.select("n", "mask").distinct()
    tries = df.select(row_key, F.col(parts).alias("_p")).join(masks, F.size("_p") == F.col("n")).withColumn("fixed", F.transform("mask", lambda i: F.get(F.col("_p"), i)))
    hits = tries.join(keyed.select("n", "mask", "fixed", "raw", "new", "rule_order"), ["n", "mask", "fixed"])
    first = hits.groupBy(row_key).agg(F.min_by(F.struct("raw", "new"), "rule_order").alias("_rule"))
    wild = F.filter(F.transform(F.col("_rule.raw"), lambda x, i: F.when(x == "*", F.get(F.col(parts), i))), lambda x: x.isNotNull())
    rewritten = F.transform(F.col("_rule.new"), lambda x: F.when(x == "*", F.get(wild, F.lit(0))).otherwise(x))
    return df.join(first, row_key, "left").withColumn(parts, F.when(F.col("_rule").isNull(), F.col(parts)).otherwise(rewritten)).drop("_rule")


def apply_geolocation_rules(df: DataFrame, rules: DataFrame, row_key: str, columns: Sequence[str] = ("region", "country", "division", "location")) -> DataFrame:
    """The four fields rewritten by the most specific rule (raw, new, rule_order) that fits; ``*`` keeps the field."""
    wild = F.size(F.filter("raw", lambda x: x == "*"))
    masks = F.filter(F.transform("raw", lambda x, i: F.when(x != "*", i)), lambda x: x.isNotNull())
    keyed = rules.withColumns({"mask": masks, "fixed": F.filter("raw", lambda x: x != "*"), "rank": F.struct(wild.alias("w"), "rule_order")})
    tries = df.select(row_key, F.array(*columns).alias("_p")).join(F.broadcast(keyed.select("mask").distinct())).withColumn("fixed", F.transform("mask", lambda i: F.get(F.col("_p"), i)))
    best = tries.join(keyed, ["mask", "fixed"]).groupBy(row_key).agg(F.min_by("new", "rank").alias("_new"))
    out = df.join(best, row_key, "left")
    return out.withColumns({c: F.when(F.col("_new").isNull() | (F.get("_new", F.lit(i)) == "*"), F.col(c)).otherwise(F.get("_new", F.lit(i))) for i, c in enumerate(columns)}).drop("_new")


def flag_members(df: DataFrame, items: DataFrame, key: str, name: str, item: str = "item") -> DataFrame:
    """``True`` or ``False`` as text in ``name``: whether the key is among the items."""
    known = items.select(F.col(item).alias("_item")).distinct().withColumn("_in", F.lit("True"))
    return df.join(known, F.col(key) == F.col("_item"), "left").withColumn(name, F.coalesce("_in", F.lit("False"))).drop("_item", "_in")


def merge_metadata(sources: Sequence[tuple[str, DataFrame, str]], key: str, flags: bool = False) -> DataFrame:
    """All records of (name, table, id column); later non-empty values replace earlier ones; flags say which table had the key."""
    out, seen = None, []
    for name, df, id_column in sources:
        df = df.withColumnRenamed(id_column, key)
        new = df.select(F.col(key), *[F.col(c).cast("string").alias(f"_n_{c}") for c in df.columns if c != key], F.lit(1).alias(f"_in_{name}"))
        out = new if out is None else out.join(new, key, "full_outer")
        news = [c for c in df.columns if c != key]
        merged = {c: F.coalesce(F.nullif(F.col(f"_n_{c}"), F.lit("")), F.col(c) if c in seen else F.lit(None).cast("string"), F.col(f"_n_{c}")) for c in news}
        out = out.withColumns(merged).drop(*[f"_n_{c}" for c in news])
        seen += [c for c in news if c not in seen]
    inside = [(n, f"_in_{n}") for n, _, _ in sources]
    if flags:
        out = out.withColumns({f"in_{n}": F.col(c).isNotNull() for n, c in inside})
    return out.drop(*[c for _, c in inside])


def merge_sequences(inputs: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """All sequences; of one id the last input's."""
    ranked = reduce(lambda a, b: a.unionByName(b), [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(inputs)])
    columns = [c for c in ranked.columns if c not in (key, "_rank")]
    return ranked.groupBy(key).agg(F.max_by(F.struct(*columns), "_rank").alias("x")).select(key, "x.*")


def join_tables(left: DataFrame, right: DataFrame, how: str, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), how)


def join_segments(tables: Mapping[str, DataFrame], key: str, columns: Sequence[str], how: str = "outer") -> DataFrame:
    """Segment tables side by side with ``<column>_<segment>`` and a presence flag for each segment."""
    parts = [df.select(key, *[F.col(c).alias(f"{c}_{s}") for c in columns], F.lit(True).alias(s)) for s, df in tables.items()]
    out = reduce(lambda a, b: a.join(b, key, how), parts)
    return out.withColumns({s: F.coalesce(F.col(s), F.lit(False)) for s in tables})


def join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return left.join(right.withColumnRenamed(right_key, "_key"), F.col(left_key) == F.col("_key")).drop("_key")


def star(facts: DataFrame, dims: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Facts joined to dimensions (fact column, table, key); a dimension's other columns get the fact column as suffix."""
    for column, dim, key in dims:
        renamed = dim.select(F.col(key).alias("_key"), *[F.col(c).alias(f"{c}_{column}") for c in dim.columns if c != key])
        facts = facts.join(renamed, F.col(column) == F.col("_key")).drop("_key")
    return facts


def attach_first_source(df: DataFrame, raw: DataFrame, keys: Sequence[str], source: str, order: str, default: str = "unknown") -> DataFrame:
    """The source of the first matching raw row."""
    first = raw.groupBy(*keys).agg(F.min_by(source, order).alias("_source"))
    return df.join(first, list(keys), "left").withColumn(source, F.coalesce("_source", F.lit(default))).drop("_source")


def match_names(names: DataFrame, column: str, meta: DataFrame, strain: str, hard: DataFrame, bridge: DataFrame, fixes: Column) -> DataFrame:
    """(column, matched, stage): the strain of each distinct name by ordered lookups.

    Stages: a fixed map (name, strain); equality; an older name's id in ``bridge`` (old_name, new_name); equality after
    corrections (``fixes``, a column of ``column``); equality of simplified names if only one strain has it.  The last is
    a possible match only.
    """
    strains = meta.select(F.col(strain).alias("s")).distinct()
    simple = strains.withColumn("k", simplify_name(F.col("s"))).groupBy("k").agg(F.min("s").alias("m_simplified"), F.count("*").alias("c")).where("c = 1").drop("c")
    q = names.select(column).distinct().withColumns({"_fixed": fixes, "_k": simplify_name(F.col(column))})
    q = q.join(hard.select(F.col("name").alias(column), F.col("strain").alias("m_hard")), column, "left")
    q = q.join(strains.select(F.col("s").alias(column), F.col("s").alias("m_exact")), column, "left")
    q = q.join(bridge.select(F.col("old_name").alias(column), F.col("new_name").alias("m_bridge")).dropDuplicates([column]), column, "left")
    q = q.join(strains.select(F.col("s").alias("_fixed"), F.col("s").alias("m_corrected")), "_fixed", "left").join(simple.withColumnRenamed("k", "_k"), "_k", "left")
    stages = ["hard", "exact", "bridge", "corrected", "simplified"]
    stage = reduce(lambda rest, s: F.when(F.col(f"m_{s}").isNotNull(), F.lit(s)).otherwise(rest), reversed(stages), F.lit("none"))
    return q.select(column, F.coalesce(*[f"m_{s}" for s in stages]).alias("matched"), stage.alias("stage"))


def name_map_by_id(old: DataFrame, new: DataFrame, key: str, name: str) -> DataFrame:
    """Each old name's new one by id: unchanged, changed or missing."""
    out = old.select(key, F.col(name).alias("old_name")).join(new.select(key, F.col(name).alias("new_name")), key, "left")
    return out.withColumn("status", F.when(F.col("new_name").isNull(), "missing").when(F.col("old_name") == F.col("new_name"), "unchanged").otherwise("changed"))


def link_in_stages(a: DataFrame, b: DataFrame, a_key: str, b_key: str, stages: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """(a_key, b_key, stage) by stages of (name, expression on a, expression on b), each over what the ones before left.

    Within a stage, a value links the smallest keys that have it; the others wait for later stages.
    """
    found, left_a, left_b = None, a, b
    for name, on_a, on_b in stages:
        x = left_a.select(F.col(a_key).alias("_a"), on_a.alias("_v")).where("_v is not null and _v <> ''").groupBy("_v").agg(F.min("_a").alias("_a"))
        y = left_b.select(F.col(b_key).alias("_b"), on_b.alias("_v")).where("_v is not null and _v <> ''").groupBy("_v").agg(F.min("_b").alias("_b"))
        hit = x.join(y, "_v").select(F.col("_a").alias(a_key), F.col("_b").alias(b_key), F.lit(name).alias("stage"))
        # A record that several values of a stage would link takes the smallest partner, and so does the partner.
        hit = hit.groupBy(a_key, "stage").agg(F.min(b_key).alias(b_key)).groupBy(b_key, "stage").agg(F.min(a_key).alias(a_key)).select(a_key, b_key, "stage")
        found = hit if found is None else found.union(hit)
        left_a = left_a.join(hit.select(a_key), a_key, "left_anti")
        left_b = left_b.join(hit.select(b_key), b_key, "left_anti")
    return found


def fuzzy_pairs(queries: DataFrame, names: DataFrame, q: str, n: str, least: float = 0.8) -> DataFrame:
    """(q, n, _x, _y) of the pairs that may reach the similarity, with their simplified names.

    A name of l characters has partners of at most l / least, so at most d = floor((1 - least) l / least) edits apart; these
    spoil g d of its pieces of g letters, and one of any g d + 1 pieces is in the partner, d places away at most.  Names are
    posted under all their pieces of three and of two letters, a query under the g d + 1 that fewest names of its block
    have: of three letters, or of two where it hasn't so many.  A query too short for both meets its whole block.
    """
    key = lambda c: F.struct(F.translate(F.regexp_replace(c, "[^0-9]", ""), "0", "").alias("d"), c.endswith("-egg").alias("e"))
    none = F.array().cast("array<struct<i:int,g:string>>")

    def pieces(c: Column, size: int) -> Column:
        last = F.length(c) - size + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(i.alias("i"), F.substr(c, i, F.lit(size)).alias("g")))).otherwise(none)

    x = queries.select(q, key(F.col(q)).alias("_k"), simplify_name(F.col(q)).alias("_x")).where(F.col(q).isNotNull()).distinct()
    y = names.select(n, key(F.col(n)).alias("_k"), simplify_name(F.col(n)).alias("_y")).where(F.col(n).isNotNull()).distinct()
    x = x.withColumn("_d", F.floor((1 - least) * F.length("_x") / least + 1e-9))
    size = F.when(F.length("_x") - 2 > 3 * F.col("_d"), 3).when(F.length("_x") - 1 > 2 * F.col("_d"), 2)
    x = x.withColumn("_size", size)
    posted = y.select(n, "_k", "_y", F.explode(F.concat(pieces(F.col("_y"), 3), pieces(F.col("_y"), 2))).alias("_p")).select(n, "_k", "_y", F.col("_p.i").alias("_j"), F.col("_p.g").alias("_g"))
    common = posted.groupBy("_k", "_g").agg(F.count("*").alias("_df"))
    asked = x.where("_size is not null").select(q, "_k", "_x", "_d", "_size", F.explode(F.when(F.col("_size") == 3, pieces(F.col("_x"), 3)).otherwise(pieces(F.col("_x"), 2))).alias("_p")).select(q, "_k", "_x", "_d", "_size", "_p.*")
    # A piece that no name has is the rarest, and joins nothing.
    ranked = asked.withColumnRenamed("g", "_g").join(common, ["_k", "_g"], "left").withColumn("_r", F.row_number().over(Window.partitionBy(q).orderBy(F.coalesce("_df", F.lit(0)), "i")))
    prefix = ranked.where("_r <= _size * _d + 1").select(q, "_k", "_x", "_d", "i", "_g")
    fits = F.least(F.length("_x"), F.length("_y")) >= least * F.greatest(F.length("_x"), F.length("_y")) - 1e-9
    near = prefix.join(posted, ["_k", "_g"]).where(fits & (F.abs(F.col("i") - F.col("_j")) <= F.col("_d"))).select(q, n, "_x", "_y")
    return near.union(x.where("_size is null").join(y, "_k").where(fits).select(q, n, "_x", "_y")).distinct()


def fuzzy_candidates(queries: DataFrame, names: DataFrame, q: str, n: str, least: float = 0.8, k: int = 3) -> DataFrame:
    """The k names most similar to each query among those with the same digits but zeros and the same egg suffix.

    Similarity is 1 less the Levenshtein distance over the longer length, of simplified names; ties by name.  Null names
    have no partners.
    """
    score = 1 - F.levenshtein("_x", "_y") / F.greatest(F.length("_x"), F.length("_y"), F.lit(1))
    scored = fuzzy_pairs(queries, names, q, n, least).select(q, n, F.round(score, 6).alias("similarity")).where(F.col("similarity") >= least)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(q).orderBy(F.desc("similarity"), n)))
    return ranked.where(F.col("rank") <= k).select(q, "rank", n, "similarity")


def asof_window(df: DataFrame, t: str, windows: DataFrame, key: str, past_last: bool = True) -> DataFrame:
    """Each row with the first window (window_start, window_end) that ends after t, or with the last if t is past all.

    A window that starts after t gives nulls.  The windows are a calendar's worth of rows; each row looks them up in one
    sorted array, without a shuffle.  ``key`` is not needed to tell rows apart and stays for callers that name it.
    """
    listed = windows.where("window_end is not null").agg(F.array_sort(F.collect_list(F.struct("window_end", "window_start"))).alias("w"))
    later = F.filter("_windows", lambda w: w["window_end"] > F.col(t))
    hit = F.get(later, F.lit(0))
    if past_last:
        hit = F.when(F.col(t).isNotNull(), F.coalesce(hit, F.try_element_at("_windows", F.lit(-1))))
    out = df.withColumn("_windows", listed.scalar()).withColumn("_hit", hit)
    late = F.coalesce(F.col("_hit.window_start") > F.col(t), F.lit(False))
    return out.withColumns({"window_end": F.when(~late, F.col("_hit.window_end")), "window_start": F.when(~late, F.col("_hit.window_start"))}).drop("_windows", "_hit")


def join_offset(a: DataFrame, b: DataFrame, t: str, months: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of a with those of b whose t is ``months`` later; b's other columns get the prefix other_."""
    other = b.select(F.col(t).alias("_t"), *[F.col(c).alias(f"_k_{c}") for c in keys], *[F.col(c).alias(f"other_{c}") for c in b.columns if c not in keys])
    on = [F.add_months(F.col(t), months) == F.col("_t"), *[F.col(c) == F.col(f"_k_{c}") for c in keys]]
    return a.join(other, on).drop("_t", *[f"_k_{c}" for c in keys])


def join_past(current: DataFrame, past: DataFrame, t: str, years: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with past rows strictly earlier by at most ``years``; joined by year buckets, each row to years + 1 of them."""
    x = current.withColumn("_bucket", F.explode(F.sequence(F.year(t) - years, F.year(t))))
    y = past.select(F.year(t).alias("_bucket"), F.col(t).alias("_t"), *[F.col(c).alias(f"_k_{c}") for c in keys], *[F.col(c).alias(f"past_{c}") for c in past.columns if c not in keys])
    on = [x["_bucket"] == y["_bucket"], y["_t"] < x[t], y["_t"] >= F.add_months(x[t], -12 * years), *[x[c] == y[f"_k_{c}"] for c in keys]]
    return x.join(y, on).drop("_bucket", "_t", *[f"_k_{c}" for c in keys])


def keep_common(tables: Sequence[DataFrame], key: str) -> list[DataFrame]:
    """Each table's rows whose key all of them have."""
    common = reduce(lambda a, b: a.intersect(b), [df.select(key) for df in tables])
    return [df.join(common, key, "left_semi") for df in tables]


def join_rounded(left: DataFrame, right: DataFrame, on: Sequence[str], digits: int = 3) -> DataFrame:
    out = left.join(right, list(on))
    return out.withColumns({f.name: F.round(f.name, digits) for f in out.schema if f.dataType.typeName() == "double"})


def override_locations(df: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str], derived: Mapping[str, Column]) -> DataFrame:
    """Columns from an override of the same id, whole; rows without one get the derived expressions.

    An override ends the matter: no derived rule applies to its row, and parts that it leaves out are empty.
    """
    fixed = overrides.select(F.col(key).alias("_id"), *[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_fixed"))
    out = df.join(fixed, F.col(key) == F.col("_id"), "left")
    made = {c: F.when(F.col("_fixed"), F.coalesce(f"_o_{c}", F.lit(""))).otherwise(derived[c]) for c in columns}
    return out.withColumns(made).drop("_id", "_fixed", *[f"_o_{c}" for c in columns])


def coverage_for(df: DataFrame, country: str, codes: DataFrame, covered: DataFrame) -> DataFrame:
    """Rows with the coverage of their country, given as a name or as a code of ``codes`` (code, country); null where unknown."""
    named = df.join(codes.select(F.col("code").alias("_code"), F.col("country").alias("_name")), F.col(country) == F.col("_code"), "left")
    named = named.withColumn("_place", F.coalesce("_name", country)).drop("_code", "_name")
    return named.join(covered.select(F.col("country").alias("_place"), "coverage"), "_place", "left").drop("_place")
