"""Aggregations, summaries and reshaping of long and nested tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def count_with_total(df: DataFrame, key: str, name: str = "n", total: str = "total") -> DataFrame:
    """Counts per key and a row ``total``."""
    return df.rollup(key).agg(F.count("*").alias(name), F.grouping(key).alias("_g")).withColumn(key, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key))).drop("_g")


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(name or measure))


def summarise_haplotypes(df: DataFrame, key: str, date: str, distinct_of: Sequence[str], best_of: Sequence[str], by: str, tie: str, mean_of: Sequence[str]) -> DataFrame:
    """Per key: count, distinct counts, latest date, columns of the row that is largest by ``by`` (ties: smallest ``tie``), and means."""
    best = F.min_by(F.struct(*best_of), F.struct((-F.col(by)).alias("o"), F.col(tie).alias("t")))
    out = df.groupBy(key).agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct_of], F.max(date).alias("latest"), best.alias("_best"), *[F.avg(c).alias(f"mean_{c}") for c in mean_of])
    return out.select("*", *[F.col(f"_best.{c}").alias(f"best_{c}") for c in best_of]).drop("_best")


def modal_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """The commonest value of each key and its count; ties go to the smallest value."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct((-F.col("n")).alias("c"), F.col(value).alias("v"))).alias("x")).select(key, F.col(f"x.{value}").alias(value), F.col("x.n").alias("n"))


def proportion_of_total(df: DataFrame, key: str, item: str, name: str = "proportion") -> DataFrame:
    """Distinct items of each key over the distinct items of all."""
    total = df.agg(F.count_distinct(item)).scalar()
    return df.groupBy(key).agg(F.count_distinct(item).alias("n")).withColumn("_t", total).withColumn(name, F.try_divide(F.col("n"), F.col("_t"))).drop("_t")


def count_and_collect(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of each key and its distinct values in order."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_set(value)).alias("items"))


def merge_missing(tables: Sequence[DataFrame], key: str, sums: Sequence[str], sets: Sequence[str], scalars: Sequence[str], sep: str = ",") -> DataFrame:
    """Tables merged by key: counts added, comma lists united in order, scalars that differ become ``ERROR``, which sticks."""
    rows = reduce(lambda a, b: a.unionByName(b), tables)
    united = lambda c: F.array_join(F.sort_array(F.array_distinct(F.filter(F.flatten(F.collect_list(F.split(F.coalesce(F.col(c), F.lit("")), sep))), lambda x: x != ""))), sep)
    one = lambda c: F.when(F.count_distinct(F.nullif(F.col(c), F.lit(""))) > 1, F.lit("ERROR")).otherwise(F.coalesce(F.max(c), F.lit("")))
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums], *[united(c).alias(c) for c in sets], *[one(c).alias(c) for c in scalars])


def match_stats(df: DataFrame, year: str, virus: str, serum: str, status: str) -> DataFrame:
    """Per year and in total: distinct strains and distinct pairs, all, matched, and possibly matched."""
    pairs = df.select(year, virus, serum, status).distinct()
    strains = pairs.select(year, virus, status).distinct()

    def rolled(rows: DataFrame, prefix: str) -> DataFrame:
        out = rows.rollup(year).agg(
            F.count("*").alias(f"{prefix}_total"), F.count_if(F.col(status) == "match").alias(f"{prefix}_match"), F.count_if(F.col(status) == "potential").alias(f"{prefix}_potential"), F.grouping(year).alias("_g")
        )
        return out.withColumn(year, F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col(year).cast("string"))).drop("_g")

    return rolled(strains, "strains").join(rolled(pairs, "pairs"), year)


def match_rates(stats: DataFrame, year: str, prefixes: Sequence[str] = ("strains", "pairs")) -> DataFrame:
    """Percentages of matches and possible matches."""
    return stats.select(year, *[(100 * F.try_divide(F.col(f"{p}_{k}"), F.col(f"{p}_total"))).alias(f"{p}_{k}_pct") for p in prefixes for k in ("match", "potential")])


def missing_strains(df: DataFrame, roles: Sequence[str], candidate: str) -> DataFrame:
    """Per unmatched name: times in each role, and a possible match."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("name")) for r in roles])).alias("x"), candidate).select("x.*", candidate)
    return long.groupBy("name").agg(*[F.count_if(F.col("role") == r).alias(f"{r}_count") for r in roles], F.min(candidate).alias(candidate))


def median_band(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Median, and median less and plus a standard deviation, of each column."""
    out = df.groupBy(key).agg(*[f(c).alias(f"{n}_{c}") for c in columns for f, n in ((F.median, "median"), (F.stddev_samp, "sd"))])
    return out.select(key, *[x for c in columns for x in (F.col(f"median_{c}"), (F.col(f"median_{c}") - F.col(f"sd_{c}")).alias(f"low_{c}"), (F.col(f"median_{c}") + F.col(f"sd_{c}")).alias(f"high_{c}"))])


def threshold_sites(df: DataFrame, serum: str, site: str, value: str, n_sd: float = 4.0) -> DataFrame:
    """Sera at whose site the summed value reaches the serum's mean plus n_sd standard deviations, counted per site."""
    sums = df.groupBy(serum, site).agg(F.sum(value).alias("total"))
    levels = sums.groupBy(serum).agg((F.avg("total") + n_sd * F.stddev_samp("total")).alias("level"))
    return sums.join(levels, serum).where("total >= level").groupBy(site).agg(F.count_distinct(serum).alias("n_sera"))


def weights_by_substitution(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.8) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean_weight"), F.percentile(value, F.lit(q)).alias("high_weight"))


def phenotype_to_map(df: DataFrame, column: str, shift_region: str = "HA2") -> DataFrame:
    """Distance-map rows (gene, site, from, to, weight); sites of the second region follow the first's last; synonymous and null left out."""
    last = df.where(F.col("region") != shift_region).agg(F.coalesce(F.max("site"), F.lit(0))).scalar()
    rows = df.withColumn("_last", last).where((F.col("wildtype") != F.col("mutant")) & F.col(column).isNotNull())
    return rows.select(F.col("region").alias("gene"), F.when(F.col("region") == shift_region, F.col("site") + F.col("_last")).otherwise(F.col("site")).alias("site"), F.col("wildtype").alias("from"), F.col("mutant").alias("to"), F.col(column).alias("weight"))


def recurrent_mutations(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n commonest entries of an array column; ties by value."""
    return df.select(F.explode(column).alias("mutation")).groupBy("mutation").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mutation").limit(n)


def titer_by_clade(df: DataFrame, reference: str, strain: str, clade: str, value: str, how: str = "geometric", potency: DataFrame | None = None) -> DataFrame:
    """Mean of per-strain means, per reference and clade; less the reference's mean potency if given."""
    mean = {"arithmetic": F.avg(value), "geometric": F.exp(F.avg(F.ln(value))), "median": F.median(value)}[how]
    out = df.groupBy(reference, clade, strain).agg(mean.alias("m")).groupBy(reference, clade).agg(F.avg("m").alias("titer"))
    return out if potency is None else out.join(potency, reference, "left").withColumn("titer", F.col("titer") - F.coalesce("potency", F.lit(0.0))).drop("potency")


def autologous(df: DataFrame, reference: str, test: str, value: str) -> DataFrame:
    return df.where(F.col(reference) == F.col(test)).groupBy(reference).agg(F.median(value).alias("autologous"))


def reference_profile(df: DataFrame, reference: str, clade: str, distance: str) -> DataFrame:
    """Mean and standard deviation per reference and clade, with the clade's rank by its rows and mean."""
    clades = df.groupBy(clade).agg(F.count("*").alias("_n"), F.avg(distance).alias("_m"))
    ranked = clades.withColumn("clade_order", F.row_number().over(Window.orderBy(F.desc("_n"), "_m", clade))).select(clade, "clade_order")
    return df.groupBy(reference, clade).agg(F.avg(distance).alias("mean"), F.stddev_samp(distance).alias("sd")).join(ranked, clade)


def status_share(df: DataFrame, key: str, status: str, values: Sequence[str], sample: str) -> DataFrame:
    """Per key, each status's rows over the key's distinct samples."""
    return df.groupBy(key).agg(*[F.try_divide(F.count_if(F.col(status) == v), F.count_distinct(sample)).alias(v) for v in values])


def coverage(tables: Sequence[DataFrame], place: str, year: str, value: str, last: int = 3) -> DataFrame:
    """Each source's mean over a place's last years, then the median across sources."""
    means = []
    for i, df in enumerate(tables):
        recent = Window.partitionBy(place).orderBy(F.desc(year))
        means.append(df.withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= last).groupBy(place).agg(F.avg(value).alias("m")).withColumn("source", F.lit(i)))
    return reduce(lambda a, b: a.union(b), means).groupBy(place).agg(F.median("m").alias("coverage"))


def relative_fitness(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Log ratio of each row's value to the weighted mean of all."""
    mean = df.agg(F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).scalar()
    return df.withColumn("_m", mean).withColumn("relative_fitness", F.ln(F.col(value) / F.col("_m"))).drop("_m")


def score_haplotypes(df: DataFrame, mutations: Mapping[str, float], fitness: str, proportion: str) -> DataFrame:
    """s / (median s + s) of weighted mutations, plus fitness over its largest magnitude, plus proportion."""
    s = reduce(lambda a, b: a + b, [w * F.col(c) for c, w in mutations.items()])
    scored = df.withColumn("_s", s)
    scored = scored.withColumns({"_med": scored.agg(F.median("_s")).scalar(), "_top": scored.agg(F.max(F.abs(fitness))).scalar()})
    score = F.coalesce(F.try_divide(F.col("_s"), F.col("_med") + F.col("_s")), F.lit(0.0)) + F.coalesce(F.try_divide(F.col(fitness), F.col("_top")), F.lit(0.0)) + F.col(proportion)
    return scored.withColumn("score", score).drop("_s", "_med", "_top")


# -- reshaping ----------------------------------------------------------------------------------------------------

def node_table(nodes: DataFrame, metadata: DataFrame, edges: DataFrame, node: str = "node", strain: str = "strain") -> DataFrame:
    tips = edges.where("is_terminal").select(node)
    return nodes.join(tips, node, "left_semi").join(metadata.withColumnRenamed(strain, node), node, "left")


def merge_node_data(tables: Sequence[DataFrame], node: str = "node") -> DataFrame:
    """Tables side by side by node; of a column that several have, the last non-null value."""
    out = tables[0]
    for df in tables[1:]:
        both = [c for c in df.columns if c in out.columns and c != node]
        out = out.join(df.withColumnsRenamed({c: f"_n_{c}" for c in both}), node, "full_outer").withColumns({c: F.coalesce(f"_n_{c}", c) for c in both}).drop(*[f"_n_{c}" for c in both])
    return out


def pivot_results(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).pivot(name, list(values)).agg(F.first(value))


def add_pivot_variant(df: DataFrame, variant: str, place: str, statistics: Sequence[str], pivot: str) -> DataFrame:
    """A row of 1.0 statistics for the pivot variant in each place that lacks it."""
    lacking = df.select(place).distinct().join(df.where(F.col(variant) == pivot).select(place), place, "left_anti")
    rows = lacking.select(*[F.col(c) if c == place else F.lit(pivot).alias(c) if c == variant else (F.lit(1.0) if c in statistics else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in df.columns])
    return df.unionByName(rows)


def last_value(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.try_element_at(column, F.lit(-1))).drop(column)


def explode_frequencies(df: DataFrame, node: str, pivots: str, values: str, projection: str | None = None) -> DataFrame:
    """(node, pivot_idx, pivot, frequency[, observed]) of paired arrays."""
    out = df.select(node, *([projection] if projection else []), F.posexplode(F.arrays_zip(F.col(pivots).alias("p"), F.col(values).alias("f"))).alias("pivot_idx", "x")).select(node, *([projection] if projection else []), "pivot_idx", F.col("x.p").alias("pivot"), F.col("x.f").alias("frequency"))
    return out.withColumn("observed", F.col("pivot") <= F.col(projection)).drop(projection) if projection else out


def collect_frequencies(df: DataFrame, node: str) -> DataFrame:
    """The inverse: arrays of pivots and frequencies in order of pivot_idx."""
    return df.groupBy(node).agg(F.array_sort(F.collect_list(F.struct("pivot_idx", "pivot", "frequency"))).alias("x")).select(node, F.col("x.pivot").alias("pivots"), F.col("x.frequency").alias("frequencies"))


def extend_trajectories(df: DataFrame, projected: DataFrame, node: str, pivots: Sequence[float]) -> DataFrame:
    """(node, pivots, frequencies): long rows with pivots appended, each node's projected value at them or 0.0.

    df has (node, pivot_idx, pivot, frequency); projected (node, pivot, frequency); only nodes of df appear.
    """
    last = df.agg(F.max("pivot_idx")).scalar()
    ahead = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(float(p)).alias("pivot")) for i, p in enumerate(pivots)])).alias("x")
    grid = df.select(node).distinct().withColumn("_last", last).select(node, "_last", ahead).select(node, (F.col("_last") + F.col("x.i")).alias("pivot_idx"), F.col("x.pivot").alias("pivot"))
    more = grid.join(projected.select(node, "pivot", "frequency"), [node, "pivot"], "left").select(node, "pivot_idx", "pivot", F.coalesce("frequency", F.lit(0.0)).alias("frequency"))
    return collect_frequencies(df.select(node, "pivot_idx", "pivot", "frequency").unionByName(more), node)


def concat_genes(seqs: DataFrame, strain: str, gene: str, seq: str, order: Sequence[str]) -> DataFrame:
    """Each strain's genes joined in the given order."""
    place = F.array_position(F.array(*[F.lit(g) for g in order]), F.col(gene))
    return seqs.where(F.col(gene).isin(*order)).groupBy(strain).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.col(seq).alias("s")))), lambda x: x["s"]), "").alias("seq"))


def prefix_by_region(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn(key, F.concat_ws("_", F.lit(r), F.col(key))) for r, df in tables.items()])


def keep_sera(titers: DataFrame, serum: str, sera: Sequence[str]) -> DataFrame:
    return titers.where(F.col(serum).isin(*sera))


def founder_sequences(labels: DataFrame, seqs: DataFrame, node: str = "node", label: str = "clade") -> DataFrame:
    return labels.join(seqs, node).orderBy(label)


def prediction_records(df: DataFrame, key: str, sample: str, value: str) -> DataFrame:
    """One JSON record a key with its sample values in sample order."""
    rows = df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(sample, value))), lambda x: x[value]).alias("values"))
    return rows.select(key, F.to_json(F.struct(F.col(key).alias("target"), "values")).alias("record"))


# -- set operations -----------------------------------------------------------------------------------------------

def intersect_items(tables: Sequence[DataFrame], item: str = "item") -> DataFrame:
    """Items that every table has."""
    tagged = reduce(lambda a, b: a.union(b), [df.select(item).distinct() for df in tables])
    return tagged.groupBy(item).agg(F.count("*").alias("c")).where(F.col("c") == len(tables)).select(item)


def union_items(tables: Sequence[DataFrame], item: str = "item") -> DataFrame:
    return reduce(lambda a, b: a.union(b), [df.select(item) for df in tables]).distinct()


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): ``a``, ``b`` or ``both``."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    return x.join(y, key, "full_outer").select(key, F.when(F.col("_b").isNull(), "a").when(F.col("_a").isNull(), "b").otherwise("both").alias("side"))


def select_references(data: DataFrame, include: DataFrame, exclude: DataFrame, item: str = "item") -> DataFrame:
    return data.select(item).union(include.select(item)).distinct().join(exclude, item, "left_anti")


def contiguous_years(tables: Sequence[DataFrame], year: str) -> DataFrame:
    """Every year from the first to the last in any table, and whether one has it."""
    seen = reduce(lambda a, b: a.union(b), [df.select(year) for df in tables]).where(F.col(year).isNotNull()).distinct()
    ends = seen.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).where("lo is not null")
    grid = ends.select(F.explode(F.sequence(F.col("lo").cast("long"), F.col("hi").cast("long"))).alias(year))
    return grid.join(seen.withColumn("observed", F.lit(True)), year, "left").withColumn("observed", F.coalesce("observed", F.lit(False)))


def weighted(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))
