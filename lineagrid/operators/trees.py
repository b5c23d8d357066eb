"""Trees as edge tables (node, parent, is_terminal, preorder), the root's parent null.

What runs along paths to the root (sums, nearest marks, common ancestors) climbs by pointer jumping: a table of one row a
node, in which every round takes over what the node at its pointer knows and that node's pointer, so that rounds grow with
the logarithm of the depth and no round has more rows than nodes.  What needs every ancestor of every node goes through the
closure (node, ancestor, hops), itself included at 0 hops, which has as many rows as all paths together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.sources.files import checkpointed


def closure(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, ancestor, hops) with every node its own ancestor at 0 hops.

    Round k knows all ancestors within 2**k hops and where the next 2**k begin; rounds end when no pointer is left.
    Each round's tables are written to the checkpoint folder, so a lost executor costs no more than a round.
    """
    known = edges.select(F.col(node).alias("node"), F.col(node).alias("ancestor"), F.lit(0).alias("hops"))
    jump = edges.where(F.col(parent).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("up"))
    step = 1
    while True:
        jump = checkpointed(jump)
        if jump.isEmpty():
            return known
        further = jump.join(known.select(F.col("node").alias("up"), "ancestor", "hops"), "up").select("node", "ancestor", (F.col("hops") + step).alias("hops"))
        known = checkpointed(known.union(further))
        jump = jump.join(jump.select(F.col("node").alias("up"), F.col("up").alias("next")), "up").select("node", F.col("next").alias("up"))
        step *= 2


def climb(state: DataFrame, keys: Sequence[str], combine: Mapping[str, Column], going: Column) -> DataFrame:
    """Pointer jumping over (node, keys, up, values) until no row is ``going`` that has a pointer.

    A round gives such a row the pointer of the row at ``up`` and its own values combined with that row's, which
    ``combine`` finds under their names after an underscore; those of a pointer to no row are null, and the row ends there.
    """
    going = going & F.col("up").isNotNull()
    while True:
        state = checkpointed(state)
        if state.where(going).isEmpty():
            return state
        higher = state.select(F.col("node").alias("up"), *keys, F.col("up").alias("_up"), *[F.col(v).alias(f"_{v}") for v in combine])
        moved = state.where(going).join(higher, ["up", *keys], "left").select("node", *keys, F.col("_up").alias("up"), *[c.alias(v) for v, c in combine.items()])
        state = moved.union(state.where(~going | F.col("up").isNull()).select(*moved.columns))


def _per_key(edges: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(node, up) once for each of the table's keys; these are gathered in one array (samples, groups, sites, maps)."""
    nodes = edges.select("node", F.col("parent").alias("up"))
    if not keys:
        return nodes
    every = table.agg(F.collect_set(F.struct(*keys))).scalar()
    return nodes.withColumn("_k", F.explode(every)).select("node", "up", "_k.*")


def path_sums(edges: DataFrame, branches: DataFrame, sums: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """(node, keys, sums) of expressions over the branches from the root to the node; nulls count as nothing.

    Nodes with no branch of a key on their path have no row for it.
    """
    names = {f"_s{i}": n for i, n in enumerate(sums)} | {"_rows": None}
    own = branches.groupBy("node", *keys).agg(*[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())], F.count("*").alias("_rows"))
    state = _per_key(edges, own, keys).join(own, ["node", *keys], "left").select("node", *keys, "up", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    total = climb(state, keys, {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in names}, F.lit(True))
    return total.where("_rows > 0").select("node", *keys, *[F.col(k).alias(n) for k, n in names.items() if n])


def nearest(edges: DataFrame, marks: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(node, keys, value) of the nearest marked node (node, keys, value) on the way from the node, itself included, to the root.

    Of several marks of one node and key the smallest value counts; nodes without a mark above have no row.
    """
    own = marks.groupBy("node", *keys).agg(F.min(value).alias("value"), F.lit(True).alias("hit"))
    state = _per_key(edges, own, keys).join(own, ["node", *keys], "left").select("node", *keys, "up", "value", F.coalesce("hit", F.lit(False)).alias("hit"))
    found = climb(state, keys, {"value": F.col("_value"), "hit": F.coalesce("_hit", F.lit(False))}, ~F.col("hit"))
    return found.where("hit").select("node", *keys, F.col("value").alias(value))


def lifts(edges: DataFrame) -> list[DataFrame]:
    """Tables (node, up) of ancestors 1, 2, 4, ... hops up; together nodes times the logarithm of the depth."""
    tables = [checkpointed(edges.where("parent is not null").select("node", F.col("parent").alias("up")))]
    while True:
        half = tables[-1]
        further = checkpointed(half.join(half.select(F.col("node").alias("up"), F.col("up").alias("_next")), "up").select("node", F.col("_next").alias("up")))
        if further.isEmpty():
            return tables
        tables.append(further)


def ancestor_at(edges: DataFrame, hops: int) -> DataFrame:
    """(node, ancestor) so many hops up; nodes nearer to the root than that have no row."""
    at = edges.select("node", F.col("node").alias("up"))
    step = edges.where("parent is not null").select(F.col("node").alias("up"), F.col("parent").alias("next"))
    while hops:
        step = checkpointed(step)
        if hops & 1:
            at = at.join(step, "up").select("node", F.col("next").alias("up"))
        hops >>= 1
        step = step.join(step.select(F.col("up").alias("next"), F.col("next").alias("_next")), "next").select("up", F.col("_next").alias("next"))
    return at.withColumnRenamed("up", "ancestor")


def common_ancestors(edges: DataFrame, pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b, common): the lowest node that both are at or below; pairs of different trees have no row.

    The deeper one climbs to the other's depth, then both to below their common ancestor, by halving powers of two.
    """
    depth = path_sums(edges, edges, {"depth": F.lit(1)})
    tables = lifts(edges)
    of = lambda n, d: depth.select(F.col("node").alias(n), F.col("depth").alias(d))
    both = pairs.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct().join(of("_a", "_da"), "_a").join(of("_b", "_db"), "_b")
    down, gap = F.col("_da") >= F.col("_db"), F.abs(F.col("_da") - F.col("_db"))
    state = checkpointed(both.select("_a", "_b", F.when(down, F.col("_a")).otherwise(F.col("_b")).alias("x"), F.when(down, F.col("_b")).otherwise(F.col("_a")).alias("y"), gap.alias("gap")))
    for k in reversed(range(len(tables))):
        up = tables[k].select(F.col("node").alias("x"), F.col("up").alias("_x"))
        climbs = F.col("gap") >= 2**k
        moved = state.where(climbs).join(up, "x").select("_a", "_b", F.col("_x").alias("x"), "y", (F.col("gap") - 2**k).alias("gap"))
        state = checkpointed(moved.union(state.where(~climbs)))
    for k in reversed(range(len(tables))):
        up = lambda n: tables[k].select(F.col("node").alias(n), F.col("up").alias(f"_{n}"))  # noqa: B023, E731
        apart = F.col("x") != F.col("y")
        higher = state.where(apart).join(up("x"), "x", "left").join(up("y"), "y", "left")
        over = F.col("_x") != F.col("_y")
        moved = higher.select("_a", "_b", F.when(over, F.col("_x")).otherwise(F.col("x")).alias("x"), F.when(over, F.col("_y")).otherwise(F.col("y")).alias("y"), "gap")
        state = checkpointed(moved.union(state.where(~apart)))
    up = lambda n: tables[0].select(F.col("node").alias(n), F.col("up").alias(f"_{n}"))
    last = state.join(up("x"), "x", "left").join(up("y"), "y", "left")
    common = F.when(F.col("x") == F.col("y"), F.col("x")).when(F.col("_x") == F.col("_y"), F.col("_x"))
    return last.select(F.col("_a").alias(a), F.col("_b").alias(b), common.alias("common")).where("common is not null")


def sum_descendants(paths: DataFrame, tips: DataFrame, value: str) -> DataFrame:
    """(ancestor, total, n) over the tips (node, value) at or below each node."""
    return paths.join(tips, "node").groupBy("ancestor").agg(F.sum(value).alias("total"), F.count("*").alias("n"))


def clade_average(paths: DataFrame, tips: DataFrame, value: Column, min_size: int = 20) -> DataFrame:
    """(node, average): of the tips below; a node with min_size tips or fewer takes its nearest larger ancestor's."""
    own = paths.join(tips, "node").groupBy("ancestor").agg(F.avg(value).alias("a"), F.count("*").alias("n")).where(F.col("n") > min_size)
    return paths.join(own, "ancestor").groupBy("node").agg(F.min_by("a", "hops").alias("average"))


def path_sum(edges: DataFrame, branches: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(node, keys, total) of branch values from the root to the node."""
    return path_sums(edges, branches, {"total": F.col(value)}, keys)


def interval(df: DataFrame, keys: Sequence[str], value: str, mass: float = 0.95) -> DataFrame:
    """Mean and narrowest interval that holds the mass of the sorted samples."""
    rows = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.sort_array(F.collect_list(value)).alias("s"))
    n = F.size("s")
    inside = F.greatest(F.ceil(n * mass).cast("int"), F.lit(1))
    spans = F.transform(F.sequence(F.lit(1), n - inside + 1), lambda i: F.struct((F.get("s", i + inside - 2) - F.get("s", i - 1)).alias("w"), i.alias("i")))
    best = F.array_min(spans)["i"]
    return rows.select(*keys, "mean", F.get("s", best - 1).alias("low"), F.get("s", best + inside - 2).alias("high"))


def posterior_path(edges: DataFrame, branches: DataFrame, value: str, group: str, sample: str, mass: float = 0.95) -> DataFrame:
    """(node, group, mean, low, high) of path sums over posterior samples."""
    return interval(path_sum(edges, branches, value, [group, sample]), ["node", group], "total", mass)


def windowed_path_sum(edges: DataFrame, scored: DataFrame, value: str, status: str) -> DataFrame:
    """(node, total, and how many branches of each status) of windowed branch scores down to the node."""
    kinds = ["scored", "missing", "outside", "after"]
    return path_sums(edges, scored, {"total": F.coalesce(F.col(value), F.lit(0.0))} | {f"n_{k}": F.coalesce((F.col(status) == k).cast("long"), F.lit(0)) for k in kinds})


def path_distance(edges: DataFrame, branches: DataFrame, value: str, pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b, distance) through the common ancestor: c(a) + c(b) - 2 c(ancestor) of path sums c."""
    sums = path_sum(edges, branches, value)
    of = lambda n, c: sums.select(F.col("node").alias(n), F.col("total").alias(c))
    out = common_ancestors(edges, pairs, a, b).join(of(a, "_ca"), a).join(of(b, "_cb"), b).join(of("common", "_cm"), "common")
    return out.select(a, b, (F.col("_ca") + F.col("_cb") - 2 * F.col("_cm")).alias("distance"))


def inherited_labels(paths: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(node, labels): sorted labels of the node and its ancestors."""
    return paths.join(labels.select(F.col("node").alias("ancestor"), label), "ancestor").groupBy("node").agg(F.sort_array(F.collect_set(label)).alias("labels"))


def subtree(edges: DataFrame, paths: DataFrame, has_label: Column) -> DataFrame:
    """The edges at or below the first node in preorder that has the label."""
    root = edges.where(has_label).agg(F.min_by("node", "preorder").alias("ancestor"))
    return edges.join(paths.join(root, "ancestor").select("node"), "node", "left_semi")


def founder_haplotype(nodes: DataFrame, seqs: DataFrame, clade: str = "clade") -> DataFrame:
    """(node, haplotype): the clade, with its differences from the clade's first node in preorder."""
    from lineagrid.functions.scalars import sequence_diff

    full = nodes.join(seqs, "node")
    founders = full.groupBy(clade).agg(F.min_by("seq", "preorder").alias("_f"))
    parts = F.transform(sequence_diff(F.col("_f"), F.col("seq")), lambda x: F.concat(x["ref"], x["site"].cast("string"), x["alt"]))
    return full.join(founders, clade).select("node", F.when(F.size(parts) > 0, F.concat(F.col(clade), F.lit(":"), F.array_join(parts, "-"))).otherwise(F.col(clade)).alias("haplotype"))


def collapse_rare(edges: DataFrame, labels: DataFrame, label: str, min_tips: int) -> DataFrame:
    """(node, label): labels of fewer than min_tips tips give way to the nearest ancestor's that has enough; the root's stays."""
    tips = edges.where("is_terminal").select("node")
    common = labels.join(tips, "node").groupBy(label).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_tips).select(label)
    root = edges.where("parent is null").select(F.col("node").alias("ancestor"), F.lit(True).alias("_root"))
    kept = labels.join(common.withColumn("_ok", F.lit(True)), label, "left").select(F.col("node").alias("ancestor"), label, "_ok")
    usable = kept.join(root, "ancestor", "left").where("_ok or _root").select(F.col("ancestor").alias("node"), label)
    return nearest(edges, usable, label)


def tips_only(nodes: DataFrame) -> DataFrame:
    return nodes.where("is_terminal")


def first_node_per_label(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.groupBy(label).agg(F.min_by("node", "preorder").alias("node"))


def assign_clades(edges: DataFrame, mutations: DataFrame, definitions: DataFrame) -> DataFrame:
    """(node, clade): the clade of which a node has all alleles (clade, site, alt), else ``unassigned``.

    ``mutations`` has (node, site, alt) of branches; a node's allele at a site is its nearest branch's.  Of several clades
    that a node satisfies, the one with most sites counts.  Sites that no definition names are left out before all else.
    """
    asked = mutations.join(definitions.select("site").distinct(), "site", "left_semi")
    alleles = nearest(edges, asked, "alt", ["site"])
    need = definitions.groupBy("clade").agg(F.count("*").alias("need"))
    met = alleles.join(definitions, ["site", "alt"]).groupBy("node", "clade").agg(F.count("*").alias("n")).join(need, "clade").where("n = need")
    return met.groupBy("node").agg(F.max_by("clade", F.struct("need", "clade")).alias("clade")).join(edges.select("node"), "node", "right").withColumn("clade", F.coalesce("clade", F.lit("unassigned")))


def past_ancestor(edges: DataFrame, dates: DataFrame, t: Column) -> DataFrame:
    """(node, past): the nearest proper ancestor dated before t."""
    old = nearest(edges, dates.where(F.col("date") < t).select("node", F.col("node").alias("past")), "past")
    return edges.select("node", "parent").join(old.withColumnRenamed("node", "parent"), "parent").select("node", "past")


def cumulative_scaled(edges: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(node, scaled): path sums over their largest."""
    sums = path_sum(edges, values, value)
    return sums.withColumn("_m", sums.agg(F.max("total")).scalar()).select("node", F.try_divide("total", "_m").alias("scaled"))


def prune_to_common(trees: Sequence[tuple[DataFrame, DataFrame]]) -> list[DataFrame]:
    """Edge tables, given with their closures, cut down to the tips all have and what leads to them."""
    tips = [e.where("is_terminal").select("node") for e, _ in trees]
    common = reduce(lambda a, b: a.intersect(b), tips)
    return [e.join(p.join(common, "node", "left_semi").select(F.col("ancestor").alias("node")).distinct(), "node", "left_semi") for e, p in trees]


def distance_to_past_ancestor(edges: DataFrame, dates: DataFrame, t: Column, seqs: DataFrame, mask: str) -> DataFrame:
    """(node, past, distance): the nearest proper ancestor dated before t, and the sites of the mask where it differs."""
    past = past_ancestor(edges, dates, t)
    both = past.join(seqs.select("node", F.col("seq").alias("_s")), "node").join(seqs.select(F.col("node").alias("past"), F.col("seq").alias("_p")), "past")
    sites = F.array(*[F.lit(i + 1) for i, c in enumerate(mask) if c == "1"])
    differing = F.filter(sites, lambda i: F.substr(F.col("_s"), i, F.lit(1)) != F.substr(F.col("_p"), i, F.lit(1)))
    return both.select("node", "past", F.size(differing).alias("distance"))


def clades_in_band(edges: DataFrame, paths: DataFrame, tips: DataFrame, frequency: str, lo: float, hi: float) -> DataFrame:
    """(node, frequency) of nodes whose tips' frequencies sum to [lo, hi] and to less than their parent's."""
    sums = sum_descendants(paths, tips.select("node", frequency), frequency).select(F.col("ancestor").alias("node"), F.col("total").alias("frequency"))
    above = sums.select(F.col("node").alias("parent"), F.col("frequency").alias("_above"))
    banded = sums.where(F.col("frequency").between(lo, hi)).join(edges.select("node", "parent"), "node")
    return banded.join(above, "parent").where("frequency < _above").select("node", "frequency")


def separate_clades(paths: DataFrame, clades: DataFrame, dates: DataFrame, since: Column) -> DataFrame:
    """Of clades (node, ...) dated ``since`` or later those below no other such clade, so that none overlap."""
    recent = clades.join(dates.where(F.col("date") >= since).select("node"), "node", "left_semi")
    inside = paths.where("hops > 0").join(recent.select(F.col("node").alias("ancestor")), "ancestor", "left_semi").select("node").distinct()
    return recent.join(inside, "node", "left_anti")


def diagnose_clock(tips: DataFrame, rate: float, sigma: float, cutoff: float) -> DataFrame:
    """(node, z, diagnosis) of tips (node, date, expected, parent_date, mutations) off the clock, z in units of all tips' deviation.

    A tip without a date is ``bad_date``.  One beyond the cutoff and late is ``date_too_late``; one early is
    ``date_too_early`` where its mutations can't account for the time from its parent, else ``excess_mutations``.
    """
    scored = tips.withColumn("_z", (F.col("date") - F.col("expected")) / sigma)
    spread = scored.agg(F.stddev_pop("_z")).scalar()
    z = F.try_divide("_z", "_sd")
    gap = F.abs(F.col("date") - F.col("parent_date")) > F.col("mutations") / rate
    early = F.when(gap, "date_too_early").otherwise("excess_mutations")
    out = scored.withColumn("_sd", spread).withColumn("z", z)
    out = out.withColumn("diagnosis", F.when(F.col("date").isNull(), "bad_date").when(F.abs("z") > cutoff, F.when(F.col("z") < 0, early).otherwise("date_too_late")))
    return out.where("diagnosis is not null").select("node", "z", "diagnosis")


def prune_tips(edges: DataFrame, paths: DataFrame, outliers: DataFrame) -> DataFrame:
    """Edges without the outlying tips and without what then leads to none."""
    left = edges.where("is_terminal").select("node").join(outliers.select("node"), "node", "left_anti")
    needed = paths.join(left, "node").select(F.col("ancestor").alias("node")).distinct()
    return edges.join(needed, "node", "left_semi")
