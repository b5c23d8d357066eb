"""Fitness predictors by name, computed together: what several of them need is made once.

A predictor says where its value comes from and which others it needs:

* ``root``: a term of each change between a node's sequence and its tree's root, summed;
* ``path``: a term of each change of a branch, and one of each node, summed from the root down;
* ``node``: an expression over the node's own columns;
* ``derived``: an expression over predictors that it needs.

However many are asked for, sequences are compared once with the root and once with the parent, and the tree is climbed
once, with one sum for each ``path`` predictor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.functions.scalars import sequence_diff
from lineagrid.operators import trees
from lineagrid.operators.sequences import with_bases
from lineagrid.sources.files import checkpointed


@dataclass
class Inputs:
    """A tree (node, parent), sequences (node, seq), columns of nodes, and the settings of predictors."""

    edges: DataFrame
    seqs: DataFrame
    nodes: DataFrame
    #: A character a site; sites of ``1`` are epitope sites.
    mask: str = ""
    #: (site, aa, preference); what isn't there counts as ``missing``.
    preferences: DataFrame | None = None
    missing: float = 1e-10
    settings: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Predictor:
    source: str
    #: Of ``root`` and ``path``: the term of a change, which has site, ref, alt, epitope, old and new (preferences).
    change: Callable[[Inputs], Column] | None = None
    #: Of ``path``: the term of a node; of ``node`` and ``derived``: the value.
    value: Callable[[Inputs], Column] | None = None
    needs: tuple[str, ...] = ()
    preferences: bool = False


REGISTRY: dict[str, Predictor] = {
    "ep": Predictor("root", lambda i: F.col("epitope").cast("int")),
    "ne": Predictor("root", lambda i: (~F.col("epitope")).cast("int")),
    "mutations": Predictor("path", lambda i: F.lit(1)),
    "ep_path": Predictor("path", lambda i: F.col("epitope").cast("int")),
    "dms": Predictor("path", lambda i: F.log2(F.col("new") / F.col("old")), preferences=True),
    "cum_lbi": Predictor("path", value=lambda i: F.coalesce("lbi", F.lit(0.0))),
    "log_freq": Predictor("node", value=lambda i: F.ln(F.greatest(F.coalesce("frequency", F.lit(0.0)), F.lit(1e-6)))),
    "null": Predictor("node", value=lambda i: F.lit(0.0)),
    "random": Predictor("node", value=lambda i: F.pmod(F.xxhash64(F.lit(i.settings.get("seed", 0)), "node"), F.lit(1 << 30)) / float(1 << 30)),
    "ep_excess": Predictor("derived", value=lambda i: F.col("ep") - F.col("ne"), needs=("ep", "ne")),
    "ep_share": Predictor("derived", value=lambda i: F.coalesce(F.try_divide("ep_path", "mutations"), F.lit(0.0)), needs=("ep_path", "mutations")),
}


def in_order(names: Sequence[str], registry: Mapping[str, Predictor] = REGISTRY) -> list[str]:
    """The names and all they need, each after what it needs."""
    done: list[str] = []

    def visit(name: str, above: tuple[str, ...]) -> None:
        if name in above:
            raise ValueError(f"predictors need each other: {' > '.join((*above, name))}")
        if name not in registry:
            raise ValueError(f"no predictor {name!r}; there are {', '.join(sorted(registry))}")
        if name not in done:
            for other in registry[name].needs:
                visit(other, (*above, name))
            done.append(name)

    for name in names:
        visit(name, ())
    return done


def _changes(inputs: Inputs, base: str, preferences: bool) -> DataFrame:
    """(node, site, ref, alt, epitope[, old, new]) of sequences against those of their bases."""
    rows = with_bases(inputs.edges, inputs.seqs, base).select("node", F.explode(sequence_diff(F.col("base_seq"), F.col("seq"))).alias("m")).select("node", "m.*")
    rows = rows.withColumn("epitope", F.substr(F.lit(inputs.mask), F.col("site"), F.lit(1)) == "1")
    if not preferences:
        return rows
    if inputs.preferences is None:
        raise ValueError("a predictor needs preferences")
    p = inputs.preferences.select("site", "aa", "preference")
    for c, aa in (("old", "ref"), ("new", "alt")):
        rows = rows.join(p.select("site", F.col("aa").alias(aa), F.col("preference").alias(c)), ["site", aa], "left").withColumn(c, F.coalesce(c, F.lit(inputs.missing)))
    return rows


def compute(names: Sequence[str], inputs: Inputs, registry: Mapping[str, Predictor] = REGISTRY) -> DataFrame:
    """(node, a column each name) for all nodes of the tree; sums over no changes, and over nodes without a sequence, are 0."""
    order = in_order(names, registry)
    of = lambda source: [n for n in order if registry[n].source == source]
    out = inputs.edges.select("node").join(inputs.nodes, "node", "left")
    summed = lambda ns: [F.sum(registry[n].change(inputs)).alias(n) for n in ns]
    if root := of("root"):
        rows = _changes(inputs, "root", any(registry[n].preferences for n in root))
        out = out.join(rows.groupBy("node").agg(*summed(root)), "node", "left").fillna(0, root)
    if path := of("path"):
        changing = [n for n in path if registry[n].change]
        branch = inputs.edges.select("node").join(inputs.nodes, "node", "left")
        branch = branch.select("node", *[registry[n].value(inputs).alias(f"_v_{n}") for n in path if registry[n].value])
        if changing:
            rows = _changes(inputs, "parent", any(registry[n].preferences for n in changing))
            branch = branch.join(rows.groupBy("node").agg(*summed(changing)), "node", "left")
        term = lambda n: F.coalesce(F.col(n) if registry[n].change else F.lit(0.0), F.lit(0.0)) + F.coalesce(F.col(f"_v_{n}") if registry[n].value else F.lit(0.0), F.lit(0.0))
        out = out.join(trees.path_sums(inputs.edges, checkpointed(branch), {n: term(n) for n in path}), "node", "left")
    for n in order:
        if registry[n].source in ("node", "derived"):
            out = out.withColumn(n, registry[n].value(inputs))
    return out.select("node", *names)
