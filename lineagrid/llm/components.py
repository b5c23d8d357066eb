"""Connected components of an edge table by contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, stored

#: Rows of two ids that one task writes.
ROWS_A_FILE = 100_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every vertex with an edge; component is the smallest vertex reachable.

    Each round gives a vertex the smallest of itself and its neighbours as parent, follows parents twice, and contracts
    the edges to parents; edges inside one parent vanish.  Rounds grow with the logarithm of the longest shortest path.
    Sums per vertex are made before the shuffle, and joins on a vertex of many edges are left to the skew handling of
    adaptive execution.  Self-loops and repeated edges are harmless; null ends are left out; no edges, no rows.
    """
    current = stored(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "edges")
    left, assigned = current.count(), None
    while left or assigned is None:
        # Tables of a round have no more rows than twice its edges; as many files as those rows are worth.
        files = 2 * left // ROWS_A_FILE + 1
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("p")).select("id", F.least("id", "p").alias("p"))
        parent = stored(parent.coalesce(files), "parents")
        up = parent.select(F.col("id").alias("up"), F.col("p").alias("pp"))
        twice = parent.join(up, F.col("p") == F.col("up")).select("id", F.col("pp").alias("p"))
        step = stored(twice.join(up, F.col("p") == F.col("up")).select("id", F.col("pp").alias("p")).coalesce(files), "parents")
        if assigned is None:
            assigned = step
        else:
            to = step.select(F.col("id").alias("p"), F.col("p").alias("next"))
            assigned = stored(assigned.join(to, "p", "left").select("id", F.coalesce("next", "p").alias("p")).coalesce(first), "assigned")
        first = files if assigned is step else first
        x = step.select(F.col("id").alias("a"), F.col("p").alias("pa"))
        y = step.select(F.col("id").alias("b"), F.col("p").alias("pb"))
        contracted = current.join(x, "a").join(y, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        following = stored(contracted.coalesce(files), "edges")
        forget(current)
        current, left = following, following.count()
    return assigned.select("id", F.col("p").alias("component"))
