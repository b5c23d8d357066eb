"""Near-duplicate documents: an inverted join over the coordinates of MinHash signatures, then exact Jaccard.

1. One vectorised pass makes each text's set of word shingles, a 64-bit id of the set and a signature of ``k`` minima.
   Equal sets fall together first, so copies cost nothing further.
2. A set is posted under its coordinate-value pairs, rarest first.  Values met once can't match; a set with fewer than
   ``t`` others is done.  Two sets with ``t`` matches share one of the ``matching - t + 1`` rarest (the prefix), so only
   those are posted, and a passage that many texts share is rarely among them.
3. Each posting list names its most central set; every set is verified against the one it shares most lists with.  This
   links most of any large group through one member instead of through all pairs.
4. What remains are sets in lists that still hold several components.  Two variants of one text share most coordinates
   without being similar enough, so these sets go to blocks by the member they tried; pairs of blocks that meet under a
   rare shingle (an exact prefix filter) are compared in one task each.  Pairs inside a component are skipped; the others
   link at ``t`` matching coordinates or more and the similarity of the full sets.

The chance that a pair at the threshold has fewer than ``t`` of ``k`` matches is the only loss: P(Binomial(64, 0.75) <
30) is about 3e-7.  Sets are compared by 64-bit shingle hashes and named by 64-bit ids; two different ones meet with a
probability under n**2 / 2**65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import forget, stored
from .textvec import U, chunks, mix, shingle_hashes

#: Shingles that a block of sets holds on average at most.
BLOCK_SHINGLES = 1 << 14
#: Candidate ids up to this number (16 MB) are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit id of a sorted set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The upper halves of the minima of k hash functions; long sets are taken in parts."""
    low = np.full(len(factors), ~U(0), U)
    for at in range(0, len(shingles), 8192):
        part = shingles[at : at + 8192, None] * factors
        part ^= part >> U(29)
        np.minimum(low, (part * U(0xBF58476D1CE4E5B9)).min(0), out=low)
    return (low >> U(32)).astype(np.uint32).view(np.int32)


def _factors(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=U)) | U(1)


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    for c in chunks(column):
        for r in range(c.n):
            yield np.unique(shingle_hashes(c.hash[c.bound[r] : c.bound[r + 1]], size))


def signatures(docs: DataFrame, key: str, text: str, size: int, k: int) -> DataFrame:
    """(key, rk, nid, n, sig) of every row; a text without words has n 0, no id and no signature."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(k)
        for batch in batches:
            ids, sizes, sigs = [], [], []
            for s in text_sets(batch.column(2), size):
                ids.append(set_id(s) if len(s) else None)
                sizes.append(len(s))
                sigs.append(signature(s, factors) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.list_(pa.int32()))], names=["key", "rk", "nid", "n", "sig"])

    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    return docs.select(key, F.xxhash64(key, text), text).mapInArrow(make, f"key {kind}, rk long, nid long, n long, sig array<int>")


def postings(reps: DataFrame, k: int, t: int) -> DataFrame:
    """(nid, cent, list) of the prefix postings; cent sums how many sets share each of the set's values."""
    posted = reps.select("nid", F.posexplode("sig").alias("c", "v")).select("nid", (F.col("c") * F.lit(1 << 32) + F.col("v")).alias("list"))
    met = posted.groupBy("list").agg(F.count("*").alias("df")).where("df > 1")
    of = posted.join(met, "list").groupBy("nid").agg(F.sort_array(F.collect_list(F.struct("df", "list"))).alias("of"))
    kept = of.where(F.size("of") >= t).select("nid", F.aggregate("of", F.lit(0).cast("long"), lambda s, x: s + x["df"]).alias("cent"), F.slice("of", F.lit(1), F.size("of") - (t - 1)).alias("of"))
    return kept.select("nid", "cent", F.explode("of.list").alias("list"))


def candidate_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int, k: int) -> DataFrame:
    """(nid, set, sig), one row for each wanted (nid, rk)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(k)
        for batch in batches:
            ids, sets, sigs = [], [], []
            for nid, s in zip(batch.column(0), text_sets(batch.column(1), size), strict=True):
                ids.append(nid.as_py())
                sets.append(s.view(np.int64))
                sigs.append(signature(s, factors))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int32()))], names=["nid", "set", "sig"])

    few = wanted.count() <= BROADCAST_IDS
    rows = docs.select(F.xxhash64(key, text).alias("rk"), F.col(text).alias("_text")).join(F.broadcast(wanted) if few else wanted, "rk")
    return rows.select("nid", "_text").mapInArrow(make, "nid long, set array<long>, sig array<int>").dropDuplicates(["nid"])


def verified(edges: DataFrame, sets: DataFrame, percent: int, t: int) -> DataFrame:
    """The edges (a, b) whose sets reach the similarity and whose signatures match in t coordinates."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, p, q in zip(*(_arrays(batch.column(i)) for i in range(2, 6)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and (p == q).sum() >= t)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("nid").alias(k), F.col("set").alias(f"s{k}"), F.col("sig").alias(f"t{k}")) for k in "ab")
    return edges.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "ta", "tb").mapInArrow(check, "a long, b long")


def placed_in_blocks(sets: DataFrame) -> DataFrame:
    """Sets (nid, component, hub, set, sig) with a block: the hub they tried, in as many parts as keep a block's shingles few."""
    parts = sets.groupBy("hub").agg(F.ceil(F.sum(F.size("set")) / BLOCK_SHINGLES).alias("parts"))
    part = F.pmod(F.xxhash64("nid"), F.col("parts"))
    return sets.join(parts, "hub").select("nid", "component", F.xxhash64("hub", part).alias("block"), "set", "sig")


def block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks (a, b), a block with itself too, that may hold a pair from different components at the similarity.

    Shingles are ordered by how many components hold them; those of one component come first, since no such pair shares
    them.  Two sets of n and m shingles that reach the similarity share w = percent (n + m) / (100 + percent) or more, so
    one of the first n - w + 1 of one is among the first m - w + 1 of the other.  Blocks are posted under those of their
    sets with the lowest rank.  Variants of one text lie in the same few blocks, so a large group of them makes as many
    pairs as it has pairs of blocks.
    """
    held = placed.select("nid", "component", "block", F.size("set").cast("long").alias("n"), F.explode("set").alias("s"))
    met = held.select("s", "component").distinct().groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    of = held.join(met, "s").groupBy("nid", "component", "block", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("of"))
    own = F.col("n") - F.size("of")
    # The smallest partner has percent of n, and so the longest prefix is n less that, plus 1; own shingles come first.
    longest = F.greatest(F.floor(F.col("n") * (100 - percent) / 100) + 1 - own, F.lit(0)).cast("int")
    posted = of.select("component", "block", "n", own.alias("own"), F.posexplode(F.slice(F.col("of.s"), F.lit(1), longest)).alias("i", "s"))
    rank = F.col("own") + F.col("i") + 1
    lists = posted.groupBy("block", "s").agg(F.min(rank).alias("rank"), F.min("n").alias("least"), F.max("n").alias("most"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    lists = stored(lists, "block-postings")
    mixed = lists.groupBy("s").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("s")
    x, y = lists.join(mixed, "s").alias("x"), lists.alias("y")
    common = F.floor((percent * (F.col("x.least") + F.col("y.least")) + 99 + percent) / (100 + percent))
    fits = (F.col("x.rank") <= F.col("x.most") - common + 1) & (F.col("y.rank") <= F.col("y.most") - common + 1)
    apart = (F.least("x.lo", "y.lo") != F.greatest("x.hi", "y.hi"))
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.block") <= F.col("y.block")) & apart & fits)
    return pairs.select(F.col("x.block").alias("a"), F.col("y.block").alias("b")).distinct()


def block_links(pairs: DataFrame, placed: DataFrame, percent: int, t: int) -> DataFrame:
    """Verified edges (a, b) between components inside pairs of blocks; of edges that connect the same, one."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in range(batch.num_rows):
                sides = []
                for c in (0, 1):
                    struct = batch.column(c)[row].values
                    sides.append((struct.field("nid").to_numpy(), struct.field("component").to_numpy(), _arrays(struct.field("set")), np.stack(_arrays(struct.field("sig")))))
                found += links_between(*sides, percent, t)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    met = pairs.select(F.col("a").alias("block")).union(pairs.select(F.col("b").alias("block"))).distinct()
    few = met.count() <= BROADCAST_IDS
    content = placed.join(F.broadcast(met) if few else met, "block").groupBy("block").agg(F.collect_list(F.struct("nid", "component", "set", "sig")).alias("of"))
    content = stored(content, "blocks")
    left, right = (content.select(F.col("block").alias(k), F.col("of").alias(f"of_{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("of_a", "of_b").mapInArrow(check, "a long, b long")


def links_between(x: tuple, y: tuple, percent: int, t: int) -> list[tuple[int, int]]:
    """Links of two sides (ids, components, sets, signatures) between components, less those inside what others connect."""
    (ids, of, sets, sigs), (other_ids, other_of, other_sets, other_sigs) = x, y
    values, where = np.unique(np.concatenate([*sets, *other_sets]), return_inverse=True)
    held = np.zeros((len(sets) + len(other_sets), len(values)), np.float32)
    held[np.repeat(np.arange(len(held)), [len(s) for s in (*sets, *other_sets)]), where] = 1
    both = held[: len(sets)] @ held[len(sets) :].T
    size, other_size = held[: len(sets)].sum(1), held[len(sets) :].sum(1)
    near = (100 * both >= percent * (size[:, None] + other_size - both)) & (of[:, None] != other_of)
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    links = []
    for i, j in np.argwhere(near).tolist():
        a, b = root(int(of[i])), root(int(other_of[j]))
        if a != b and (sigs[i] == other_sigs[j]).sum() >= t:
            parent[a] = b
            links.append((int(ids[i]), int(other_ids[j])))
    return links


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def near_edges(docs: DataFrame, reps: DataFrame, *, key: str, text: str, size: int, percent: int, k: int, t: int) -> DataFrame:
    """Verified edges (a, b) between set ids that connect whatever links connect."""
    lists = stored(postings(reps, k, t), "postings")
    wanted = lists.select("nid").distinct().join(reps.select("nid", "rk"), "nid")
    sets = stored(candidate_sets(docs, wanted, key, text, size, k), "sets")
    hubs = lists.groupBy("list").agg(F.max(F.struct("cent", "nid")).alias("hub"), F.count("*").alias("m")).where("m > 1").select("list", F.col("hub.nid").alias("b"))
    shared = lists.join(hubs, "list").where("nid <> b").groupBy(F.col("nid").alias("a"), "b").agg(F.count("*").alias("m"))
    best = stored(shared.groupBy("a").agg(F.max(F.struct("m", "b")).alias("x")).select("a", F.col("x.b").alias("b")), "hubs")
    first = stored(verified(best, sets, percent, t), "links")
    group = components(first).withColumnsRenamed({"id": "nid"})
    labelled = lists.select("nid", "list").join(group, "nid", "left").withColumn("component", F.coalesce("component", "nid"))
    labelled = stored(labelled, "labelled")
    mixed = labelled.groupBy("list").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("list")
    apart = labelled.join(mixed, "list").select("nid", "component").distinct()
    apart = apart.join(best.withColumnsRenamed({"a": "nid", "b": "hub"}), "nid", "left").withColumn("hub", F.coalesce("hub", "nid"))
    apart = stored(apart, "apart")
    few = apart.count() <= BROADCAST_IDS
    placed = stored(placed_in_blocks(sets.join(F.broadcast(apart) if few else apart, "nid")), "placed")
    forget(lists, labelled, sets, apart)
    second = stored(block_links(stored(block_pairs(placed, percent), "block-pairs"), placed, percent, t), "links")
    forget(placed)
    return first.union(second)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75, k: int = 64, t: int = 30) -> DataFrame:
    """(key, n_shingles, component_id, kept), one row for each row of docs.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set holds the distinct shingles of
    ``size`` words, or the whole sequence where it is shorter.  Sets link at ``percent`` per cent Jaccard similarity.
    component_id is the smallest key reachable.  A text without words (or null) links with nothing and is kept.  Rows of
    equal texts share a component, repeated rows too; a row is kept if its key is the component's.  Rows with null
    keys link like others but never represent a component that has another key; a component of null keys alone is null and
    its rows are kept.
    """
    made = stored(signatures(docs, key, text, size, k), "signatures")
    reps = stored(made.where("n > 0").groupBy("nid").agg(F.min("key").alias("rid"), F.min("rk").alias("rk"), F.first("sig").alias("sig")), "reps")
    edges = near_edges(docs, reps, key=key, text=text, size=size, percent=percent, k=k, t=t)
    group = components(edges)
    rid = reps.select("nid", "rid")
    named = rid.join(group, rid.nid == group.id, "left").select("nid", "rid", F.coalesce("component", "nid").alias("component"))
    named = named.join(named.groupBy("component").agg(F.min("rid").alias("component_id")), "component").select("nid", "component_id")
    named = stored(named, "named")
    out = made.select("key", "nid", "n").join(named, "nid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
