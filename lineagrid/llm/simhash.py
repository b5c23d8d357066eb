"""Near-duplicate documents by SimHash: an inverted index over the bytes of fingerprints, with count filtering.

1. One pass makes each text's fingerprint of 64 bits; equal fingerprints fall together, so copies cost nothing further.
2. Fingerprints that differ in ``bits`` bits or fewer differ in as many bytes at most, so 8 - ``bits`` of their eight
   positional bytes match.  A pair that reaches this count shares all bytes of some set of so many positions; the index
   has a list for each set of positions and the bytes there, and only pairs of one list ever meet.  A list has no more
   than 256**``bits`` fingerprints, whatever the corpus is.
3. In a list the tally of a pair goes on over the positions outside the set; what is verified are differing bits.  Large
   lists aren't compared pair by pair: the members that lie within ``bits`` bits of one are looked up.  A list yields the
   links of a spanning forest, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import forget, stored

#: Fixed by the output contract.
SEED = 42
#: Lists up to this size are compared as a matrix.
MATRIX = 256
#: Shingles whose hashes are tallied at once (a very long text is taken in parts).
TALLIED = 1 << 16


def fingerprint(text: bytes, size: int) -> int:
    """The bits set in over half of the hashes of a text's ``size``-word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    line = b" ".join(words)
    begin = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=begin[1:])
    n = len(words) - size + 1
    spans = zip(begin[:n].tolist(), (begin[size:] - 1).tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:z], SEED) for a, z in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, TALLIED):
        ones += np.unpackbits(hashes[at : at + TALLIED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, fp) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", size) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["key", "fp"])

    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), text).mapInArrow(make, f"key {kind}, fp long")


def posting_lists(distinct: DataFrame, bits: int) -> DataFrame:
    """(fps) of lists with two fingerprints or more; a list is named by its positions and the bytes there."""
    masks = [sum(0xFF << (8 * i) for i in kept) for kept in combinations(range(8), 8 - bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("positions", "bytes"))
    return posted.groupBy("positions", "bytes").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")


def list_links(fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within ``bits`` bits of each other."""
    n = len(fps)
    if n <= MATRIX:
        near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps) <= bits, 1))
    else:
        fps = np.sort(fps)
        # The bits in which members differ at all; those within reach of a member are looked up.
        differing = int(np.bitwise_or.reduce(fps ^ fps[0]))
        places = [i for i in range(64) if differing >> i & 1]
        found = []
        for k in range(1, bits + 1):
            for chosen in combinations(places, k):
                other = fps ^ np.uint64(sum(1 << i for i in chosen))
                at = np.searchsorted(fps, other)
                at[at == n] = 0
                hit = np.flatnonzero((fps[at] == other) & (fps < other))
                found.append(np.stack([hit, at[hit]], 1))
        near = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, j in near.tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            yield int(fps[i]), int(fps[j])


def links(lists: DataFrame, bits: int) -> DataFrame:
    """(a, b) of fingerprints whose tally of shared bytes and differing bits make a link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            at, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            found = np.array([x for i, j in zip(at[:-1], at[1:], strict=True) for x in list_links(values[i:j], bits)], np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return lists.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3, bits: int = 2) -> DataFrame:
    """(key, fingerprint, component_id), one row for each row of docs.

    A text (A-Z lower-cased, words split at ASCII white space) has the shingles of ``size`` words, repeats included, or its
    whole sequence where it is shorter; fingerprint is 16 hexadecimal digits, zero without words (or null).  Fingerprints
    link at ``bits`` differing bits or fewer (under 8); component_id is the smallest key reachable.  Rows with null keys
    link like others but never represent a component that has another key.
    """
    made = stored(fingerprints(docs, key, text, size), "fingerprints")
    first = stored(made.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    found = stored(links(posting_lists(first.select("fp"), bits), bits), "links")
    group = components(found).withColumnsRenamed({"id": "fp"})
    named = first.join(group, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(smallest, "component").select("fp", "component_id"), "named")
    forget(first, found)
    return made.join(named, "fp").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
