"""Mixing sources to target weights with hash-threshold histograms.

A source's target is a number of words.  Every document is taken ``floor(target / size of source)`` times, and the rest
of the target is met by the documents whose hash lies under a threshold.  The threshold is found without sorting
documents: words are summed by source and hash bucket, the running sum names the boundary bucket, and only that bucket
is divided again, until a bucket holds one hash value.  Each round is one pass with map-side sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, stored

#: Bits of a document's hash, and bits that one round of the histogram resolves.
HASH_BITS, ROUND_BITS = 60, 12
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def document_hash(key: Column) -> Column:
    """60 bits of the MD5 of the key as text (null: as the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Targets of sources: proportional to weight, none above ``most`` times its size.

    ``sizes`` has one row a source (source, source_size), so that a window over all of them holds as many rows as there
    are sources.  The level that solves sum(min(most * size, level * weight)) = share * total is found in closed form:
    sources are filled up in the order of size / weight.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_code) - 1) % len(weights) + 1).cast("int")).cast("long"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    filling = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = F.when(F.col("left_weight") > 0, (share * F.col("total") - most * F.col("full_size")) / F.col("left_weight"))
    return (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("full_size", F.coalesce(F.sum("source_size").over(filling), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(filling), F.lit(0)))
        .withColumn("level", level)
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("open", F.col("level") * F.col("weight") <= most * F.col("source_size"))
        .withColumn("final", F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)["level"])
        .withColumn("target", F.least(F.col("final") * F.col("weight"), (most * F.col("source_size")).cast("double")))
        .select("source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: whole copies of every document, and the hash under which one more is taken.

    ``sized`` has source, size, hash.  The threshold is the largest at which the words under it don't exceed the rest of
    the target, or the next if that comes nearer; documents that share a hash stand or fall together.
    """
    state = targets.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    state = state.withColumn("need", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("low", F.lit(0).cast("long")).withColumn("at", F.lit(None).cast("long"))
    state = stored(state, "mix-state")
    for shift in range(HASH_BITS - ROUND_BITS, -1, -ROUND_BITS):
        # Only documents of the boundary bucket of the round before: its number is the hash without the bits to come.
        edge = state.select(F.col("source").alias("edge_source"), F.col("at").alias("edge"))
        inside = sized.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "inner")
        if shift + ROUND_BITS < HASH_BITS:
            inside = inside.where(F.shiftright("hash", shift + ROUND_BITS) == F.col("edge"))
        sums = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket")
        steps = sums.withColumn("upto", F.sum("words").over(running)).withColumnRenamed("source", "step_source")
        within = F.col("low") + F.col("upto") <= F.col("need")
        found = (
            state.join(steps, F.col("source").eqNullSafe(F.col("step_source")), "left")
            .groupBy("source", "source_size", "target", "copies", "need", "low", F.col("at").alias("was"))
            .agg(
                F.min(F.when(~within, F.struct("bucket", "words"))).alias("over"),
                F.coalesce(F.max(F.when(within, F.col("upto"))), F.lit(0)).alias("more"),
                F.max("bucket").alias("last"),
            )
        )
        low = F.col("low") + F.col("more")
        # The boundary's own words count only in the last round, where the boundary is one hash value.
        nearer = F.lit(shift == 0) & (low + F.col("over.words") - F.col("need") < F.col("need") - low)
        at = F.when(F.col("over").isNotNull(), F.col("over.bucket") + nearer.cast("long"))
        # Where every bucket fits, the threshold lies behind the last; where there is none, at the boundary's start.
        at = F.coalesce(at, F.col("last") + 1, F.shiftleft("was", ROUND_BITS), F.lit(0)).cast("long")
        state = stored(found.select("source", "source_size", "target", "copies", "need", low.alias("low"), at.alias("at")), "mix-state")
    return state.select("source", "source_size", "target", "copies", F.col("at").alias("under"))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """Every row of docs with how often the mix takes it.

    Adds mix_size (words), mix_source_size, mix_target (of the row's source) and mix_copies (0 to ``most``); columns of
    these names are replaced.  A null source is a source of its own, last in order.  Sources of no words have target 0.
    Rows with equal keys share a hash and so are taken alike; a null key hashes as the empty text.  An empty table gives
    an empty result.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies")
    sized = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), document_hash(F.col(key)).alias("hash"))
    sized = stored(sized, "mix-sized")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    cut = thresholds(sized, targets).withColumnRenamed("source", "mix_source")
    return (
        docs.join(cut, F.col(source).eqNullSafe(F.col("mix_source")), "left")
        .withColumn("mix_size", word_count(F.col(text)))
        .withColumn("mix_copies", F.col("copies") + (document_hash(F.col(key)) < F.col("under")).cast("long"))
        .withColumn("mix_copies", F.least(F.col("mix_copies"), F.lit(most)).cast("long"))
        .withColumnsRenamed({"source_size": "mix_source_size", "target": "mix_target"})
        .drop("mix_source", "copies", "under")
    )
