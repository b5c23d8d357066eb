"""Quality rules: counts of a text's faults, and a log-likelihood ratio of hashed n-grams.

Built of DataFrame functions only.  Words and word pairs of every text are hashed into a fixed number of buckets.  Two
multinomials over the buckets are estimated, one from trusted texts and one from all texts; a text's score is the mean
over its n-grams of the log ratio of the two.  The ratios are one array of fixed length (``buckets``), used as a scalar
subquery, so nothing that grows with the corpus reaches the driver or is sent to every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .minhash import BROADCAST_IDS
from .shared import SPACE, stored, words

#: Fixed by the output contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def hashed_pairs(hashes: Column, apart: int) -> Column:
    """One hash for each two of an array that stand ``apart`` places from each other: of windows, windows twice as wide."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + apart), n), lambda a, b: F.xxhash64(a, b))


def repeated_words(windows: Column) -> tuple[Column, Column, Column]:
    """Steps to the words inside windows that occur twice or more, from the windows' hashes in ``_win``.

    Sorted (hash, position) pairs show which windows repeat, and sorted positions how many words those cover.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size("_sorted") - 1
    same = lambda i, j: F.get(F.col("_sorted"), i)["h"] == F.get(F.col("_sorted"), j)["h"]
    repeated = F.filter(F.col("_sorted"), lambda x, i: ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)))
    at = F.array_sort(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate(
        F.col("_at"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(WINDOW))).cast("long").alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return pairs, at, covered


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds hashes of words (_one) and word pairs (_two), and word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words, base_failed.

    Windows of 8 words are compared by 64-bit hashes, doubled from pairs over windows of 4.  Texts without a repeated
    window of 4, most, stop there.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    twice = lambda x: F.size(F.array_distinct(x)) < F.size(x)
    pairs, at, covered = repeated_words(F.col("_win"))
    return (
        docs.withColumns({
            "_words": words(F.col(text)),
            "n_symbols": F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "_lines": lines,
        })
        .withColumns({
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_one": F.transform("_words", lambda w: F.xxhash64(w)),
        })
        .withColumn("_two", hashed_pairs(F.col("_one"), 1))
        .withColumn("_four", hashed_pairs(F.col("_two"), 2))
        .withColumn("_win", F.when(twice(F.col("_four")), hashed_pairs(F.col("_four"), 4)))
        .withColumn("_sorted", F.when(twice(F.col("_win")), pairs))
        .withColumn("_at", F.when(F.col("_sorted").isNotNull(), at))
        .withColumn("n_repeat_words", F.when(F.col("_at").isNotNull(), covered).otherwise(F.lit(0)).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .drop("_words", "_lines", "_four", "_win", "_sorted", "_at")
    )


def bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def log_ratios(texts: DataFrame, *, text: str, trusted: str, buckets: int, smoothing: float) -> DataFrame:
    """One row with an array of ``buckets`` log ratios, trusted over raw.

    The raw counts are scaled to the size of the trusted ones and both get ``smoothing`` added, so that a bucket which
    is rare in all texts has a ratio near 0 whether or not the trusted texts happen to hold it.
    """
    # A row for each word with the one after it, so that hashing and counting are compiled code.
    listed = texts.select(words(F.col(text)).alias("w"), F.col(trusted).cast("boolean").alias("good"))
    grams = listed.select("good", F.explode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.size("w")).alias("b"))).alias("x"))
    one, two = F.xxhash64("x.a"), F.when(F.col("x.b").isNotNull(), F.xxhash64(F.xxhash64("x.a"), F.xxhash64("x.b")))
    counts = stored(
        grams.select("good", F.explode(F.array(bucket(one, buckets), bucket(two, buckets))).alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("good").alias("target")),
        "ngram-counts",
    )
    scale = counts.agg(F.coalesce(F.sum("target") / F.sum("raw"), F.lit(0.0))).scalar()
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").withColumn("scale", scale)
    ratio = F.log(F.coalesce("target", F.lit(0)) + smoothing) - F.log(F.coalesce("raw", F.lit(0)) * F.col("scale") + smoothing)
    listed = every.withColumn("r", ratio).groupBy().agg(F.collect_list(F.struct("bucket", "r")).alias("of"))
    return listed.select(F.transform(F.array_sort("of"), lambda x: x["r"]).alias("ratios"))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = 1 << 16,
    smoothing: float = 2.0,
    threshold: float = -0.1,
) -> DataFrame:
    """Every row of docs with its base counts, score (quality_llr) and verdict (kept).

    ``trusted`` has the keys of trusted texts in a column named as ``key``; repeated and null keys there count once and
    never, and all others are learnt from.  Up to ``BROADCAST_IDS`` keys are broadcast to mark their texts; more are joined by
    a shuffle.  The raw counts cover all documents.  A document is kept if it passes the base rules (20 words or more, at most 30 %
    of them in repeated windows) and its mean log ratio reaches ``threshold``; a score is a function of the text and the
    counts alone, so ties and repeated rows get equal verdicts.  A null or empty text has no n-grams, score 0, and fails
    the base rules.  Without trusted texts all ratios are equal and the score doesn't tell texts apart; its threshold
    then holds as it stands.  Columns of docs named as the added ones are replaced.
    """
    added = ["word_chars", "n_symbols", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "quality_llr", "kept"]
    docs = docs.drop(*added)
    good = trusted.select(F.col(key).alias("_good")).where(F.col("_good").isNotNull()).distinct()
    good = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    marked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(good, F.col("_key") == F.col("_good"), "left")
    ratios = stored(log_ratios(marked.withColumn("_trusted", F.col("_good").isNotNull()), text="_text", trusted="_trusted", buckets=buckets, smoothing=smoothing), "ngram-ratios")
    # One use of the ratios: the optimizer then reads them where they are used instead of copying them into every row.
    total = F.aggregate(F.concat("_one", "_two"), F.lit(0.0), lambda a, h: a + F.get(F.col("_of"), bucket(h, buckets)))
    n = F.col("n_words") + F.size("_two")
    return (
        with_base_counts(docs, text)
        .withColumn("_of", ratios.scalar())
        .withColumn("quality_llr", F.when(n > 0, total / n).otherwise(0.0))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_llr") >= threshold))
        .drop("_one", "_two", "_of")
    )
