"""Quality classifier: quadratic discriminant analysis with shrunken class covariances.

A text becomes a dozen transformed statistics (JVM expressions).  Spark sums their first and second moments by class
over the labelled rows; from those two rows of sums the driver makes means, shrunken covariances and their Cholesky
factors, whose size doesn't depend on the data.  Tasks score Arrow batches with the cached factors: the difference of
two Mahalanobis log-densities plus the prior's log-odds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE_CHARS, bounded_sample, words


def statistics(text: Column, tokens: Column) -> dict[str, Column]:
    """Transformed statistics of a text: logs of sizes, square roots of shares.  An empty text has all 0."""
    whole = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(whole), F.lit(1))
    n = F.greatest(F.size(tokens), F.lit(1))
    lines = F.split(whole, "\n")
    root = lambda x, of: F.sqrt(F.greatest(x, F.lit(0)) / of)
    without = lambda chars: F.length(whole) - F.length(F.translate(whole, chars, ""))
    letters = F.greatest(F.regexp_count(whole, F.lit(r"\p{L}")), F.lit(1))
    return {
        "words": F.log1p(F.size(tokens)),
        "word_chars": F.log1p((F.length(whole) - without(SPACE_CHARS)) / n),
        "symbols": root(without("#*$%&"), size),
        "bars": root(without("|<>[]{}="), size),
        "marks": root(without("!?"), size),
        "stops": root(without(".,;:"), size),
        "digits": root(without("0123456789"), size),
        "capitals": root(F.regexp_count(whole, F.lit(r"\p{Lu}")), letters),
        "repeats": root(F.size(tokens) - F.size(F.array_distinct(tokens)), n),
        "same_lines": root(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "line_chars": F.log1p(F.length(whole) / F.size(lines)),
        "letters": root(F.regexp_count(whole, F.lit(r"\p{L}")), size),
    }


def with_statistics(df: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    df = df.withColumn("_tokens", words(F.col(text)))
    found = statistics(F.col(text), F.col("_tokens"))
    return df.withColumns({f"_s_{k}": v.cast("double") for k, v in found.items()}).drop("_tokens"), [f"_s_{k}" for k in found]


def moments(df: DataFrame, label: str, names: list[str]) -> DataFrame:
    """One row a class: its count, sums, and sums of products."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    return df.groupBy(label).agg(F.count("*").alias("n"), F.array(*[F.sum(a) for a in names]).alias("one"), F.array(*[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).alias("two"))


class Discriminant:
    """Class means, Cholesky factors of shrunken covariances, and log priors."""

    def __init__(self, rows: dict[int, tuple[int, np.ndarray, np.ndarray]], d: int, pooled: float, ridge: float):
        covariances, self.means, self.n = {}, {}, {y: r[0] for y, r in rows.items()}
        for y, (n, one, two) in rows.items():
            full = np.zeros((d, d))
            full[np.tril_indices(d)] = two
            full = full + np.tril(full, -1).T
            self.means[y] = one / n
            covariances[y] = full / n - np.outer(self.means[y], self.means[y])
        total = sum(self.n.values())
        common = sum(self.n[y] * c for y, c in covariances.items()) / max(total, 1) if covariances else np.eye(d)
        # Target of the ridge: the pooled variances, and a floor that keeps constant statistics harmless.
        base = np.diag(np.diag(common)) + 1e-4 * np.eye(d)
        self.factors = {y: np.linalg.cholesky((1 - pooled - ridge) * c + pooled * common + ridge * base) for y, c in covariances.items()}
        self.total = total

    def log_density(self, x: np.ndarray, y: int) -> np.ndarray:
        low = self.factors[y]
        z = np.linalg.solve(low, (x - self.means[y]).T)
        return -0.5 * (z * z).sum(0) - np.log(np.diag(low)).sum()

    def probability(self, x: np.ndarray, temper: float) -> np.ndarray:
        """Of class 1.  With one class or none seen, its share of the labels smoothed by one of each."""
        prior = (self.n.get(1, 0) + 1) / (self.total + 2)
        if len(self.factors) < 2:
            return np.full(len(x), prior)
        z = temper * (self.log_density(x, 1) - self.log_density(x, 0)) + np.log(prior / (1 - prior))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = 40_000,
    pooled: float = 0.1,
    ridge: float = 0.05,
    temper: float = 1.0,
) -> DataFrame:
    """Every row of docs with quality_score, the probability of class 1.

    ``labels`` has the rows to learn from; leave held-out rows out of it.  At most about ``fit_rows`` of them, chosen by
    hash, are used; their keys are broadcast.  Null labels and keys are left out, repeated ones count once at their
    largest.  A null or empty text has statistics of 0 and is scored like any other; equal texts get equal scores.
    ``temper`` under 1 flattens the scores, since statistics of a text aren't independent of one another.
    """
    docs = docs.drop("quality_score")
    learnt = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_y"))
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(bounded_sample(learnt, "_key", fit_rows), "_key")
    sample, names = with_statistics(sample, "_text")
    rows = {r["_y"]: (r["n"], np.array(r["one"]), np.array(r["two"])) for r in moments(sample, "_y", names).collect()}
    model = Discriminant(rows, len(names), pooled, ridge)

    @F.pandas_udf("double")
    def scored(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.probability(np.column_stack([c.to_numpy() for c in columns]), temper))

    out, names = with_statistics(docs, text)
    return out.withColumn("quality_score", scored(*names)).drop(*names)
