"""Cross-validation of growth models: candidate coefficients against rolling splits, all in joins and sums.

A loss is a sum over (timepoint, clade) rows, and a row's estimate depends on the candidate and the timepoint alone.  So a
candidate is scored once a timepoint, whatever the number of splits whose window holds it; splits then add up timepoints.
The table of scored (candidate, timepoint) pairs is kept between rounds and only grows by what a round lacks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.operators.forecast import align_observed, standardise
from lineagrid.sources.files import checkpointed

#: The growth of a frequency counts as this where it is infinite.
MOST = 1000.0

#: Losses by name: the term of a row (of observed, estimated and initial frequency), and the loss of their sum over n rows.
LOSSES: dict[str, tuple[Callable[[Column, Column, Column], Column], Callable[[Column, Column], Column]]] = {
    "sse": (lambda o, e, i: (o - e) * (o - e), lambda s, n: s),
    "rmse": (lambda o, e, i: (o - e) * (o - e), lambda s, n: F.sqrt(F.try_divide(s, n))),
    "mae": (lambda o, e, i: F.abs(o - e), lambda s, n: F.try_divide(s, n)),
    "information_gain": (lambda o, e, i: F.when(o != 0, -o * F.ln(F.try_divide(e, i))), lambda s, n: s),
    "difference": (lambda o, e, i: o - e, lambda s, n: s),
}


class Panel:
    """Standardised rows (t, clade, frequency, predictors), ready to be scored, with what was observed at (t, clade).

    Rows of a timepoint whose predictor has no deviation keep it as it is.
    """

    def __init__(self, rows: DataFrame, observed: DataFrame, predictors: Sequence[str], t: str, clade: str, frequency: str, dt: float, loss: str = "mae") -> None:
        self.predictors, self.loss, self.dt = list(predictors), loss, dt
        named = rows.select(F.col(t).alias("t"), F.col(clade).alias("clade"), F.col(frequency).alias("f"), *self.predictors)
        self.rows = checkpointed(standardise(named, self.predictors, "f", "t"))
        self.observed = observed.select(F.col(t).alias("t"), F.col(clade).alias("clade"), "observed")

    def score(self, pairs: DataFrame) -> DataFrame:
        """(candidate, t, n, s) of pairs (candidate, t, a coefficient each predictor): clades and the sum of loss terms.

        Pairs meet rows by timepoint, and rows are summed to clades before anything else is shuffled.
        """
        beta = pairs.select("candidate", "t", *[F.col(p).alias(f"_b_{p}") for p in self.predictors])
        fit = reduce(lambda a, b: a + b, [F.col(p) * F.col(f"_b_{p}") for p in self.predictors], F.lit(0.0))
        grown = F.col("f") * F.exp(fit * self.dt)
        rows = self.rows.join(beta, "t").withColumn("_g", F.when(grown == float("inf"), MOST).otherwise(grown))
        sums = rows.groupBy("candidate", "t", "clade").agg(F.sum("f").alias("i"), F.sum("_g").alias("_g"))
        total = sums.groupBy("candidate", "t").agg(F.sum("_g").alias("_t"))
        estimated = sums.join(total, ["candidate", "t"]).withColumn("e", F.try_divide("_g", "_t"))
        term = LOSSES[self.loss][0](F.col("observed"), F.col("e"), F.col("i"))
        return align_observed(estimated, self.observed, ["t", "clade"]).groupBy("candidate", "t").agg(F.count("*").alias("n"), F.sum(term).alias("s"))

    def finish(self, s: Column, n: Column) -> Column:
        return LOSSES[self.loss][1](F.coalesce(s, F.lit(0.0)), n)


def every_split(candidates: DataFrame, splits: DataFrame) -> DataFrame:
    """Candidates once a validation timepoint."""
    timepoints = splits.agg(F.sort_array(F.collect_set("validate"))).scalar()
    return candidates.withColumn("validate", F.explode(timepoints))


def _norm(predictors: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.abs(p) for p in predictors], F.lit(0.0))


def score_splits(panel: Panel, trials: DataFrame, splits: DataFrame, scored: DataFrame, l1: float) -> DataFrame:
    """(validate, candidate, predictors, loss): scored timepoints summed over each split's training ones, and the L1 norm."""
    keys = ["validate", "candidate", *panel.predictors]
    rows = trials.select(*keys).join(splits, "validate").join(scored.withColumnRenamed("t", "train"), ["candidate", "train"])
    out = rows.groupBy(*keys).agg(F.sum("s").alias("_s"), F.sum("n").alias("_n"))
    return out.select(*keys, (panel.finish(F.col("_s"), F.col("_n")) + l1 * _norm(panel.predictors)).alias("loss"))


def _scored_further(panel: Panel, trials: DataFrame, splits: DataFrame, scored: DataFrame | None) -> DataFrame:
    pairs = trials.join(splits, "validate").select("candidate", F.col("train").alias("t"), *panel.predictors).distinct()
    if scored is None:
        return checkpointed(panel.score(pairs))
    return checkpointed(scored.union(panel.score(pairs.join(scored, ["candidate", "t"], "left_anti")).select(*scored.columns)))


def search(panel: Panel, candidates: DataFrame, splits: DataFrame, *, l1: float = 0.0, rounds: int = 1, zooms: int = 0, step: float = 0.25) -> DataFrame:
    """(validate, candidate, predictors, loss) of the candidates that each split (validate, train) still has at the end.

    ``candidates`` has distinct (candidate, a coefficient each predictor).  Of k rounds, round r takes the latest
    1 / 2**(k - r) of a split's training timepoints, rounded up, and all but the last leave each split the better half of
    its candidates, rounded up; ties go to the smaller candidate.  One round scores all of them on everything.

    Each of ``zooms`` turns then gives every split the neighbours of its best candidate, ``step`` up and down in each
    coefficient, the step halved each turn.
    """
    aged = splits.select("validate", "train").withColumns({
        "_age": F.row_number().over(Window.partitionBy("validate").orderBy(F.desc("train"))),
        "_of": F.count("*").over(Window.partitionBy("validate")),
    })
    aged = checkpointed(aged)
    keys = ["validate", "candidate", *panel.predictors]
    trials = every_split(candidates.select("candidate", *[F.col(p).cast("double").alias(p) for p in panel.predictors]), splits).select(*keys)
    scored, out = None, None
    for left in reversed(range(rounds)):
        part = aged.where(F.col("_age") <= F.ceil(F.col("_of") / 2**left)).select("validate", "train")
        scored = _scored_further(panel, trials, part, scored)
        out = score_splits(panel, trials, part, scored, l1)
        if left:
            window = Window.partitionBy("validate")
            ranked = out.withColumns({"_r": F.row_number().over(window.orderBy(F.col("loss").asc_nulls_last(), "candidate")), "_m": F.count("*").over(window)})
            trials = checkpointed(ranked.where(F.col("_r") <= F.ceil(F.col("_m") / 2)).select(*keys))
    for turn in range(zooms):
        out = checkpointed(out)
        moves = [F.struct(F.lit(f"{'+' if by > 0 else '-'}{p}").alias("name"), *[F.lit(by if q == p else 0.0).alias(q) for q in panel.predictors]) for p in panel.predictors for by in (step / 2**turn, -step / 2**turn)]
        near = best_per_split(out).withColumn("_m", F.explode(F.array(*moves)))
        # The name tells the split and the way, since each split zooms in on its own best.
        name = F.concat_ws("|", F.col("candidate"), F.concat(F.col("validate").cast("string"), F.lit(f"#{turn}"), F.col("_m.name")))
        near = checkpointed(near.select("validate", name.alias("candidate"), *[(F.col(p) + F.col(f"_m.{p}")).alias(p) for p in panel.predictors]))
        scored = _scored_further(panel, near, splits, scored)
        out = out.union(score_splits(panel, near, splits, scored, l1).select(*out.columns))
    return out


def best_per_split(found: DataFrame) -> DataFrame:
    """Each split's row of the smallest loss; of equal ones the smallest candidate; a null loss comes last."""
    columns = [c for c in found.columns if c != "validate"]
    order = F.struct(F.col("loss").isNull(), "loss", "candidate")
    return found.groupBy("validate").agg(F.min_by(F.struct(*columns), order).alias("x")).select("validate", "x.*").select(*found.columns)


def cross_validate(panel: Panel, candidates: DataFrame, splits: DataFrame, **how: object) -> DataFrame:
    """(validate, candidate, predictors, training_error, null_training_error, training_n, validation_error,
    null_validation_error, validation_n): each split's best candidate of :func:`search`, beside the model without growth.

    Errors are without the L1 norm; n counts the (timepoint, clade) rows behind them.
    """
    best = checkpointed(best_per_split(search(panel, candidates, splits, **how)).select("validate", "candidate", *panel.predictors))
    null = F.struct(F.lit(None).cast("string").alias("candidate"), *[F.lit(0.0).alias(p) for p in panel.predictors])
    kinds = F.explode(F.array(F.struct(F.lit("model").alias("kind"), F.struct("candidate", *panel.predictors).alias("of")), F.struct(F.lit("null").alias("kind"), null.alias("of"))))
    asked = best.select("validate", kinds.alias("x")).select("validate", "x.kind", "x.of.*")
    places = splits.select("validate", F.col("train").alias("t"), F.lit("training").alias("part")).union(best.select("validate", F.col("validate").alias("t"), F.lit("validation").alias("part")))
    rows = checkpointed(asked.join(places, "validate").withColumn("name", F.coalesce("candidate", F.lit("\x00null"))))
    scored = panel.score(rows.select(F.col("name").alias("candidate"), "t", *panel.predictors).distinct()).withColumnRenamed("candidate", "name")
    sums = rows.select("validate", "kind", "part", "name", "t").join(scored, ["name", "t"]).groupBy("validate").agg(*[
        x
        for part in ("training", "validation")
        for x in (
            *[panel.finish(F.sum(F.when((F.col("kind") == kind) & (F.col("part") == part), F.col("s"))), F.sum(F.when((F.col("kind") == kind) & (F.col("part") == part), F.col("n")))).alias(name) for kind, name in (("model", f"{part}_error"), ("null", f"null_{part}_error"))],
            F.sum(F.when((F.col("kind") == "model") & (F.col("part") == part), F.col("n"))).alias(f"{part}_n"),
        )
    ])
    return best.join(sums, "validate", "left").select("validate", "candidate", *panel.predictors, "training_error", "null_training_error", "training_n", "validation_error", "null_validation_error", "validation_n")


def score_model(panel: Panel, beta: Mapping[str, float]) -> DataFrame:
    """(t, error, null_error, n): a fixed model at each timepoint of the panel, beside the one without growth."""
    kinds = [F.struct(F.lit(k).alias("candidate"), *[F.lit(float(b) if k == "model" else 0.0).alias(p) for p, b in beta.items()]) for k in ("model", "null")]
    pairs = panel.rows.select("t").distinct().select("t", F.explode(F.array(*kinds)).alias("x")).select("t", "x.*")
    by = panel.score(pairs).groupBy("t")
    of = lambda kind, c: F.max(F.when(F.col("candidate") == kind, F.col(c)))
    out = by.agg(of("model", "s").alias("_m"), of("null", "s").alias("_z"), of("model", "n").alias("n"))
    return out.select("t", panel.finish(F.col("_m"), F.col("n")).alias("error"), panel.finish(F.col("_z"), F.col("n")).alias("null_error"), "n")
