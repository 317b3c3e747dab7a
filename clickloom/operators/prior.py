"""Beta prior of a conversion rate, fitted by fixed-point iteration on count histograms.

The update needs sums of digamma differences over all rows. They depend on a row only through its
counts, so rows are first reduced to histograms (distinct count -> number of rows). A histogram of
counts adding up to N has at most sqrt(2N) entries, which keeps each iteration small however large
the log is.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BetaPrior:
    alpha: float
    beta: float
    iterations: int
    converged: bool


def count_histograms(counts: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Histograms (name, kind, n, weight) of hits, misses and tries; zero counts are left out.

    ``pairs`` maps the name of a prior to its (tries, hits) columns.
    """
    def value(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast("double")

    each = F.array(*[
        F.struct(F.lit(name).alias("name"), value(t).alias("t"), value(h).alias("h")) for name, (t, h) in pairs.items()
    ])
    # Rows are reduced to distinct (tries, hits) first, so that the three-way copy is small.
    joint = counts.select(F.explode(each).alias("p")).groupBy("p.name", "p.t", "p.h").agg(F.count(F.lit(1)).alias("w"))
    kinds = F.array(
        F.struct(F.lit("hits").alias("kind"), F.col("h").alias("n")),
        F.struct(F.lit("misses").alias("kind"), (F.col("t") - F.col("h")).alias("n")),
        F.struct(F.lit("tries").alias("kind"), F.col("t").alias("n")),
    )
    return (
        joint.select("name", F.explode(kinds).alias("k"), "w").groupBy("name", "k.kind", "k.n")
        .agg(F.sum("w").cast("double").alias("weight")).filter("n > 0")
    )


def fit_beta_priors(
    counts: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    start: tuple[float, float] = (1.0, 1.0),
    max_iter: int = 1000,
    tolerance: float = 1e-8,
) -> dict[str, BetaPrior]:
    """Fit (alpha, beta) of every named pair of count columns over the rows of ``counts``.

    One row per label row weighs keys by their rows; for a weight per key, pass one row per key.
    As in the original stop rule, the values *before* the step that moved less than ``tolerance`` are
    returned. Spark reduces the rows to histograms; these, at most sqrt(2N) entries for counts that add up to N (a
    few hundred thousand for a trillion clicks), are all that the steps need and are brought to the driver.
    """
    table = count_histograms(counts, pairs).toArrow().to_pandas()
    fits = {}
    for name in pairs:
        mine = {
            kind: rows[["n", "weight"]].sort_values("n").to_numpy(float)
            for kind, rows in table[table["name"] == name].groupby("kind")
        }
        fit, more = BetaPrior(float(start[0]), float(start[1]), 0, False), True
        while more and fit.iterations < max_iter:
            shifts = {"hits": fit.alpha, "misses": fit.beta, "tries": fit.alpha + fit.beta}
            fit, more = _advance(fit, *[_gain(mine.get(kind), shift) for kind, shift in shifts.items()], tolerance)
        fits[name] = fit
    return fits


def _gain(histogram: np.ndarray | None, shift: float) -> float:
    if histogram is None:
        return 0.0
    n, weight = histogram.T
    return float((weight * (digamma(n + shift) - digamma(np.full(1, shift)))).sum())


def digamma(x: np.ndarray) -> np.ndarray:
    """Six steps of the recurrence, then the asymptotic series."""
    low = sum(1 / (x + k) for k in range(6))
    inverse = 1 / (x + 6) ** 2
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse * (1 / 240 - inverse * (1 / 132 - inverse * 691 / 32760)))))
    return np.log(x + 6) - 0.5 / (x + 6) - series - low


def _advance(fit: BetaPrior, hits: float, misses: float, tries: float, tolerance: float) -> tuple[BetaPrior, bool]:
    """The prior after one step, and whether to go on."""
    done = fit.iterations + 1
    if not tries:
        return replace(fit, iterations=done), False  # no row was ever tried: nothing to learn from
    alpha, beta = fit.alpha * (hits / tries), fit.beta * (misses / tries)
    if abs(alpha - fit.alpha) < tolerance and abs(beta - fit.beta) < tolerance:
        return replace(fit, iterations=done, converged=True), False
    # All hits or all misses: the likelihood has no interior maximum.
    return BetaPrior(alpha, beta, done, False), alpha > 0 and beta > 0


def fit_beta_prior(counts: DataFrame, tries: str, hits: str, **options) -> BetaPrior:
    return fit_beta_priors(counts, {"prior": (tries, hits)}, **options)["prior"]
