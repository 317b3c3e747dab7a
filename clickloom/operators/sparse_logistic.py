"""L1 logistic regression whose weights are a table keyed by place, and the optimality check of any such fit.

The minimised function is ``mean log loss + penalty * sum |weight|``, the intercept being free of the penalty. No machine
holds a vector as wide as the places: margins and gradients are aggregates over (row, place, value) cells.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.sizing import shuffled_join
from clickloom.sources.stage import stage


def cells_of(df: DataFrame, row: str, *vectors: str) -> DataFrame:
    """(row, place, value) of the non-zero entries of vector columns laid side by side.

    Offsets are the widths of the vectors before, taken from the first row: all rows have vectors of one width.
    """
    shape = "struct<type int, size int, indices array<int>, values array<double>>"
    # A vector shows its parts in its JSON form only; a dense one has no indices.
    parts = {v: F.from_json(F.to_json(F.struct(F.col(v).alias("v"))), f"v {shape}")["v"] for v in vectors}
    wide = df.select(F.col(row).alias("row"), *[p.alias(f"_{i}") for i, p in enumerate(parts.values())])
    first = wide.select(*[F.expr(f"coalesce(_{i}.size, size(_{i}.values))") for i in range(len(vectors))]).first() or [0] * len(vectors)
    entries, start = [], 0
    for i, width in enumerate(first):
        entries.append(F.expr(
            f"zip_with(coalesce(_{i}.indices, sequence(0, size(_{i}.values) - 1)), _{i}.values, (p, v) -> struct({start}L + p AS place, v AS value))"))
        start += width
    return wide.select("row", F.inline(F.concat(*entries))).where("value <> 0")


@dataclass(frozen=True)
class SparseLogistic:
    """Weights (place, weight) that are not 0, the intercept, and how the fit ended."""

    weights: DataFrame
    intercept: float
    penalty: float
    iterations: int
    change: float


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def residuals(rows: DataFrame, cells: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """(row, label, p): the fitted probability of every row; rows without cells have the intercept's."""
    margins = cells.join(weights.select(F.col("place").alias("_p"), "weight"), F.expr("place = _p")).groupBy("row").agg(
        F.sum(F.col("value") * F.col("weight")).alias("margin"))
    joined = rows.select("row", "label").join(shuffled_join(margins.withColumnRenamed("row", "_r")), F.expr("row = _r"), "left")
    return joined.select("row", "label", _probability(F.coalesce("margin", F.lit(0.0)) + F.lit(intercept)).alias("p"))


def gradients(cells: DataFrame, fitted: DataFrame, n: int) -> DataFrame:
    """(place, gradient) of the mean log loss, one partial sum per place and task."""
    errors = fitted.select(F.col("row").alias("_r"), (F.col("p") - F.col("label")).alias("_e"))
    return cells.join(shuffled_join(errors), F.expr("row = _r")).groupBy("place").agg(
        (F.sum(F.col("value") * F.col("_e")) / n).alias("gradient"))


def fit_l1_places(
    rows: DataFrame, cells: DataFrame, penalty: float, max_iter: int = 200, tolerance: float = 1e-6
) -> SparseLogistic:
    """Accelerated proximal steps until no weight moves by more than ``tolerance``.

    ``rows`` has (row, label 0/1), ``cells`` (row, place, value) with each place at most once per row. A place's step is
    ``4 / (w * mean of its squares)``, w being the most cells of a row (the intercept counts as one): steps of that length
    never overshoot together, and rare places take long ones. The momentum starts anew whenever it points uphill. The state
    is stored after each step, so a lost executor costs one step; the driver holds the intercept and three sums.
    """
    rows, cells = stage(rows.select("row", F.col("label").cast("double").alias("label")), "l1-rows"), stage(cells, "l1-cells")
    n, rate = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not n:
        return SparseLogistic(cells.select("place", F.col("value").alias("weight")).limit(0), 0.0, penalty, 0, 0.0)
    most = 1 + (cells.groupBy("row").count().agg(F.max("count")).first()[0] or 0)
    steps = cells.groupBy("place").agg((F.lit(4.0) / (most * F.sum(F.col("value") * F.col("value")) / n)).alias("step"))
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    intercept = ahead = math.log(rate / (1 - rate))
    state = stage(steps.select("place", "step", F.lit(0.0).alias("weight"), F.lit(0.0).alias("ahead")), "l1-state")
    momentum, done, change = 1.0, 0, math.inf
    while done < max_iter and change > tolerance:
        fitted = stage(residuals(rows, cells, state.where("ahead <> 0").select("place", F.col("ahead").alias("weight")), ahead), "l1-fitted")
        slope = fitted.agg(F.avg(F.col("p") - F.col("label"))).first()[0]
        moved = ahead - 4.0 / most * slope
        found = gradients(cells, fitted, n).withColumnRenamed("place", "_g")
        target = F.expr("ahead - step * coalesce(gradient, 0)")
        shrunk = F.signum(target) * F.greatest(F.abs(target) - F.col("step") * penalty, F.lit(0.0))
        stepped = state.join(found, F.expr("place = _g"), "left").select(
            "place", "step", F.col("weight").alias("old"), F.col("ahead").alias("from"), shrunk.alias("weight"))
        stepped = stage(stepped, "l1-stepped")
        uphill, largest = stepped.agg(
            F.sum(F.expr("(from - weight) * (weight - old) / step")), F.max(F.abs(F.col("weight") - F.col("old")))).first()
        uphill = (uphill or 0.0) + (ahead - moved) * (moved - intercept) * most / 4.0
        change = max(largest or 0.0, abs(moved - intercept))
        following = 1.0 if uphill > 0 else (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        share = 0.0 if uphill > 0 else (momentum - 1) / following
        ahead, intercept, momentum = moved + share * (moved - intercept), moved, following
        state = stepped.select("place", "step", "weight", (F.col("weight") + share * (F.col("weight") - F.col("old"))).alias("ahead"))
        done += 1
    return SparseLogistic(stage(state.where("weight <> 0").select("place", "weight"), "l1-weights"), intercept, penalty, done, change)


def optimality(rows: DataFrame, cells: DataFrame, fit: SparseLogistic) -> DataFrame:
    """(place, weight, gradient, residual) of every place with a cell, the intercept under place -1.

    At the optimum the gradient equals the penalty against the sign of the weight, or is at most the penalty where the
    weight is 0; ``residual`` is the distance from that.
    """
    n = rows.count()
    fitted = stage(residuals(rows, cells, fit.weights, fit.intercept), "l1-check")
    return distances(gradients(cells, fitted, max(n, 1)), fitted, fit)


def optimality_of_vectors(fitted: DataFrame, vectors: Sequence[str], fit: SparseLogistic) -> DataFrame:
    """``optimality`` of *stored* rows that hold their vectors next to (label, p), the fitted probability.

    A row's cells meet its error where the row lies, so one partial sum per place and task is all that is shuffled.
    """
    n = fitted.count()
    errors = cells_of(fitted.withColumn("_e", F.col("p") - F.col("label")), "_e", *vectors)
    slopes = errors.groupBy("place").agg((F.sum(F.col("value") * F.col("row")) / max(n, 1)).alias("gradient"))
    return distances(slopes, fitted, fit)


def distances(slopes: DataFrame, fitted: DataFrame, fit: SparseLogistic) -> DataFrame:
    """``optimality`` from the gradients (place, gradient) and the fitted rows (label, p)."""
    slopes = slopes.join(
        fit.weights.select(F.col("place").alias("_w"), "weight"), F.expr("place = _w"), "left"
    ).select("place", F.coalesce("weight", F.lit(0.0)).alias("weight"), "gradient")
    bound = F.lit(fit.penalty)
    off = F.when(F.col("weight") != 0, F.abs(F.col("gradient") + bound * F.signum("weight"))).otherwise(
        F.greatest(F.abs("gradient") - bound, F.lit(0.0)))
    free = fitted.select(F.lit(-1).cast("long").alias("place"), F.lit(fit.intercept).alias("weight"), (F.col("p") - F.col("label")).alias("e")).groupBy("place", "weight").agg(F.avg("e").alias("gradient"))
    return slopes.withColumn("residual", off).unionByName(free.withColumn("residual", F.abs("gradient")))
