"""Blending, calibration, evaluation and ranking of score tables."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.sizing import fits

ID, SCORE = "instance_id", "predicted_score"
CLIP = 1e-15


def align(*tables: DataFrame, id_col: str = ID, score: str = SCORE) -> DataFrame:
    """Join score tables on the id; scores become s0, s1, ..."""
    renamed = [t.select(id_col, F.col(score).alias(f"s{i}")) for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.join(b, id_col), renamed)


def weighted_blend(
    tables: Sequence[DataFrame], weights: Sequence[float], id_col: str = ID, score: str = SCORE
) -> DataFrame:
    parts = [F.col(f"s{i}") * F.lit(float(w)) for i, w in enumerate(weights)]
    return align(*tables, id_col=id_col, score=score).select(id_col, reduce(Column.__add__, parts).alias(score))


def mean_blend(tables: Sequence[DataFrame], id_col: str = ID, score: str = SCORE) -> DataFrame:
    parts = [F.col(f"s{i}") for i in range(len(tables))]
    total = reduce(Column.__add__, parts)
    return align(*tables, id_col=id_col, score=score).select(id_col, (total / len(tables)).alias(score))


def nested_blend(
    first: DataFrame, second: DataFrame, third: DataFrame, id_col: str = ID, score: str = SCORE
) -> DataFrame:
    """Mean of the third score with the mean of the first two."""
    half = F.col("s0") * 0.5 + F.col("s1") * 0.5
    return align(first, second, third, id_col=id_col, score=score).select(
        id_col, (half * 0.5 + F.col("s2") * 0.5).alias(score)
    )


def calibrate(scores: DataFrame, target: float = 0.0273, score: str = SCORE) -> DataFrame:
    """Scale scores so that their mean is ``target``; the mean is a scalar subquery."""
    mean = scores.agg(F.avg(score)).scalar()
    return scores.withColumn(score, F.col(score) * (F.lit(target) / mean))


def row_loss(label: Column | str, score: Column | str) -> Column:
    """Log loss of a row; scores are clipped away from 0 and 1."""
    y = (F.col(label) if isinstance(label, str) else label).cast("double")
    p = F.col(score) if isinstance(score, str) else score
    p = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def log_loss_of(label: Column | str, score: Column | str) -> Column:
    """Aggregate expression: the mean of ``row_loss``."""
    return F.avg(row_loss(label, score))


def log_loss(scored: DataFrame, by: Sequence[str] = (), label: str = "is_trade", score: str = SCORE) -> DataFrame:
    return scored.groupBy(*by).agg(log_loss_of(label, score).alias("log_loss"))


def mean_fold_loss(scored: DataFrame, fold: str = "fold", label: str = "is_trade", score: str = SCORE) -> DataFrame:
    return log_loss(scored, [fold], label, score).agg(F.avg("log_loss").alias("mean_log_loss"))


def area_under_roc(scored: DataFrame, label: str = "is_trade", score: str = SCORE) -> float:
    """Exact area (no score binning), computed by a distributed sort of the scores."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol="_label", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored.select(F.col(label).cast("double").alias("_label"), score))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present, one row per pair.

    Two passes of plain sums: first means, then products of centred values. Pairs of columns
    without NULLs share their squares, so they cost one sum each. NULL where a column is constant.
    """
    columns = list(columns)
    stats = df.select(columns).agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(e).alias(f"{k}_{c}") for c in columns for k, e in (
            ("n", f"count({c})"), ("mean", f"avg(cast({c} AS double))"), ("varies", f"min({c}) < max({c})"))
    ]).first()
    varying = [c for c in columns if stats[f"varies_{c}"]]
    centred = df.selectExpr(*[f"cast({c} AS double) - {stats[f'mean_{c}']!r}D AS {c}" for c in varying] or ["0 AS none"])

    sums: dict[str, str] = {}

    def total(name: str, value: str) -> str:
        sums[name] = f"sum({value}) AS {name}"
        return name

    def correlation(x: str, y: str) -> str:
        if not (x in varying and y in varying):
            return "cast(NULL AS double)"
        if stats[f"n_{x}"] == stats["n"] == stats[f"n_{y}"]:
            xx, yy, xy = total(f"sq_{x}", f"{x} * {x}"), total(f"sq_{y}", f"{y} * {y}"), total(f"{x}__{y}", f"{x} * {y}")
            return f"try_divide({xy}, sqrt({xx} * {yy}))"
        # The means of the shared rows differ from the overall ones, so the sums are needed too.
        tag, both = f"{x}__{y}", f"{x} IS NOT NULL AND {y} IS NOT NULL"
        n, sx, sy, xx, yy, xy = (
            total(f"{k}_{tag}", f"CASE WHEN {both} THEN {e} END") for k, e in (
                ("n", "1"), ("x", x), ("y", y), ("xx", f"{x} * {x}"), ("yy", f"{y} * {y}"), ("xy", f"{x} * {y}")))
        spread = f"({xx} - try_divide({sx} * {sx}, {n})) * ({yy} - try_divide({sy} * {sy}, {n}))"
        return f"try_divide({xy} - try_divide({sx} * {sy}, {n}), sqrt({spread}))"

    cells = []
    for x, y in itertools.combinations_with_replacement(columns, 2):
        corr = correlation(x, y)
        for a, b in {(x, y), (y, x)}:
            cells.append(f"named_struct('column_a', '{a}', 'column_b', '{b}', 'corr', {corr})")
    wide = centred.agg(*[F.expr(e) for e in sums.values()]) if sums else df.sparkSession.range(1)
    return wide.selectExpr(f"inline(array({', '.join(cells)}))")


def slice_sizes(df: DataFrame, by: Sequence[str] = ("slice",)) -> DataFrame:
    """Rows per slice and the number of columns."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def top_n(df: DataFrame, n: int, score: str, *tie_breakers: str) -> DataFrame:
    return df.orderBy(F.col(score).desc(), *tie_breakers).limit(n)


def top_ranks(df: DataFrame, n: int, score: str, name: str = "rank") -> DataFrame:
    """All rows whose competition rank by descending score is at most ``n``; ties share a rank.

    The n-th best score bounds the result, so only rows at or above it are ranked: a top-n per
    partition and one filter, no global sort. Ranks are looked up by score, since rows at one
    score may be many while the better ones are fewer than ``n``.
    """
    best = df.select(score).dropna().orderBy(F.col(score).desc()).limit(n)
    bound = best.agg(F.min(score)).scalar()
    kept = df.filter(F.col(score) >= bound)
    # At most n rows by construction, ranked here once per distinct score.
    ranks = best.groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
    better = Window.orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranks.select(
        F.col(score).alias("_score"), (F.coalesce(F.sum("_n").over(better), F.lit(0)) + 1).alias(name)
    )
    if fits(n, 2):
        ranks = F.broadcast(ranks)
    return kept.join(ranks, F.col(score) == F.col("_score")).drop("_score")
