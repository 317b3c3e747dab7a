"""What a fitted ensemble of boosted trees holds, and its scores after any number of rounds.

The node table is read from the model as Spark stores it. A row's score after r rounds is a prefix sum over the leaves it
falls into, so one pass over the rows gives the metrics of all r at once. The leaves' values (rounds times 2^depth numbers)
and one row of metrics per round are all that the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.operators.models import (
    FIRST_LIBRARY, ID, LABEL, SCORE, Boosting, fit_boosted, model_input,
)
from clickloom.operators.scores import CLIP
from clickloom.sources.stage import new_path, shared_folder, stage

LEAVES = "_leaves"
BINS = 1024


def node_table(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """One row per node: tree, weight of the tree, node, feature (null at leaves), threshold, gain, cover, prediction, leaf.

    ``gain`` is the split's reduction of squared error summed over its rows and ``cover`` the number of rows (of the
    tree's sample) that reach the node. ``leaf`` numbers a tree's leaves from the left, as the model's leaf column does.
    """
    trees = model.stages[-1]
    session = SparkSession.active()
    path = new_path(session, "ensemble")
    trees.write().save(path)
    names = F.array(*[F.lit(f) for f in features])
    weights = F.array(*[F.lit(float(w)) for w in trees.treeWeights])
    nodes = session.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    from_left = Window.partitionBy("tree", "inner").orderBy("node")
    return nodes.select(
        "tree", F.element_at(weights, F.col("tree") + 1).alias("weight"), F.col("id").alias("node"), inner.alias("inner"),
        F.when(inner, F.element_at(names, F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(inner & (F.col("split.numCategories") < 0), F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("gain") * F.col("rawCount")).alias("gain"), F.col("rawCount").alias("cover"), "prediction",
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
    ).withColumn("leaf", F.when(~F.col("inner"), F.row_number().over(from_left) - 1)).drop("inner")


def split_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, weight, gain, cover): number of splits on each feature, and their mean gain and mean cover (0 if none)."""
    found = nodes.where("feature IS NOT NULL").groupBy("feature").agg(
        F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"))
    # One row per column of the feature table.
    every = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(found, "feature", "left").na.fill(0, ["weight", "gain", "cover"])


@dataclass(frozen=True)
class Rounds:
    """A fitted ensemble with the values of its leaves, for scores after any number of rounds.

    ``values[tree, leaf]`` is the leaf's prediction times the tree's weight; unused places hold 0.
    """

    model: PipelineModel
    features: tuple[str, ...]
    values: np.ndarray

    @classmethod
    def of(cls, model: PipelineModel, features: Sequence[str]) -> Rounds:
        leaves = node_table(model, features).where("leaf IS NOT NULL").selectExpr("tree", "leaf", "prediction * weight AS v").toPandas()
        values = np.zeros((model.stages[-1].getNumTrees, int(leaves["leaf"].max()) + 1))
        values[leaves["tree"], leaves["leaf"]] = leaves["v"]
        return cls(model, tuple(features), values)

    def __len__(self) -> int:
        return len(self.values)

    def leaves_of(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and the leaf of every tree as an array."""
        assembler, trees = self.model.stages
        found = trees.copy().setLeafCol(LEAVES).transform(assembler.transform(model_input(df, self.features)))
        return found.select(*keep, vector_to_array(F.col(LEAVES)).alias(LEAVES))

    def score(self, df: DataFrame, rounds: int, keep: Sequence[str] = (ID,)) -> DataFrame:
        """``keep`` and the score of the first ``rounds`` trees alone."""
        values = self.values[:rounds]

        @F.pandas_udf("double")
        def after(leaves: pd.Series) -> pd.Series:
            return pd.Series(_probability(_margins(leaves, values)[:, -1]) if len(leaves) else [], dtype="float64")

        return self.leaves_of(df, *keep).select(*keep, after(LEAVES).alias(SCORE))


def _margins(leaves: pd.Series, values: np.ndarray) -> np.ndarray:
    """Sums of the leaves' values after each round, a row per row."""
    at = np.stack(leaves.to_numpy()).astype(np.int64)[:, : len(values)]
    return np.cumsum(values[np.arange(len(values)), at], axis=1)


def _probability(margin):
    return 1.0 / (1.0 + np.exp(-2.0 * margin))


def watch_metrics(rounds: Rounds, sets: Mapping[str, DataFrame], bins: int = BINS, label: str = LABEL) -> DataFrame:
    """(set, round, n_rows, n_buys, log_loss, auc) of every set after every round, from one pass over the rows.

    Log loss is summed exactly. The area under the ROC curve comes from histograms of ``bins`` equal score intervals, kept
    apart by label, which add up over partitions; scores that share an interval count as ties, so the area is off by at most
    half the share of (bought, not bought) pairs that fall into one interval.
    """
    values = rounds.values
    frames = [rounds.leaves_of(df.withColumn("_set", F.lit(name)), "_set", label) for name, df in sets.items()]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionAll(frame)

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Counts and losses of a partition by set, round, interval and label; at most rounds x intervals x 2 a set."""
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                for name, some in part.groupby("_set"):
                    p = _probability(_margins(some[LEAVES], values))
                    y = some[label].to_numpy().astype(np.int64)[:, None]
                    count, loss = held.setdefault(name, (np.zeros((len(values), bins, 2), np.int64), np.zeros((len(values), bins, 2))))
                    place = np.minimum((p * bins).astype(np.int64), bins - 1)
                    clipped = np.clip(p, CLIP, 1 - CLIP)
                    at = (np.arange(len(values))[None, :] * np.ones_like(place), place, y * np.ones_like(place))
                    np.add.at(count, at, 1)
                    np.add.at(loss, at, -np.log(np.where(y == 1, clipped, 1 - clipped)))
        for name, (count, loss) in held.items():
            r, b, y = np.nonzero(count)
            yield pd.DataFrame({"set": name, "round": r + 1, "bin": b, "bought": y, "n": count[r, b, y], "loss": loss[r, b, y]})

    schema = "set string, round int, bin int, bought int, n long, loss double"
    cells = rows.where(F.col(label).isNotNull()).mapInPandas(partials, schema).groupBy("set", "round", "bin").agg(
        F.sum(F.expr("if(bought = 1, n, 0)")).alias("buys"), F.sum(F.expr("if(bought = 0, n, 0)")).alias("rest"), F.sum("loss").alias("loss"))
    # A window holds the intervals of one round of one set.
    below = Window.partitionBy("set", "round").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("buys") * (F.coalesce(F.sum("rest").over(below), F.lit(0)) + F.col("rest") / 2)
    return cells.withColumn("ahead", ahead).groupBy("set", "round").agg(
        F.sum(F.col("buys") + F.col("rest")).alias("n_rows"), F.sum("buys").alias("n_buys"),
        (F.sum("loss") / F.sum(F.col("buys") + F.col("rest"))).alias("log_loss"),
        F.try_divide(F.sum("ahead"), F.sum("buys").cast("double") * F.sum("rest")).alias("auc"),
    )


def best_round(losses: Sequence[float], patience: int) -> int:
    """The round (from 1) of least loss, the first of equals, among those seen until none was better for ``patience`` rounds."""
    best = 0
    for r, loss in enumerate(losses):
        if loss < losses[best]:
            best = r
        elif r - best >= patience:
            break
    return best + 1


@dataclass(frozen=True)
class Validated:
    """An ensemble, the number of rounds that validation chose, and the losses that it was chosen by."""

    rounds: Rounds
    best: int
    losses: DataFrame

    def score(self, df: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
        return self.rounds.score(df, self.best, keep)


def fit_with_patience(
    train: DataFrame, valid: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY, patience: int = 100
) -> Validated:
    """Fit on the earlier rows and keep the rounds up to the best one on the later ones, stopping ``patience`` rounds after it.

    A round depends on those before it only, so cutting a longer ensemble is the same as having stopped there.
    """
    shared_folder(train.sparkSession)
    rounds = Rounds.of(fit_boosted(train, features, boosting), features)
    losses = stage(watch_metrics(rounds, {"valid": valid}), "losses")
    listed = [r["log_loss"] for r in losses.orderBy("round").collect()]  # one number per round
    return Validated(rounds, best_round(listed, patience), losses)
