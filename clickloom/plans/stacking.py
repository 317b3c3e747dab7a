"""Two-level stacking and the leaf-embedding model."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.indexing import hash_folds, holdout
from clickloom.operators.models import (
    CATEGORICAL, FIRST_LIBRARY, ID, LABEL, LEAF_TREES, SCORE, SECOND_LIBRARY, Boosting, fit_boosted,
    fit_l1_logistic, fit_leaf_embedding, joint_one_hot, l1_penalty, model_input, one_hot_leaves, positive, score,
)
from clickloom.operators.scores import log_loss
from clickloom.operators.sizing import shuffled_join
from clickloom.operators.sparse_logistic import SparseLogistic, optimality_of_vectors
from clickloom.sources.stage import spread, stage


def out_of_fold(
    train: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY, n_folds: int = 10,
    parallel: int = 3, fold: str = "fold",
) -> DataFrame:
    """Score every row by a model that has not seen its fold: (id, label, fold, score).

    Rows are folded by id hash unless they already carry a ``fold`` column.
    """
    folded = train if fold in train.columns else hash_folds(train, n_folds, name=fold)
    folded = stage(spread(folded.select(ID, LABEL, fold, *features)), "folds")

    def one(k: int) -> DataFrame:
        model = fit_boosted(folded.filter(F.col(fold) != k), features, boosting)
        return score(model, folded.filter(F.col(fold) == k), features, (ID, LABEL, fold))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        parts = list(pool.map(one, range(n_folds)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def full_train_score(
    train: DataFrame, test: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY
) -> DataFrame:
    """Fit on all labelled slices, score the test slice: (id, score)."""
    return score(fit_boosted(train, features, boosting), test, features)


def holdout_scores(
    train: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY, share: float = 0.3
) -> DataFrame:
    """(part, id, label, score) of a random hold-out (``held``) and of the ``rest``, by the model fitted on the rest."""
    rest, held = holdout(train, share)
    both = rest.withColumn("part", F.lit("rest")).unionAll(held.withColumn("part", F.lit("held")))
    return score(fit_boosted(rest, features, boosting), both, features, ("part", ID, LABEL))


def holdout_loss(
    train: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY, share: float = 0.3
) -> DataFrame:
    """Log loss on a random hold-out of the training rows."""
    return log_loss(holdout_scores(train, features, boosting, share).where("part = 'held'"))


def second_level(
    train: DataFrame, test: DataFrame, features: Sequence[str], train_scores: DataFrame, test_scores: DataFrame,
    boosting: Boosting,
) -> DataFrame:
    """Fit on the features plus the *other* library's scores (out-of-fold ones for training)."""
    column = "stacked_score"
    train = train.join(shuffled_join(train_scores.select(ID, F.col(SCORE).alias(column))), ID, "left")
    test = test.join(shuffled_join(test_scores.select(ID, F.col(SCORE).alias(column))), ID, "left")
    return full_train_score(train, test, [*features, column], boosting)


def cross_fed_stack(
    train: DataFrame, test: DataFrame, features: Sequence[str],
    first: Boosting = FIRST_LIBRARY, second: Boosting = SECOND_LIBRARY, n_folds: int = 10,
) -> dict[str, DataFrame]:
    """First level by both settings, second level by each on top of the other's scores."""
    out = {}
    level_one = {}
    for name, boosting in (("first", first), ("second", second)):
        level_one[name] = (
            stage(out_of_fold(train, features, boosting, n_folds), "oof"),
            stage(full_train_score(train, test, features, boosting), "scores"),
        )
    out["first_on_second"] = second_level(train, test, features, *level_one["second"], first)
    out["second_on_first"] = second_level(train, test, features, *level_one["first"], second)
    return out


@dataclass(frozen=True)
class LeafLogistic:
    """L1 logistic regression on one-hot tree leaves, with the vectors that it was fitted on and those to score."""

    model: PipelineModel
    train: DataFrame
    test: DataFrame
    vectors: tuple[str, ...]

    def scored(self, rows: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
        return self.model.transform(rows.select(*dict.fromkeys([*keep, *self.vectors]))).select(
            *keep, vector_to_array(F.col("probability"))[1].alias(SCORE))

    def certificate(self, c: float = 3.0) -> DataFrame:
        """(place, weight, gradient, residual, penalty): how far every place is from the optimality condition."""
        rows = self.model.transform(self.train.select(F.col(LABEL).cast("double").alias("label"), *self.vectors))
        rows = stage(rows.select("label", positive().alias("p"), *self.vectors), "certificate")
        found, penalty = self.model.stages[-1], l1_penalty(self.train, c)
        # The non-zero weights of a model that lies on the driver anyway, asked for once: each call copies the whole width.
        coefficients = found.coefficients.toArray()
        some = [(int(i), float(coefficients[i])) for i in coefficients.nonzero()[0]]
        weights = self.train.sparkSession.createDataFrame(some, "place long, weight double")
        fit = SparseLogistic(weights, float(found.intercept), penalty, 0, 0.0)
        return optimality_of_vectors(rows, self.vectors, fit).withColumn("penalty", F.lit(penalty))


def fit_leaf_logistic(
    train: DataFrame, test: DataFrame, features: Sequence[str], categorical: Sequence[str] = CATEGORICAL,
    boosting: Boosting = LEAF_TREES, c: float = 3.0, max_iter: int = 100, with_categories: bool = True, tolerance: float = 1e-6,
) -> LeafLogistic:
    """Leaves of the trees, by default next to one-hot categories coded over both frames, and the regression on them."""
    vectors = ["leaf_one_hot"]
    trees = fit_leaf_embedding(train, features, boosting)
    train, test = one_hot_leaves(trees, [train, test], features)
    if with_categories:
        (train, test), _ = joint_one_hot(train, test, columns=categorical)
        vectors.append("one_hot")
    train = stage(train.select(ID, LABEL, *vectors), "leaves")
    return LeafLogistic(fit_l1_logistic(train, vectors, c, max_iter, tolerance), train, test, tuple(vectors))


def leaf_logistic(train: DataFrame, test: DataFrame, features: Sequence[str], *args, **options) -> DataFrame:
    """Scores of the test rows by ``fit_leaf_logistic``: (id, score)."""
    fitted = fit_leaf_logistic(train, test, features, *args, **options)
    return fitted.scored(fitted.test)


def leaf_holdout_losses(
    train: DataFrame, features: Sequence[str], categorical: Sequence[str] = CATEGORICAL, boosting: Boosting = LEAF_TREES,
    share: float = 0.3, with_categories: bool = False, **options,
) -> DataFrame:
    """(model, log_loss) on a random hold-out: the boosted trees alone, and logistic regression on their leaves."""
    rest, held = holdout(train, share)
    boosted = score(fit_boosted(rest, features, boosting), held, features, (ID, LABEL))
    leaves = leaf_logistic(rest, held, features, categorical, boosting, with_categories=with_categories, **options)
    leaves = leaves.join(held.select(F.col(ID).alias("_held"), LABEL), F.col(ID) == F.col("_held")).drop("_held")
    return log_loss(boosted).select(F.lit("boosted").alias("model"), "log_loss").unionAll(
        log_loss(leaves).select(F.lit("leaf_logistic").alias("model"), "log_loss"))


def leaf_table(train: DataFrame, rows: DataFrame, features: Sequence[str], boosting: Boosting = LEAF_TREES) -> DataFrame:
    """(id, tree, leaf) of every row."""
    model = fit_leaf_embedding(train, features, boosting)
    leaves = vector_to_array(F.col("leaves"))
    return model.transform(model_input(rows, features)).select(
        ID, F.posexplode(leaves).alias("tree", "leaf")
    ).withColumn("leaf", F.col("leaf").cast("int"))
