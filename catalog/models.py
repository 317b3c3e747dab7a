"""Model queries: each fits, scores, and returns a summary that has a DuckDB twin. The scores themselves are what the
library functions return.

Queries of one or three fits use the presets unchanged. Where a query or the feature table needs many, the settings named
``*_MANY`` stand in, with a fifth of the rounds and five times the rate. The feature table is kept by content, so the
first of these queries builds it and the others read it.

What can fail in a summary: counts, ids and labels (DuckDB takes them from the tables), scores outside [0, 1], and losses on
the rows that a model was fitted on, which must not exceed the loss of the constant rate: ``base_loss`` is the larger of
the two, and DuckDB computes the latter.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import SLICES, SLICES_END, prepared, query, sliced
from catalog.scores import HELD
from clickloom.operators.ensembles import Rounds, fit_with_patience, node_table, split_importances, watch_metrics
from clickloom.operators.indexing import equal_folds, holdout
from clickloom.operators.models import (
    CATEGORICAL, FIRST_LIBRARY, FIRST_MANY, ID, LABEL, LEAF_TREES, PREDICT_TEXT, PREDICT_TEXT_MANY, PROPERTY_TEXT,
    PROPERTY_TEXT_MANY, SCORE, SECOND_LIBRARY, SECOND_MANY, feature_columns, fit_boosted, fit_leaf_embedding, importances,
    joint_one_hot, model_input, score, text_score, top_features,
)
from clickloom.operators.scores import CLIP, log_loss_of, row_loss
from clickloom.operators.sizing import shuffled_join
from clickloom.operators.sparse_logistic import cells_of, fit_l1_places, optimality, residuals
from clickloom.plans import specs
from clickloom.plans.feature_table import TEXT_SCORES, feature_table, text_score_table
from clickloom.plans.search import Tuner
from clickloom.plans.stacking import cross_fed_stack, fit_leaf_logistic, full_train_score, holdout_scores, leaf_table, out_of_fold
from clickloom.sources import kept, stage, table
from oracle.click_log import with_slices

TABLE_TEXT = {"item_property_list": PROPERTY_TEXT_MANY, "predict_category_property": PREDICT_TEXT_MANY}
# 100 rounds of rate 0.01 are 10 of rate 0.1.
PATIENCE = 10
# The loss of a row whose score, clipped, is on the wrong side; with room for rounding.
MOST_LOSS = -math.log(CLIP) + 1e-6


def whole_table(spark, sf) -> DataFrame:
    """The whole feature path, text scores included, of all slices; built once for all that read it."""
    log = prepared(spark, sf, SLICES_END)
    return kept(log, "feature-table", (SLICES, specs.EXECUTED, TABLE_TEXT),
                lambda: feature_table(stage(log, "log"), SLICES, text_models=TABLE_TEXT))


def model_frame(spark, sf) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train and validation rows, test rows, features): the whole feature table, without exact copies; fits fill gaps."""
    whole = whole_table(spark, sf)
    return whole.filter("slice < 3"), whole.filter("slice = 3"), feature_columns(whole)


def n_rows():
    return F.count(F.lit(1)).alias("n_rows")


def scored(score: str, *ids: str):
    """Aggregates: rows, ids, and whether every score is there and within [0, 1]."""
    inside = F.count_if(F.col(score).between(0.0, 1.0)) == F.count(F.lit(1))
    return n_rows(), F.count_distinct(*ids).alias("n_ids"), inside.alias("all_scored")


def buys():
    return F.sum(LABEL).cast("long").alias("n_buys")


def base_loss(score: str = SCORE):
    """Aggregate: the loss of the scores or, if that is less, of the constant rate."""
    rate = F.avg(LABEL)
    constant = -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))
    return F.round(F.greatest(log_loss_of(LABEL, score), constant), 6).alias("base_loss")


BASE = "round(-(avg(is_trade) * ln(avg(is_trade)) + (1 - avg(is_trade)) * ln(1 - avg(is_trade))), 6) AS base_loss"
COUNTS = "count(*) AS n_rows, count(DISTINCT instance_id) AS n_ids, true AS all_scored"
BUYS = "CAST(sum(is_trade) AS BIGINT) AS n_buys"


def counted_sql(where: str = "", by: str = "", more: str = "") -> str:
    return with_slices(f"""SELECT {by + "," if by else ""} {COUNTS} {", " + more if more else ""}
        FROM l {"WHERE " + where if where else ""} {"GROUP BY " + by if by else ""}""")


def text_summary(spark, sf, text, name, boosting) -> DataFrame:
    """Rows by slice; a score belongs to a text, so there are as many (text, score) pairs as texts."""
    labels, history = sliced(spark, sf, [text])
    found = text_score_table(labels, history, SLICES, text, name, boosting, ("slice", ID))
    texts = labels.select(F.col("slice").alias("s"), F.col(ID).alias("i"), text)
    return found.join(texts, F.expr(f"slice = s AND {ID} = i")).groupBy("slice").agg(
        *scored(name, ID), F.count_distinct(text, F.round(name, 9)).alias("n_texts"))


@query("m2_property_text_score", counted_sql(by="slice", more="count(DISTINCT item_property_list) AS n_texts"))
def m2(spark, sf):
    return text_summary(spark, sf, "item_property_list", "property_prob", PROPERTY_TEXT)


@query("m3_predict_text_score", counted_sql(by="slice", more="count(DISTINCT predict_category_property) AS n_texts"))
def m3(spark, sf):
    return text_summary(spark, sf, "predict_category_property", "predict_prob", PREDICT_TEXT)


@query("m2_document_text_score", """
SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, true AS all_scored
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def m2_documents(spark, sf):
    """The text-score operator on prose: labelled documents teach, all other documents are scored."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    labelled = documents.join(labels, "doc_id")
    other = documents.join(labels, "doc_id", "left_anti")
    found = text_score(labelled, other, "text", "quality_prob", PROPERTY_TEXT, keep=("doc_id",), label="quality")
    return found.agg(*scored("quality_prob", "doc_id"))


@query("m5_out_of_fold_scores", with_slices(f"""
SELECT {COUNTS}, {BUYS}, 10 AS n_folds, count(*) // 10 AS smallest_fold FROM l WHERE slice < 3"""))
def m5(spark, sf):
    """Ten folds of equal size; every row is scored by a model that has not seen its fold."""
    train, _, features = model_frame(spark, sf)
    found = stage(out_of_fold(equal_folds(train), features, FIRST_MANY), "oof")
    sizes = found.groupBy("fold").count().agg(F.min("count").alias("smallest_fold"), F.count(F.lit(1)).cast("int").alias("n_folds"))
    # One row each.
    return found.agg(*scored(SCORE, ID), buys()).crossJoin(F.broadcast(sizes))


@query("m6_m9_full_train_scores", counted_sql("slice = 3"))
def m6(spark, sf):
    """One library fitted on the whole feature table, without exact copies and with gaps filled; the test slice scored."""
    train, test, features = model_frame(spark, sf)
    return full_train_score(train, test, features, FIRST_LIBRARY).agg(*scored(SCORE, ID))


@query("m7_holdout_loss", with_slices(f"""
SELECT CASE WHEN {HELD} THEN 'held' ELSE 'rest' END AS part, {COUNTS}, {BUYS}, count(*) AS n_losses, true AS loss_fits,
  CASE WHEN NOT bool_or({HELD}) THEN {BASE.removesuffix(" AS base_loss")} END AS base_loss FROM l WHERE slice < 3 GROUP BY 1"""))
def m7(spark, sf):
    """Random hold-out of the training rows: both parts scored by the model of the rest, the rows of either that have a finite
    loss, whether its mean, the hold-out loss, lies within what clipped scores allow, and the fitted part's against the
    constant rate's."""
    train, _, features = model_frame(spark, sf)
    found = holdout_scores(train, features)
    return found.groupBy("part").agg(
        *scored(SCORE, ID), buys(), F.count_if(row_loss(LABEL, SCORE).between(0.0, MOST_LOSS)).alias("n_losses"),
        log_loss_of(LABEL, SCORE).between(0.0, MOST_LOSS).alias("loss_fits"),
        F.when(F.first("part") == "rest", base_loss()).alias("base_loss"),
    )


@query("m7_training_loss", with_slices(f"SELECT {COUNTS}, {BASE} FROM l WHERE slice < 3 AND NOT ({HELD})"))
def m7_training(spark, sf):
    """The hold-out model's loss on the rows that it was fitted on, against the constant rate's."""
    train, _, features = model_frame(spark, sf)
    rest, _ = holdout(train, 0.3)
    return score(fit_boosted(rest, features, FIRST_LIBRARY), rest, features, (ID, LABEL)).agg(*scored(SCORE, ID), base_loss())


@query("m8_validated_by_time", with_slices(f"""
SELECT {COUNTS}, {BUYS}, 120 AS n_rounds, 0 AS n_better, true AS best_within FROM l WHERE slice = 2"""))
def m8(spark, sf):
    """Train on label day 23, keep the rounds up to the best one on day 24 (none better within the patience), score day 24."""
    train, _, features = model_frame(spark, sf)
    first, second = train.filter("slice = 1"), train.filter("slice = 2")
    found = fit_with_patience(first, second, features, FIRST_LIBRARY, PATIENCE)
    least = F.max(F.when(F.col("round") == found.best, F.col("log_loss")))
    seen = F.collect_list(F.when(F.col("round") <= found.best + PATIENCE, F.col("log_loss")))  # one number per round
    losses = found.losses.agg(
        F.count(F.lit(1)).cast("int").alias("n_rounds"), least.alias("least"), seen.alias("seen")
    ).select("n_rounds", F.expr("cast(size(filter(seen, x -> x < least)) AS int)").alias("n_better"),
             F.lit(1 <= found.best <= FIRST_LIBRARY.maxIter).alias("best_within"))
    return found.score(second, (ID, LABEL)).agg(*scored(SCORE, ID), buys()).crossJoin(F.broadcast(losses))


@query("a16_m9_watch_metrics", with_slices(f"""
SELECT 'train' AS "set", 120 AS n_rounds, count(*) AS least_rows, count(*) AS most_rows, {BUYS}, true AS areas_fit, {BASE}
FROM l WHERE slice = 1
UNION ALL
SELECT 'valid', 120, count(*), count(*), {BUYS}, true, NULL FROM l WHERE slice = 2"""))
def a16_rounds(spark, sf):
    """Log loss and area under the ROC curve after every round on the fitted and on the later day, from one pass."""
    train, _, features = model_frame(spark, sf)
    first, second = train.filter("slice = 1"), train.filter("slice = 2")
    rounds = Rounds.of(fit_boosted(first, features, FIRST_LIBRARY), features)
    found = stage(watch_metrics(rounds, {"train": first, "valid": second}), "watch")
    rate = F.max(F.col("n_buys") / F.col("n_rows"))
    constant = -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))
    last = F.max_by("log_loss", "round")
    return found.groupBy("set").agg(
        F.count_distinct("round").cast("int").alias("n_rounds"), F.min("n_rows").alias("least_rows"), F.max("n_rows").alias("most_rows"),
        F.min("n_buys").alias("n_buys"), F.every(F.col("auc").between(0.0, 1.0)).alias("areas_fit"),
        F.when(F.first("set") == "train", F.round(F.greatest(last, constant), 6)).alias("base_loss"),
    )


@query("m10_cross_fed_stack", with_slices(f"SELECT {COUNTS}, true AS second_scored FROM l WHERE slice = 3"))
def m10(spark, sf):
    train, test, features = model_frame(spark, sf)
    stacked = cross_fed_stack(equal_folds(train), test, features, FIRST_MANY, SECOND_MANY)
    first, second = (df.withColumnRenamed(SCORE, name) for name, df in stacked.items())
    inside = F.count_if(F.col("second_on_first").between(0.0, 1.0)) == F.count(F.lit(1))
    return first.join(shuffled_join(second), ID).agg(*scored("first_on_second", ID), inside.alias("second_scored"))


def one_hot_sql() -> str:
    """Each column's code, shifted by the sizes of the columns before it (one place more each, for NULL)."""
    codes = ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS c{i}" for i, c in enumerate(CATEGORICAL))
    sizes = ", ".join(f"count(DISTINCT {c}) + 1 AS s{i}" for i, c in enumerate(CATEGORICAL))
    places = " UNION ALL ".join(
        f"SELECT slice, instance_id, CAST(c{i}{''.join(f' + s{j}' for j in range(i))} AS INT) AS place FROM codes, sizes"
        for i in range(len(CATEGORICAL))
    )
    return with_slices(places, f"codes AS (SELECT slice, instance_id, {codes} FROM l)", f"sizes AS (SELECT {sizes} FROM l)")


@query("m11_joint_one_hot", one_hot_sql())
def m11(spark, sf):
    """Positions set in the joint one-hot vectors of 17 categorical columns, train and test coded together."""
    labels, _ = sliced(spark, sf, CATEGORICAL)
    frames, _ = joint_one_hot(labels.filter("slice < 3"), labels.filter("slice = 3"))
    both = frames[0].unionByName(frames[1])
    # The sparse form as it is: the vectors are as wide as all columns have values.
    sparse = F.from_json(F.to_json(F.struct("one_hot")), "one_hot struct<indices array<int>>")
    return both.select("slice", "instance_id", F.explode(sparse["one_hot"]["indices"]).alias("place"))


@query("m12_leaf_embedding", with_slices("""
SELECT 13 * count(*) AS n_rows, count(DISTINCT instance_id) AS n_ids, 13 AS n_trees, true AS leaves_fit
FROM l WHERE slice = 3"""))
def m12(spark, sf):
    """13 trees of at most eight leaves."""
    train, test, features = model_frame(spark, sf)
    return leaf_table(train, test, features, LEAF_TREES).agg(
        n_rows(), F.count_distinct(ID).alias("n_ids"), F.count_distinct("tree").cast("int").alias("n_trees"),
        (F.count_if(F.col("leaf").between(0, 7)) == F.count(F.lit(1))).alias("leaves_fit"),
    )


@query("a17_tree_nodes", with_slices("""
SELECT 13 AS n_trees, 13 * count(*) AS root_rows, 13 * count(*) AS leaf_rows, 13 AS leaves_less_splits FROM l WHERE slice < 3"""))
def a17_nodes(spark, sf):
    """The node table of the leaf trees: all rows enter every root and end in a leaf, and a tree has a leaf more than splits."""
    train, _, features = model_frame(spark, sf)
    nodes = node_table(fit_leaf_embedding(train, features, LEAF_TREES), features)
    return nodes.agg(
        F.count_distinct("tree").cast("int").alias("n_trees"), F.sum(F.expr("if(node = 0, cover, 0)")).alias("root_rows"),
        F.sum(F.expr("if(leaf IS NOT NULL, cover, 0)")).alias("leaf_rows"),
        F.sum(F.expr("if(leaf IS NOT NULL, 1, -1)")).cast("int").alias("leaves_less_splits"),
    )


@query("a17_feature_importance", """
SELECT 1.0::DOUBLE AS total, 0 AS n_negative, 0 AS n_repeated, 0 AS uncounted_splits, 0 AS gain_without_split""")
def a17(spark, sf):
    """Splits, mean gain and mean cover of every feature next to the importance; the splits add up to the inner nodes."""
    train, _, features = model_frame(spark, sf)
    model = fit_boosted(train, features, FIRST_LIBRARY)
    nodes = stage(node_table(model, features), "nodes")
    # One row per column of the feature table.
    found = split_importances(nodes, features).join(importances(model, features, spark), "feature")
    inner = sum((t.numNodes - 1) // 2 for t in model.stages[-1].trees)
    return found.agg(
        F.round(F.sum("importance"), 6).alias("total"), F.count_if(F.col("importance") < 0).cast("int").alias("n_negative"),
        (F.count(F.lit(1)) - F.count_distinct("feature")).cast("int").alias("n_repeated"),
        (F.lit(inner) - F.sum("weight")).cast("int").alias("uncounted_splits"),
        F.count_if((F.col("weight") == 0) != (F.col("importance") == 0)).cast("int").alias("gain_without_split"),
    )


@query("m13_leaf_logistic", counted_sql("slice = 3"))
def m13(spark, sf):
    train, test, features = model_frame(spark, sf)
    fitted = fit_leaf_logistic(train, test, features)
    return fitted.scored(fitted.test).agg(*scored(SCORE, ID))


@query("m13_l1_certificate", with_slices(f"SELECT {COUNTS}, {BASE}, 0 AS n_off FROM l WHERE slice < 3"))
def m13_certificate(spark, sf):
    """The regression on leaves and categories, fitted to the end: loss against the constant rate's, and the number of places
    whose gradient misses the optimality condition by more than a tenth of the penalty."""
    train, test, features = model_frame(spark, sf)
    fitted = fit_leaf_logistic(train, test, features, max_iter=2000, tolerance=1e-12)
    off = fitted.certificate().agg(F.count_if(F.col("residual") > 0.1 * F.col("penalty")).cast("int").alias("n_off"))
    return fitted.scored(fitted.train, (ID, LABEL)).agg(*scored(SCORE, ID), base_loss()).crossJoin(F.broadcast(off))


@query("m13_l1_places", with_slices(f"SELECT count(*) AS n_rows, {BASE}, 0 AS n_off FROM l WHERE slice < 3"))
def m13_places(spark, sf):
    """The same regression on five categorical columns with its weights in a table, under a penalty of 0.01."""
    train, _, _ = model_frame(spark, sf)
    (rows,), _ = joint_one_hot(train, columns=("item_brand_id", "user_gender_id", "user_occupation_id", "shop_id", "item_city_id"))
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), F.col(LABEL).cast("double").alias("label"), "one_hot"), "l1")
    cells = stage(cells_of(rows, "row", "one_hot"), "l1-cells")
    fit = fit_l1_places(rows, cells, 0.01, 40, 1e-4)
    off = optimality(rows, cells, fit).agg(F.count_if(F.col("residual") > 0.1 * fit.penalty).cast("int").alias("n_off"))
    found = residuals(rows, cells, fit.weights, fit.intercept).select(F.col("label").alias(LABEL), F.col("p").alias(SCORE))
    return found.agg(n_rows(), base_loss()).crossJoin(F.broadcast(off))


@query("m13_leaf_training_losses", with_slices(f"""
SELECT model, count(*) AS n_rows, {BASE} FROM l, (VALUES ('boosted'), ('leaf_logistic')) AS m(model)
WHERE slice < 3 AND NOT ({HELD}) GROUP BY model"""))
def m13_losses(spark, sf):
    """Training losses of the leaf trees themselves and of the regression on their leaves, fitted beside a hold-out."""
    train, _, features = model_frame(spark, sf)
    rest, held = holdout(train, 0.3)
    boosted = score(fit_boosted(rest, features, LEAF_TREES), rest, features, (ID, LABEL))
    fitted = fit_leaf_logistic(rest, held, features, with_categories=False)
    leaves = fitted.scored(fitted.train, (ID, LABEL))
    return boosted.withColumn("model", F.lit("boosted")).unionByName(leaves.withColumn("model", F.lit("leaf_logistic"))).groupBy("model").agg(n_rows(), base_loss())


@query("t5_m22_selected_features", counted_sql("slice = 3"))
def t5(spark, sf):
    """Scores from the five most important features, raw ids dropped from the start."""
    train, test, _ = model_frame(spark, sf)
    features = feature_columns(train, drop=("item_id", "shop_id", "context_id"))
    best = top_features(fit_boosted(train, features, SECOND_LIBRARY), features, 5)
    return full_train_score(train, test, best, SECOND_LIBRARY).agg(*scored(SCORE, ID))


def tuner() -> Tuner:
    """Rounds times rate are 12 and 24, as with 120 rounds at 0.1 and 0.2."""
    space = {"maxDepth": range(2, 4), "stepSize": [0.5, 1.0], "featureSubsetStrategy": ["all", "sqrt"]}
    return Tuner.by_log_loss(GBTClassifier(maxIter=FIRST_MANY.maxIter, seed=0), space, n_folds=3)


def tuning_data(spark, sf) -> DataFrame:
    train, _, features = model_frame(spark, sf)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(model_input(train, features))
    return vectors.select("instance_id", "label", "features")


def settings(n: str):
    inside = F.col("maxDepth").isin(2, 3) & F.col("stepSize").isin(0.5, 1.0) & F.col("featureSubsetStrategy").isin("all", "sqrt")
    return (F.count_distinct("maxDepth", "stepSize", "featureSubsetStrategy").cast("int").alias(n),
            F.count_if(~inside).cast("int").alias("n_outside"), F.count_if(~(F.col("score") < 0)).cast("int").alias("n_unscored"))


@query("m19_m21_random_search", "SELECT 2 AS n_trials, 0 AS n_outside, 0 AS n_unscored")
def m19(spark, sf):
    """The square root of the eight settings, each different and from the space."""
    return tuner().random_trials(tuning_data(spark, sf), "instance_id", "sqrt").agg(*settings("n_trials"))


@query("m20_d6_surrogate_search", "SELECT 2 AS n_best, 0 AS n_outside, 0 AS n_unscored")
def m20(spark, sf):
    return tuner().search(tuning_data(spark, sf), "instance_id", n_iter=0.4, n_top=2).agg(*settings("n_best"))


@query("e2_feature_table_with_text", counted_sql(by="slice", more=BUYS))
def e2(spark, sf):
    """The whole feature path: counts, rates, positions, re-clicks and both text scores."""
    found = whole_table(spark, sf)
    inside = [F.count_if(F.col(c).between(0.0, 1.0)) == F.count(F.lit(1)) for c in TEXT_SCORES.values()]
    return found.groupBy("slice").agg(n_rows(), F.count_distinct(ID).alias("n_ids"), (inside[0] & inside[1]).alias("all_scored"), buys())
