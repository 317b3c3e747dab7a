import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from catalog import models as catalog_models
from clickloom.operators import models
from clickloom.operators.indexing import hash_folds, holdout
from clickloom.operators.models import (
    FIRST_LIBRARY, LEAF_TREES, SECOND_LIBRARY, feature_columns, fit_boosted, fit_leaf_embedding, fit_with_validation,
    importances, joint_one_hot, one_hot_leaves, score, text_score, text_shares, top_features, with_rounds,
)
from clickloom.operators.prior import count_histograms, fit_beta_prior, fit_beta_priors
from clickloom.operators.scores import log_loss
from clickloom.operators.text import fit_tfidf, tfidf_table, tokens_of
from clickloom.plans.search import Tuner, param_grid, sample_trials, trial_budget
from clickloom.plans.stacking import cross_fed_stack, holdout_loss, holdout_scores, leaf_logistic, out_of_fold
from clickloom.sources.stage import stage

QUICK = with_rounds(FIRST_LIBRARY, 3)


@pytest.fixture(scope="module")
def planted(spark):
    """Labels that follow ``x``; ``noise`` says nothing."""
    df = spark.range(0, 600, 1, 2).select(
        F.col("id").alias("instance_id"), (F.col("id") % 10).alias("x"), (F.col("id") * 37 % 11).alias("noise"),
        F.concat_ws(";", F.concat(F.lit("word"), F.col("id") % 10), F.lit("common")).alias("text"),
    ).withColumn("is_trade", (F.col("x") >= 7).cast("int"))
    return df.cache()


def baseline(df) -> float:
    p = df.agg(F.avg("is_trade")).first()[0]
    return -(p * math.log(p) + (1 - p) * math.log(1 - p))


def test_boosting_beats_the_constant_rate(spark, planted):
    model = fit_boosted(planted, ["x", "noise"], QUICK)
    scored = score(model, planted, ["x", "noise"], ("instance_id", "is_trade"))
    assert log_loss(scored).first()[0] < baseline(planted)
    table = importances(model, ["x", "noise"], spark).collect()
    assert [r["feature"] for r in table] == ["x", "noise"] and top_features(model, ["x", "noise"], 1) == ["x"]


def test_label_is_never_a_feature(planted):
    assert feature_columns(planted) == ["x", "noise"]


def test_early_stopping(planted):
    model = fit_with_validation(planted, planted.limit(100), ["x"], with_rounds(FIRST_LIBRARY, 6), tolerance=1.0)
    assert model.stages[-1].getNumTrees < 6


def test_out_of_fold_covers_every_id_once(planted):
    got = out_of_fold(planted, ["x"], with_rounds(FIRST_LIBRARY, 1), n_folds=3)
    assert got.count() == 600 and got.select("instance_id").distinct().count() == 600
    same = hash_folds(planted, 3).select("instance_id", F.col("fold").alias("f")).join(got, "instance_id")
    assert same.filter("f != fold").count() == 0
    assert log_loss(got).first()[0] < baseline(planted)


def test_cross_fed_stack(planted):
    train, test = planted.filter("instance_id < 400"), planted.filter("instance_id >= 400")
    quick = with_rounds(FIRST_LIBRARY, 1), with_rounds(SECOND_LIBRARY, 1)
    for scores in cross_fed_stack(train, test, ["x", "noise"], *quick, n_folds=2).values():
        assert scores.count() == 200


def test_leaf_one_hot_has_one_leaf_per_tree(planted):
    model = fit_leaf_embedding(planted, ["x", "noise"], with_rounds(LEAF_TREES, 4))
    out = one_hot_leaves(model, [planted], ["x", "noise"])[0]
    ones = F.aggregate(vector_to_array("leaf_one_hot"), F.lit(0.0), lambda a, v: a + v)
    assert out.select(ones.alias("n")).filter("n != 4").count() == 0


def test_joint_one_hot_sees_both_frames(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "u bigint, s string")
    b = spark.createDataFrame([(3, "y"), (1, "x")], "u bigint, s string")
    (one, two), dictionary = joint_one_hot(a, b, columns=["u", "s"])
    assert dictionary.sizes == {"u": 3, "s": 2}
    vectors = {tuple(r["one_hot"].toArray()) for r in one.unionAll(two).collect()}
    # u codes 0..2 plus NULL, then s codes 0..1 plus NULL
    assert vectors == {
        (1, 0, 0, 0, 1, 0, 0), (0, 1, 0, 0, 0, 0, 1), (0, 0, 1, 0, 0, 1, 0)}


def test_one_hot_vectors_do_not_pass_through_the_driver(spark):
    """They are as many as the rows, however small their files."""
    (coded,), _ = joint_one_hot(spark.range(0, 500).select((F.col("id") % 7).alias("u"), F.lit("x").alias("s")), columns=["u", "s"])
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and coded.count() == 500


def test_leaf_logistic_learns(planted):
    rows = planted.withColumn("group", F.col("noise") % 3)
    got = leaf_logistic(rows, rows, ["x"], ["group"], with_rounds(LEAF_TREES, 2), max_iter=30)
    scored = got.join(rows, "instance_id")
    assert scored.count() == 600 and log_loss(scored).first()[0] < baseline(planted)


def test_text_score_follows_the_words(planted):
    got = text_score(planted, planted, "text", "p", with_rounds(FIRST_LIBRARY, 5), keep=("instance_id", "is_trade"))
    means = {r[0]: r[1] for r in got.groupBy("is_trade").agg(F.avg("p")).collect()}
    assert means[1] > means[0] and got.count() == 600


def test_holdout_loss_is_the_loss_of_the_rows_held_out(spark, planted, monkeypatch):
    """The query returns what follows from the loss of both parts, and the plan the loss itself."""
    def loss(rows):
        return float(np.mean([-math.log(r["predicted_score"] if r["is_trade"] else 1 - r["predicted_score"]) for r in rows]))

    noisy = planted.withColumn("is_trade", F.expr("if(instance_id % 7 = 0, 1 - is_trade, is_trade)"))
    scored = {p: [r for r in holdout_scores(noisy, ["x"], QUICK).collect() if r["part"] == p] for p in ("rest", "held")}
    assert sorted(len(v) for v in scored.values()) == sorted([holdout(noisy)[0].count(), holdout(noisy)[1].count()])
    assert math.isclose(holdout_loss(noisy, ["x"], QUICK).first()["log_loss"], loss(scored["held"]), rel_tol=1e-9)
    monkeypatch.setattr(catalog_models, "model_frame", lambda spark, sf: (noisy, noisy, ["x"]))
    monkeypatch.setattr(catalog_models, "holdout_scores", lambda train, features: holdout_scores(train, features, QUICK))
    found = {r["part"]: r for r in catalog_models.m7(spark, "").collect()}
    assert {p: r["n_losses"] for p, r in found.items()} == {p: len(v) for p, v in scored.items()}
    assert all(r["loss_fits"] for r in found.values()) and found["held"]["base_loss"] is None
    assert math.isclose(found["rest"]["base_loss"], max(loss(scored["rest"]), baseline(holdout(noisy)[0])), abs_tol=1e-6)


def tfidf_by_hand(texts):
    import re

    docs = [re.findall(r"\b\w\w+\b", t.lower()) for t in texts]
    df = {w: sum(w in d for d in docs) for d in docs for w in d}
    out = {}
    for i, d in enumerate(docs):
        raw = {w: d.count(w) * (math.log((len(docs) + 1) / (df[w] + 1)) + 1) for w in set(d)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, w): v / norm for w, v in raw.items()})
    return out


def test_tfidf_table_and_vectors_agree_with_the_definition(spark):
    texts = ["Red;ring a", "red:widget,RING;ring", "élan_1;x", "", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = tfidf_by_hand(texts)
    for bound in (0, 1000):
        got = {(r["id"], r["term"]): r["weight"] for r in tfidf_table(docs, "text", ["id"], bound).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    split = docs.select("id", tokens_of("text").alias("tokens"))
    rows = fit_tfidf(split, "tokens", "v").transform(split).orderBy("id").collect()
    assert np.allclose([np.linalg.norm(r["v"].toArray()) for r in rows], [1, 1, 1, 0, 0])
    for i in range(3):
        assert np.allclose(sorted(rows[i]["v"].values), sorted(v for (k, _), v in want.items() if k == i))


def test_a_new_term_leaves_other_documents_as_they_were(spark):
    """The form of the vectors doesn't follow from the size of the vocabulary."""
    texts = ["red ring", "blue ring", ""]
    places = []
    for more in ("", " ".join(f"term{i}" for i in range(40))):
        split = spark.createDataFrame(list(enumerate([*texts, more])), "id int, text string").select("id", tokens_of("text").alias("tokens"))
        row = fit_tfidf(split, "tokens", "v").transform(split).where("id = 0").first()
        places.append((row["v"].size, row["v"].indices.tolist(), row["v"].values.round(9).tolist()))
    assert places[0] == places[1]


def test_prior_fit_matches_a_direct_iteration(spark):
    pairs = [(t, h) for t in range(0, 12) for h in range(0, t + 1) if (t * 7 + h * 3) % 4 == 0]
    counts = spark.createDataFrame(pairs, "t bigint, h bigint")

    def gain(n, a):
        return sum(1 / (a + k) for k in range(n))

    a = b = 1.0
    for _ in range(25):
        total = sum(gain(t, a + b) for t, _ in pairs)
        a, b = (a * sum(gain(h, a) for _, h in pairs) / total, b * sum(gain(t - h, b) for t, h in pairs) / total)
    fit = fit_beta_prior(counts, "t", "h", max_iter=25, tolerance=0.0)
    assert math.isclose(fit.alpha, a, rel_tol=1e-9) and math.isclose(fit.beta, b, rel_tol=1e-9)
    assert fit.iterations == 25 and not fit.converged


def test_prior_stops_and_keeps_the_last_values(spark):
    counts = spark.createDataFrame([(10, 0), (20, 15), (5, 5), (8, 0), (12, 1)], "t bigint, h bigint")
    fit = fit_beta_prior(counts, "t", "h", max_iter=100, tolerance=0.01)
    assert fit.converged and 1 < fit.iterations < 100


def test_prior_edge_cases(spark):
    counts = spark.createDataFrame([(None, None, 5, 0), (0, 0, 3, 0)], "t bigint, h bigint, t2 bigint, h2 bigint")
    fits = fit_beta_priors(counts, {"never": ("t", "h"), "no_hit": ("t2", "h2")}, max_iter=5)
    assert (fits["never"].alpha, fits["never"].beta) == (1.0, 1.0)
    assert fits["no_hit"].alpha == 0.0
    assert count_histograms(counts, {"never": ("t", "h")}).count() == 0


def test_trial_budget():
    assert [trial_budget(100, n) for n in ("auto", "sqrt", "log2", 0.2, 7)] == [10, 10, 6, 20, 7]
    assert trial_budget(1, "log2") == 1
    with pytest.raises(ValueError):
        trial_budget(10, "most")


def test_param_grid(spark):
    grid = param_grid(spark, {"depth": range(1, 4), "kind": ["a", "b"]})
    assert grid.count() == 6 and grid.distinct().count() == 6
    assert sample_trials(grid, 2).collect() == sample_trials(grid, 2).collect()


def test_search_finds_the_useful_setting(spark, planted):
    data = VectorAssembler(inputCols=["x", "noise"], outputCol="features").transform(planted).select(
        "instance_id", "features", F.col("is_trade").cast("double").alias("label"))
    space = {"regParam": [0.0, 0.01, 1.0, 10.0], "fitIntercept": [True, False]}
    got = Tuner.by_log_loss(LogisticRegression(maxIter=20), space, n_folds=2).search(data, "instance_id", 6, 2).collect()
    assert len(got) == 2 and all(r["score"] < 0 for r in got)
    assert got[0]["regParam"] < 10.0


def test_search_fits_once_a_fold_and_setting(spark, planted, monkeypatch):
    """The scores are the cross-validator's, without its last fit on all rows."""
    data = VectorAssembler(inputCols=["x", "noise"], outputCol="features").transform(planted).select(
        "instance_id", "features", F.col("is_trade").cast("double").alias("label"))
    tuner = Tuner.by_log_loss(LogisticRegression(maxIter=20), {"regParam": [0.0, 1.0]}, n_folds=3)
    folded = hash_folds(data, 3, "instance_id", salt="0", name="_fold")
    maps = [{tuner.estimator.regParam: r} for r in (0.0, 1.0)]
    want = CrossValidator(estimator=tuner.estimator, evaluator=tuner.evaluator, estimatorParamMaps=maps, numFolds=3, foldCol="_fold").fit(folded)
    fits = []
    fit = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    got = tuner.evaluate(data, param_grid(spark, tuner.space), "instance_id").orderBy("regParam").collect()
    assert np.allclose([-r["score"] for r in got], want.avgMetrics, rtol=1e-6) and len(fits) == 2 * 3
    with pytest.raises(ValueError, match="empty"):
        tuner.evaluate(data.limit(1), param_grid(spark, tuner.space), "instance_id")


def test_text_shares_stand_for_all_rows(spark):
    """A text's rows become a bounded number of weighted rows; none is lost, and empty and missing texts stay."""
    rows = spark.range(0, 1000).select(
        F.when(F.col("id") < 900, "a ring").when(F.col("id") < 990, "").alias("text"), (F.col("id") % 2).cast("double").alias("label"))
    got = text_shares(rows, "text", 7).collect()
    assert len(got) == 4 * 7 + 2 * 5 and sum(r["weight"] for r in got) == 1000
    assert {r["weight"] for r in got} == {65, 64, 7, 6, 1}
    ring = [r for r in got if r["_tokens"] == ["ring"] and r["label"] == 1.0]
    assert len(ring) == 7 and sum(r["weight"] for r in ring) == 450


def test_rows_of_one_text_weigh_as_many_in_the_idf(spark):
    texts = ["red ring"] * 40 + ["red bowl"] * 3 + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select(tokens_of("text").alias("t"))
    counted = docs.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    plain, weighted = fit_tfidf(docs, "t", "v", 64), fit_tfidf(counted, "t", "v", 64, weight="n")
    one, two = (m.stages[1].getScalingVec().toArray() for m in (plain, weighted))
    assert np.allclose(one, two, rtol=1e-12, atol=0)


def test_text_score_trains_on_few_rows_whatever_the_log(spark, monkeypatch):
    """The rows that every round passes over don't grow with the clicks of a text; the scores stay those of the rows."""
    seen = []
    fit = models.text_shares

    def counted(*args):
        seen.append(fit(*args))
        return seen[-1]

    monkeypatch.setattr(models, "text_shares", counted)
    rows = spark.range(0, 40_000).select(F.col("id").alias("instance_id"), F.expr("if(id % 4 = 0, 'red', 'blue')").alias("text"),
                                         F.expr("if(id % 4 = 0, id % 8 = 0, id % 8 = 1)").cast("int").alias("is_trade"))
    boosting = replace(FIRST_LIBRARY, maxIter=60, stepSize=0.5, subsamplingRate=1.0, featureSubsetStrategy="all")
    got = dict(text_score(rows, rows.limit(8), "text", "p", boosting, keep=("text",)).distinct().collect())
    assert seen[0].count() == 4 * models.SHARES
    # A half of the red rows and a sixth of the blue ones are bought.
    assert math.isclose(got["red"], 1 / 2, abs_tol=0.01) and math.isclose(got["blue"], 1 / 6, abs_tol=0.01)


def test_fits_use_all_cores(spark, planted, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "spread", lambda df: seen.append(df) or df)
    fit_boosted(planted, ["x", "noise"], with_rounds(FIRST_LIBRARY, 1))
    fit_leaf_embedding(planted, ["x"], with_rounds(LEAF_TREES, 1))
    assert [df.columns for df in seen] == [["x", "noise", "is_trade"], ["x", "is_trade"]]


def test_regression_passes_over_few_rows_in_few_tasks(spark, monkeypatch):
    """Thousands of passes follow; no row is lost, and many rows keep all cores."""
    seen, plain = [], models.packed
    rows = VectorAssembler(inputCols=["x"], outputCol="v").transform(spark.range(0, 300, 1, 3).selectExpr("id % 3 AS x", "cast(id % 2 AS int) AS is_trade"))
    rows = stage(rows)
    for rows_a_task, tasks in ((1 << 16, 1), (100, 3), (1, max(spark.sparkContext.defaultParallelism, len(rows.inputFiles())))):
        monkeypatch.setattr(models, "packed", lambda df: seen.append(plain(df, rows_a_task)) or seen[-1])
        models.fit_l1_logistic(rows, ["v"], max_iter=2)
        assert seen[-1].rdd.getNumPartitions() == tasks and seen[-1].count() == 300


def test_tfidf_moves_texts_once_and_no_single_terms(spark):
    """Ids that repeat or are null count as one document each; after the lists are stored no shuffle carries terms."""
    rows = [(1, "red ring"), (1, "ring ring"), (None, "red"), (None, "bowl bowl"), (2, None), (3, "")]
    got = tfidf_table(spark.createDataFrame(rows, "id int, text string"), "text", ["id"])
    assert {(r["id"], r["term"], r["tf"], r["df"]) for r in got.collect()} == {
        (1, "red", 1, 2), (1, "ring", 3, 1), (None, "red", 1, 2), (None, "bowl", 2, 1)}
    lengths = got.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0) for r in lengths)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and not any("Exchange hashpartitioning(term" in line for line in plan.splitlines())
