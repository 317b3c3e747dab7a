from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.operators import models
from clickloom.operators.ensembles import Rounds, best_round, fit_with_patience, node_table, split_importances, watch_metrics
from clickloom.operators.models import FIRST_LIBRARY, fit_boosted, fit_l1_logistic, l1_penalty, score, text_score
from clickloom.operators.scores import area_under_roc, log_loss
from clickloom.operators.sparse_logistic import SparseLogistic, cells_of, fit_l1_places, optimality
from clickloom.plans.stacking import LeafLogistic
from clickloom.sources import stage

QUICK = replace(FIRST_LIBRARY, maxIter=5, subsamplingRate=1.0)
FEATURES = ["x", "z"]


@pytest.fixture(scope="module")
def clicks(spark):
    df = spark.range(0, 600, 1, 3).select(
        F.col("id").alias("instance_id"), (F.col("id") % 10).alias("x"), (F.col("id") * 37 % 101).alias("z"),
        (F.col("id") * 7919 % 97 < F.col("id") % 10 * 9).cast("int").alias("is_trade"))
    return stage(df)


@pytest.fixture(scope="module")
def model(clicks):
    return fit_boosted(clicks, FEATURES, QUICK)


def test_nodes_and_splits(spark, clicks, model):
    nodes = stage(node_table(model, FEATURES))
    trees = model.stages[-1].trees
    per_tree = {r["tree"]: r for r in nodes.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.expr("if(node = 0, cover, 0)")).alias("root"),
        F.sum(F.expr("if(leaf IS NULL, 0, cover)")).alias("leaves")).collect()}
    assert [per_tree[i]["n"] for i in range(5)] == [t.numNodes for t in trees]
    assert all(r["root"] == r["leaves"] == 600 for r in per_tree.values())
    found = {r["feature"]: r for r in split_importances(nodes, [*FEATURES, "never"]).collect()}
    assert found["x"]["weight"] + found["z"]["weight"] == sum((t.numNodes - 1) // 2 for t in trees)
    text = "".join(t.toDebugString for t in trees)
    assert found["x"]["weight"] == text.count("If (feature 0") and tuple(found["never"])[1:] == (0, 0.0, 0.0)


def test_metrics_of_all_rounds_equal_refits(clicks, model):
    rounds = Rounds.of(model, FEATURES)
    got = {r["round"]: r for r in watch_metrics(rounds, {"a": clicks, "none": clicks.limit(0)}, bins=1 << 14).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and {r["set"] for r in got.values()} == {"a"}
    for n in (1, 4):
        again = score(fit_boosted(clicks, FEATURES, replace(QUICK, maxIter=n)), clicks, FEATURES, ("instance_id", "is_trade"))
        assert got[n]["log_loss"] == pytest.approx(log_loss(again).first()[0], abs=1e-12)
        assert got[n]["auc"] == pytest.approx(area_under_roc(again), abs=1e-4) and got[n]["n_rows"] == 600
        mine = rounds.score(clicks, n).withColumnRenamed("predicted_score", "q").join(again, "instance_id")
        assert mine.agg(F.max(F.abs(F.col("q") - F.col("predicted_score")))).first()[0] < 1e-12


def test_best_round():
    assert best_round([5, 4, 3, 3, 4], 2) == 3
    assert best_round([5, 4, 6, 6, 1], 2) == 2 and best_round([5, 4, 6, 6, 1], 3) == 5
    assert best_round([1.0], 100) == 1


def test_patience_cuts_where_a_shorter_fit_is_best(clicks):
    """Against refits of every length on a validation set whose labels contradict the training rows."""
    valid = clicks.where("instance_id % 3 = 0").withColumn("is_trade", F.expr("if(z % 2 = 0, 1 - is_trade, is_trade)"))
    found = fit_with_patience(clicks, valid, FEATURES, QUICK, patience=100)
    losses = [log_loss(score(fit_boosted(clicks, FEATURES, replace(QUICK, maxIter=n)), valid, FEATURES, ("instance_id", "is_trade"))).first()[0]
              for n in range(1, 6)]
    assert found.best == int(np.argmin(losses)) + 1
    assert log_loss(found.score(valid, ("instance_id", "is_trade"))).first()[0] == pytest.approx(min(losses), abs=1e-12)


def test_occupied_places_leave_the_model_as_it_was(clicks, monkeypatch):
    text = F.concat_ws(";", F.concat(F.lit("word"), F.col("x")), F.concat(F.lit("z"), F.col("z") % 7))
    rows = clicks.withColumn("text", text)
    new = rows.where("x < 3").withColumn("text", F.concat("text", F.lit(";unseen")))
    settings = replace(QUICK, featureSubsetStrategy="all")
    narrow = text_score(rows, new, "text", "p", settings)
    monkeypatch.setattr(models, "occupied_places", lambda *a: None)
    wide = text_score(rows, new, "text", "q", settings)
    assert narrow.join(wide, "instance_id").where("abs(p - q) > 1e-12").count() == 0 and narrow.count() == wide.count() == 180


def test_occupied_places_are_coded_in_order(spark):
    from clickloom.operators.text import occupied_places, tokens_of

    docs = spark.createDataFrame([("a1 b2 c3",), ("b2",), ("",), (None,)], "text string").select(tokens_of("text").alias("t"))
    got = [tuple(r) for r in occupied_places(docs, "t", 64).orderBy("code").collect()]
    assert [c for _, c in got] == list(range(len(got))) and got == sorted(got) and 1 <= len(got) <= 3
    assert occupied_places(docs.limit(0), "t", 64).count() == 0


@pytest.fixture(scope="module")
def sparse(spark):
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4) * 1.0
    x[:, 5] = rng.random(300)
    y = rng.random(300) < 1 / (1 + np.exp(-(x @ np.array([2, -1.5, 0, 0, 1, 0]) - 0.5)))
    rows = [(i, int(y[i]), Vectors.dense(x[i, :3]), Vectors.sparse(3, [(j, x[i, 3 + j]) for j in range(3) if x[i, 3 + j]])) for i in range(300)]
    return spark.createDataFrame(rows, ["instance_id", "is_trade", "a", "b"]).cache()


def test_l1_in_a_table_reaches_the_optimum(spark, sparse):
    """The weights equal those of the regression whose weights lie on the driver, and both pass the optimality check."""
    penalty = l1_penalty(sparse, 0.1)
    want = fit_l1_logistic(sparse, ["a", "b"], 0.1, 500, 1e-12).stages[-1]
    rows, cells = sparse.selectExpr("instance_id AS row", "is_trade AS label"), stage(cells_of(sparse, "instance_id", "a", "b"))
    assert cells.groupBy("place").count().count() == 6
    fit = fit_l1_places(rows, cells, penalty, 60, 1e-5)
    got = np.zeros(6)
    for r in fit.weights.collect():
        got[r["place"]] = r["weight"]
    assert np.allclose(got, want.coefficients.toArray(), atol=1e-3) and fit.intercept == pytest.approx(want.intercept, abs=1e-3)
    assert optimality(rows, cells, fit).agg(F.max("residual")).first()[0] < 1e-4
    off = SparseLogistic(fit.weights.withColumn("weight", F.col("weight") * 1.5), fit.intercept, penalty, 0, 0.0)
    assert optimality(rows, cells, off).agg(F.max("residual")).first()[0] > 0.1 * penalty


def test_certificate_meets_cells_where_their_rows_lie(spark, sparse, monkeypatch):
    """The gradients of a brute-force sum, off one copy of the weights and without a join of cells and rows."""
    trained = fit_l1_logistic(sparse, ["a", "b"], 0.1, 500, 1e-12)
    asked, weights = [], type(trained.stages[-1]).coefficients
    monkeypatch.setattr(type(trained.stages[-1]), "coefficients", property(lambda m: asked.append(1) or weights.fget(m)))
    found = LeafLogistic(trained, sparse, sparse, ("a", "b")).certificate(0.1)
    assert len(asked) == 1
    # The one join left is that with the weights.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    data = sparse.select("is_trade", "a", "b").collect()
    x = np.array([[*r["a"].toArray(), *r["b"].toArray()] for r in data])
    beta, free = weights.fget(trained.stages[-1]).toArray(), trained.stages[-1].intercept
    error = 1 / (1 + np.exp(-(x @ beta + free))) - np.array([r["is_trade"] for r in data])
    rows = {r["place"]: r for r in found.collect()}
    assert sorted(rows) == list(range(-1, 6))
    for place, gradient in [(-1, error.mean()), *enumerate(x.T @ error / len(data))]:
        assert rows[place]["gradient"] == pytest.approx(gradient, abs=1e-9)
        assert rows[place]["weight"] == pytest.approx(free if place < 0 else beta[place])
    assert max(r["residual"] for r in rows.values()) < 1e-4


def test_l1_without_rows(spark, sparse):
    fit = fit_l1_places(sparse.limit(0).selectExpr("instance_id AS row", "is_trade AS label"), cells_of(sparse, "instance_id", "a").limit(0), 0.1)
    assert fit.weights.count() == 0 and fit.intercept == 0.0
