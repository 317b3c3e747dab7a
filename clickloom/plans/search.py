"""Parameter search: random trials, a surrogate regression over the full grid, a second look at its best."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import hash_unit
from clickloom.operators.indexing import hash_folds
from clickloom.operators.scores import top_n
from clickloom.sources.stage import spread, stage


def param_grid(spark: SparkSession, space: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the listed values, one row each."""
    grid = spark.range(1).drop("id")
    for name, values in space.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid


def trial_budget(size: int, n_iter: str | int | float = "auto") -> int:
    """Number of trials: ``auto``/``sqrt``, ``log2``, a fraction of the grid, or a number."""
    if isinstance(n_iter, str):
        rules = {"auto": math.sqrt, "sqrt": math.sqrt, "log2": math.log2}
        if n_iter not in rules:
            raise ValueError(f"trial budget must be a number or one of {sorted(rules)}, not {n_iter!r}")
        return max(1, int(rules[n_iter](size)))
    if 0 < n_iter < 1:
        return max(1, int(n_iter * size))
    return min(int(n_iter), size)


def sample_trials(grid: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in seeded random order, the same ones on every run."""
    return grid.orderBy(hash_unit(*grid.columns, salt=str(seed)), *grid.columns).limit(n)


@dataclass(frozen=True)
class Tuner:
    """Search over parameters of ``estimator``, scored by k-fold cross-validation."""

    estimator: Estimator
    evaluator: Evaluator
    space: Mapping[str, Sequence]
    n_folds: int = 3
    parallelism: int = 2
    seed: int = 0

    @classmethod
    def by_log_loss(cls, estimator: Estimator, space: Mapping[str, Sequence], label: str = "label", **kwargs) -> Tuner:
        return cls(estimator, MulticlassClassificationEvaluator(metricName="logLoss", labelCol=label), space, **kwargs)

    def evaluate(self, data: DataFrame, trials: DataFrame, id_col: str) -> DataFrame:
        """Mean k-fold score of every trial row. Scores are negated where less is better."""
        rows = trials.collect()  # a handful of parameter settings
        maps = [{self.estimator.getParam(k): v for k, v in r.asDict().items()} for r in rows]
        folded = stage(hash_folds(spread(data), self.n_folds, id_col, salt=str(self.seed), name="_fold"), "folds")
        sizes = folded.groupBy("_fold").count().count()  # at most one row a fold
        if sizes < self.n_folds:
            raise ValueError(f"{self.n_folds - sizes} of {self.n_folds} folds are empty")

        def loss(job: tuple[int, dict]) -> float:
            fold, settings = job
            model = self.estimator.fit(folded.where(F.col("_fold") != fold), settings)
            return self.evaluator.evaluate(model.transform(folded.where(F.col("_fold") == fold), settings))

        # One fit a fold and setting: CrossValidator would fit its best setting once more, on all rows, for a model that no
        # one asks for here.
        with ThreadPoolExecutor(max_workers=self.parallelism) as pool:
            losses = list(pool.map(loss, [(k, m) for m in maps for k in range(self.n_folds)]))
        sign = 1.0 if self.evaluator.isLargerBetter() else -1.0
        means = [sum(losses[i : i + self.n_folds]) / self.n_folds for i in range(0, len(losses), self.n_folds)]
        scored = [(*r, float(sign * m)) for r, m in zip(rows, means)]
        return data.sparkSession.createDataFrame(scored, trials.schema.add("score", "double"))

    def random_trials(self, data: DataFrame, id_col: str, n_iter: str | int | float = "auto") -> DataFrame:
        grid = param_grid(data.sparkSession, self.space)
        budget = trial_budget(math.prod(len(v) for v in self.space.values()), n_iter)
        return self.evaluate(data, sample_trials(grid, budget, self.seed), id_col)

    def search(self, data: DataFrame, id_col: str, n_iter: str | int | float = "auto", n_top: int = 3) -> DataFrame:
        """Random trials, surrogate scores of the whole grid, cross-validated scores of its best rows."""
        trials = self.random_trials(data, id_col, n_iter)
        grid = param_grid(data.sparkSession, self.space)
        best = stage(top_n(surrogate_scores(trials, grid), n_top, "pred_score", *grid.columns), "best")
        checked = self.evaluate(data, best.select(*grid.columns), id_col)
        return best.join(checked, list(grid.columns)).orderBy(F.desc("pred_score"), *grid.columns)


def surrogate_scores(trials: DataFrame, grid: DataFrame) -> DataFrame:
    """Linear regression of the score on the parameters, applied to the grid; texts are indexed."""
    stages, inputs = [], []
    for name, kind in grid.dtypes:
        if kind == "string":
            stages.append(StringIndexer(inputCol=name, outputCol=f"_{name}", handleInvalid="keep").fit(
                grid.select(name).unionAll(trials.select(name))))
        else:
            grid, trials = (df.withColumn(f"_{name}", F.col(name).cast("double")) for df in (grid, trials))
        inputs.append(f"_{name}")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_params"))
    stages.append(LinearRegression(featuresCol="_params", labelCol="score", predictionCol="pred_score"))
    model = Pipeline(stages=stages).fit(trials)
    return model.transform(grid).drop("_params", *inputs)
