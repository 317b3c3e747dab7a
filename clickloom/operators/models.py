"""Boosted trees, leaf embeddings and sparse logistic regression on feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clickloom.operators.indexing import Dictionary, encode, fit_dictionary
from clickloom.operators.sizing import shuffled_join
from clickloom.operators.text import fit_tfidf, occupied_places, tokens_of
from clickloom.sources.stage import packed, shared_folder, spread, stage

LABEL, ID, SCORE = "is_trade", "instance_id", "predicted_score"

# The categorical columns that are one-hot encoded together.
CATEGORICAL = (
    "item_id", "context_id", "shop_id", "last_category_id", "item_brand_id", "item_city_id", "user_gender_id",
    "user_occupation_id", "context_page_id", "item_price_level", "item_sales_level", "item_collected_level",
    "item_pv_level", "user_age_level", "user_star_level", "shop_review_num_level", "shop_star_level",
)


@dataclass(frozen=True)
class Boosting:
    """Boosted-tree settings. Rounds times rate are the original's; rounds are few and steps long, as every round costs
    ``maxDepth`` jobs."""

    maxIter: int = 120
    maxDepth: int = 4
    stepSize: float = 0.1
    subsamplingRate: float = 0.7
    featureSubsetStrategy: str = "0.7"
    seed: int = 0

    def classifier(self, features: str = "features", label: str = "label", **extra) -> GBTClassifier:
        return GBTClassifier(
            featuresCol=features, labelCol=label, checkpointInterval=10, maxMemoryInMB=1024, **asdict(self), **extra
        )


# The two library settings of the first stacking level, and the three special-purpose ones.
FIRST_LIBRARY = Boosting()
SECOND_LIBRARY = Boosting(maxDepth=5, subsamplingRate=0.8, featureSubsetStrategy="0.3", seed=1)
# The same settings in a fifth of the rounds of five times the rate, for plans that fit many models.
FIRST_MANY = replace(FIRST_LIBRARY, maxIter=24, stepSize=0.5)
SECOND_MANY = replace(SECOND_LIBRARY, maxIter=24, stepSize=0.5)
LEAF_TREES = Boosting(maxIter=13, maxDepth=3, stepSize=0.01, subsamplingRate=1.0, featureSubsetStrategy="all")
PROPERTY_TEXT = Boosting(maxIter=200, stepSize=0.2, subsamplingRate=0.8, featureSubsetStrategy="all")
PREDICT_TEXT = Boosting(maxIter=200, subsamplingRate=0.8, featureSubsetStrategy="0.3", seed=2018)
PROPERTY_TEXT_MANY = replace(PROPERTY_TEXT, maxIter=40, stepSize=1.0)
PREDICT_TEXT_MANY = replace(PREDICT_TEXT, maxIter=40, stepSize=0.5)

# Most weighted rows that stand for the history rows of one text and label.
SHARES = 256


def positive(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def feature_columns(df: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    """Numeric columns without ids, times, the label and anything in ``drop``."""
    never = {ID, "user_id", LABEL, "context_timestamp", "slice", "row_id", "fold", *drop}
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [name for name, kind in df.dtypes if kind in numeric and name not in never]


def model_input(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Fill missing features with 0 and add the label as a double."""
    filled = df.na.fill(0, subset=list(features))
    return filled.withColumn("label", F.col(LABEL).cast("double")) if LABEL in df.columns else filled


def training_rows(df: DataFrame, features: Sequence[str], *more: str) -> DataFrame:
    """What a fit reads, on all cores: a table of few files would bind every round to as many tasks."""
    return model_input(spread(df.select(*dict.fromkeys([*features, LABEL, *more]))), features)


def fit_boosted(df: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY) -> PipelineModel:
    shared_folder(df.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, boosting.classifier()]).fit(training_rows(df, features))


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str] = (ID,)) -> DataFrame:
    scored = model.transform(model_input(df, features))
    return scored.select(*keep, positive().alias(SCORE))


def fit_with_validation(
    train: DataFrame, valid: DataFrame, features: Sequence[str], boosting: Boosting = FIRST_LIBRARY,
    tolerance: float = 0.001,
) -> PipelineModel:
    """Fit on the earlier label day and stop once the loss on the later one no longer improves."""
    shared_folder(train.sparkSession)
    both = train.withColumn("_valid", F.lit(False)).unionByName(
        valid.withColumn("_valid", F.lit(True)), allowMissingColumns=True
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = boosting.classifier(validationIndicatorCol="_valid", validationTol=tolerance)
    return Pipeline(stages=[assembler, trees]).fit(training_rows(both, features, "_valid"))


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance), one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_features(model: PipelineModel, features: Sequence[str], k: int = 104) -> list[str]:
    weights = model.stages[-1].featureImportances.toArray()
    return [name for _, name in sorted(zip(-weights, features))[:k]]


def text_score(
    history: DataFrame, label_rows: DataFrame, text: str, name: str, boosting: Boosting,
    keep: Sequence[str] = (ID,), label: str = LABEL, width: int = 1 << 14,
) -> DataFrame:
    """Conversion probability of a text: trees fitted on the history, applied to the label rows.

    The idf comes from both tables, labels only from the history; ``width`` is that of the hashed vectors. The trees see
    the places that some history text occupies: no other can split, so with all features in every tree the model is the
    one of the full width, and a share of the features is a share of those that occur. History rows of one text and label
    are at most ``SHARES`` weighted rows (see ``text_shares``), as every round passes over all of them.
    """
    tokens = tokens_of(text).alias("_tokens")
    # Texts are split once; the passes of the vectoriser and of the trees read the stored tokens.
    past = text_shares(history.select(text, F.col(label).cast("double").alias("label")), text)
    now = stage(spread(label_rows.select(*keep, text)).select(*keep, tokens), "text")
    places = occupied_places(past, "_tokens", width)
    counted = past.select("_tokens", "weight").unionAll(now.select("_tokens", F.lit(1).cast("long")))
    vectors = fit_tfidf(counted, "_tokens", "features", width, places, weight="weight")
    shared_folder(history.sparkSession)
    trees = boosting.classifier(weightCol="weight").fit(vectors.transform(past).select("features", "label", "weight"))
    return trees.transform(vectors.transform(now)).select(*keep, positive().alias(name))


def text_shares(rows: DataFrame, text: str, shares: int = SHARES) -> DataFrame:
    """Stored (_tokens, label, weight): the rows of one text and label as at most ``shares`` rows of nearly equal weight.

    Weights add up to the rows, so sums over them are those over the rows. A round's random sample takes or leaves a
    share as a whole; up to ``shares`` rows of a text and label every share is one row.
    """
    counted = stage(rows.groupBy(text, "label").agg(F.count(F.lit(1)).alias("_n")), "texts")
    parts = F.expr(f"explode(sequence(0L, least(_n, {shares}L) - 1))").alias("_part")
    split = spread(counted).select(tokens_of(text).alias("_tokens"), "label", "_n", parts)
    weight = F.expr(f"_n div least(_n, {shares}L) + if(_part < _n % least(_n, {shares}L), 1, 0)").alias("weight")
    # Dealt out anew: the shares of a frequent text lie in one partition of its group.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return stage(split.select("_tokens", "label", weight).repartition(max(cores, len(counted.inputFiles()))), "text")


def joint_one_hot(
    *frames: DataFrame, columns: Sequence[str] = CATEGORICAL, output: str = "one_hot"
) -> tuple[list[DataFrame], Dictionary]:
    """One-hot vectors over the values of all frames together; each frame gets ``output``.

    Codes come from a distributed dictionary. A column's codes are shifted by the sizes of the columns before it, and a
    row's places make up its sparse vector directly, so neither the driver nor a schema ever holds a list of values.
    Only (row, categorical columns) goes through the dictionary joins. A model with one weight per place still holds
    the whole width on the driver.
    """
    narrow = [frame.select(*columns) for frame in frames]
    united = narrow[0]
    for frame in narrow[1:]:
        united = united.unionAll(frame)
    dictionary = fit_dictionary(united, columns)
    # NULL is a category of its own, after all others.
    starts, width = {}, 0
    for c in columns:
        starts[c], width = width, width + dictionary.sizes[c] + 1
    if width > (1 << 31) - 1:
        raise ValueError(f"{width} values do not fit a vector; encode fewer columns, or hash their values first")
    codes = {c: f"_oh_{c}" for c in columns}
    places = F.array(*[F.expr(f"cast(coalesce({codes[c]}, {dictionary.sizes[c]}) + {starts[c]} AS int)") for c in columns])

    def coded(df: DataFrame) -> DataFrame:
        rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "one-hot")
        found = encode(rows.select("_row", *columns), dictionary, codes)
        vectors = found.select(F.col("_row").alias("_coded"), sparse_ones(places, width).alias(output))
        return rows.join(shuffled_join(stage(vectors, "one-hot")), F.expr("_row = _coded")).drop("_row", "_coded")

    return [coded(f) for f in frames], dictionary


def sparse_ones(places: Column, width: int) -> Column:
    """Sparse vector with 1.0 at the given ascending places; its column carries no metadata."""
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(width).alias("size"), places.alias("indices"),
        F.transform(places, lambda _: F.lit(1.0)).alias("values"),
    )
    text = F.to_json(F.struct(parts.alias("v")))
    return F.from_json(text, StructType([StructField("v", VectorUDT())]))["v"]


def fit_leaf_embedding(
    df: DataFrame, features: Sequence[str], boosting: Boosting = LEAF_TREES, output: str = "leaves"
) -> PipelineModel:
    """Trees that output, besides a score, the leaf each row falls into, one per tree."""
    shared_folder(df.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, boosting.classifier(leafCol=output)]).fit(training_rows(df, features))


def one_hot_leaves(
    model: PipelineModel, frames: Sequence[DataFrame], features: Sequence[str], leaves: str = "leaves",
    output: str = "leaf_one_hot",
) -> list[DataFrame]:
    """One-hot of every tree's leaf; sizes come from the model, so unseen leaves have their place."""
    trees = model.stages[-1].trees
    columns = [f"_leaf_{i}" for i in range(len(trees))]

    def spread(df: DataFrame) -> DataFrame:
        scored = model.transform(model_input(df, features)).drop("rawPrediction", "probability", "prediction")
        leaf = vector_to_array(F.col(leaves))
        return scored.withColumns({c: leaf[i] for i, c in enumerate(columns)})

    # Leaves are numbered 0..n-1 within a tree of n leaves; a tree of m nodes has (m + 1) / 2.
    spark = frames[0].sparkSession
    widest = spark.createDataFrame(
        [tuple(float((t.numNodes + 1) // 2 - 1) for t in trees)], ", ".join(f"{c} double" for c in columns)
    )
    encoder = OneHotEncoder(inputCols=columns, outputCols=[f"{c}_v" for c in columns], dropLast=False).fit(widest)
    assembler = VectorAssembler(inputCols=[f"{c}_v" for c in columns], outputCol=output)
    drop = [*columns, *[f"{c}_v" for c in columns], "features"]
    return [assembler.transform(encoder.transform(spread(f))).drop(*drop) for f in frames]


def l1_penalty(df: DataFrame, c: float = 3.0) -> float:
    """``c`` weighs the summed loss, Spark's penalty weighs the mean loss."""
    return 1.0 / (c * max(df.count(), 1))


def fit_l1_logistic(
    df: DataFrame, vectors: Sequence[str], c: float = 3.0, max_iter: int = 100, tolerance: float = 1e-6
) -> PipelineModel:
    """L1 logistic regression with all weights on the driver; ``sparse_logistic`` has the one that keeps them in a table."""
    logistic = LogisticRegression(
        featuresCol="inputs", labelCol="label", elasticNetParam=1.0, regParam=l1_penalty(df, c),
        standardization=False, maxIter=max_iter, tol=tolerance,
    )
    assembler = VectorAssembler(inputCols=list(vectors), outputCol="inputs")
    # Each step is some three passes over all rows.
    labelled = packed(df.select(*vectors, F.col(LABEL).cast("double").alias("label")))
    return Pipeline(stages=[assembler, logistic]).fit(labelled)


def with_rounds(boosting: Boosting, rounds: int) -> Boosting:
    return replace(boosting, maxIter=rounds)
