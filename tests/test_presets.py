"""Settings that the model queries fit with, and the table that they fit on."""

import pytest
from pyspark.sql import functions as F

from catalog import models
from clickloom.operators.models import (
    FIRST_LIBRARY, FIRST_MANY, PREDICT_TEXT, PREDICT_TEXT_MANY, PROPERTY_TEXT, PROPERTY_TEXT_MANY, SECOND_LIBRARY,
    SECOND_MANY, feature_columns,
)
from clickloom.plans import feature_table as feature_table_plan
from clickloom.plans.feature_table import TEXT_SCORES


@pytest.mark.parametrize("many, preset", [
    (FIRST_MANY, FIRST_LIBRARY), (SECOND_MANY, SECOND_LIBRARY), (PROPERTY_TEXT_MANY, PROPERTY_TEXT), (PREDICT_TEXT_MANY, PREDICT_TEXT),
])
def test_short_settings_keep_rounds_times_rate(many, preset):
    assert many.maxIter * many.stepSize == pytest.approx(preset.maxIter * preset.stepSize)
    assert (many.maxDepth, many.subsamplingRate, many.featureSubsetStrategy) == (preset.maxDepth, preset.subsamplingRate, preset.featureSubsetStrategy)


def test_search_has_the_rounds_of_the_short_setting():
    assert models.tuner().estimator.getMaxIter() == FIRST_MANY.maxIter


def test_models_share_one_whole_feature_table(spark, sf_dir, monkeypatch, tmp_path):
    """Every feature of the table reaches the fits, in all slices, and the table is built once. Text scores are stood in
    for: their fits take long."""
    from clickloom.sources import store

    built = []

    def constant(labels, history, slices, text, name, boosting, keep=("row_id",)):
        built.append(text)
        return labels.select(*keep, F.lit(0.5).alias(name))

    monkeypatch.setattr(store, "store_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(feature_table_plan, "text_score_table", constant)
    train, test, features = models.model_frame(spark, sf_dir)
    again = models.whole_table(spark, sf_dir)
    assert sorted(built) == sorted(TEXT_SCORES) and again.inputFiles() == models.whole_table(spark, sf_dir).inputFiles()
    assert features == feature_columns(again) and {*TEXT_SCORES.values(), "user_transfer_rate", "hour"} <= set(features) and len(features) > 100
    assert train.count() + test.count() == models.sliced(spark, sf_dir, ["user_id"])[0].count()
