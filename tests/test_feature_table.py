import datetime as dt
import sys

from pyspark.sql import functions as F

from clickloom.operators.features import JoinPolicy
from clickloom.plans.feature_table import DEFAULT_TEXT_MODELS, RAW_LISTS, feature_table
from clickloom.plans.prepare import prepare_log
from clickloom.plans.slices import TimeSlice
from clickloom.operators.models import with_rounds
from clickloom.sources import click_log, stage

module = sys.modules[feature_table.__module__]
SLICES = (TimeSlice(2, dt.date(2024, 1, 24), 5), TimeSlice(3, dt.date(2024, 1, 25), 5))


def test_feature_table_with_text_scores_and_copies(spark, sf_dir):
    log = click_log(spark, sf_dir, dt.date(2024, 1, 18), dt.date(2024, 1, 26))
    copied = log.filter(F.col("context_timestamp") % 2 == 0)
    prepared = stage(prepare_log(log.unionAll(copied)), "log")
    models = {text: with_rounds(b, 1) for text, b in DEFAULT_TEXT_MODELS.items()}
    table = stage(feature_table(prepared, SLICES, text_models=models), "table")

    label_ids = {r[0] for r in prepared.filter("day IN (24, 25)").select("instance_id").collect()}
    ids = [r[0] for r in table.select("instance_id").collect()]
    assert sorted(ids) == sorted(label_ids)
    assert not set(RAW_LISTS) & set(table.columns)
    # 72 counts and rates, 12 positions and gaps, one re-click count, two text scores.
    assert len(table.columns) == len(prepared.columns) - len(RAW_LISTS) + 1 + 72 + 12 + 1 + 2
    assert table.filter("property_prob IS NULL OR predict_prob IS NULL").count() == 0
    assert table.filter("this_day_user_constant_click_times < 1").count() == 0
    # Copies count as clicks of the day, but are no second click of their own.
    doubled = table.filter("context_timestamp % 2 = 0 AND maybe = 0")
    assert doubled.count() > 0 and doubled.filter("this_day_user_click_same_item_times < 2").count() == 0
    rates = [c for c in table.columns if c.endswith("_rate") or c.endswith("_quality") or c.endswith("_prob")]
    assert table.filter(" OR ".join(f"{c} NOT BETWEEN 0 AND 1" for c in rates)).count() == 0


def test_families_share_one_broadcast_budget(spark, sf_dir, monkeypatch):
    """What all families together may broadcast passes through one driver."""
    prepared = stage(prepare_log(click_log(spark, sf_dir, dt.date(2024, 1, 24), dt.date(2024, 1, 25))), "log")
    seen = []

    def no_features(labels, source, family, carry, policy, **_):
        seen.append(policy.total_broadcast_bytes)
        return labels.select(*carry)

    monkeypatch.setattr(module, "family_table", no_features)
    feature_table(prepared, SLICES[:1])
    assert len(seen) == 4 and sum(seen) <= JoinPolicy().total_broadcast_bytes


def test_label_days_of_a_log_by_time_use_all_cores(spark, sf_dir, monkeypatch):
    """They lie in one file of the log; the rows that all families join lie in as many files as there are cores."""
    log = prepare_log(click_log(spark, sf_dir, dt.date(2024, 1, 18), dt.date(2024, 1, 26)))
    prepared = stage(log.repartitionByRange(16, "context_timestamp"), "log")
    cores = spark.sparkContext.defaultParallelism
    assert len(prepared.inputFiles()) >= cores
    seen = []

    def no_features(labels, source, family, carry, **_):
        seen.append(labels)
        return labels.select(*carry)

    monkeypatch.setattr(module, "family_table", no_features)
    found = feature_table(prepared, SLICES)
    assert min(len(labels.inputFiles()) for labels in seen) >= cores
    assert found.select("instance_id").exceptAll(prepared.where("day IN (24, 25)").select("instance_id")).isEmpty()
