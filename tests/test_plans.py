"""The plans we rely on at scale: pushed filters, pruned columns and partitions, no needless shuffle."""

import datetime as dt
import re

from catalog.registry import RATES, SLICES, prepared, sliced
from clickloom.operators.features import JoinPolicy, family_table
from clickloom.plans import specs
from clickloom.plans.slices import history_rows, label_rows
from clickloom.sources import click_log, stage


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_time_bounds_and_columns_reach_the_scan(spark, sf_dir):
    df = click_log(spark, sf_dir, dt.date(2024, 1, 20), dt.date(2024, 1, 26)).select("instance_id", "context_timestamp")
    text = formatted(df)
    scan = text[text.index("events.parquet"):]
    assert "GreaterThanOrEqual(ts,2024-01-20T00:00)" in scan and "LessThan(ts,2024-01-26T00:00)" in scan
    schema = re.search(r"ReadSchema: (.*)", scan).group(1)
    assert "event_type" not in schema and "value" not in schema


def test_slices_prune_partitions(spark, sf_dir):
    log = prepared(spark, sf_dir).select("instance_id", "user_id", "is_trade", "event_date")
    stored = stage(log.coalesce(1), "log", ("event_date",))
    for df in (label_rows(stored, SLICES), history_rows(stored, SLICES[1:])):
        filters = re.search(r"PartitionFilters: \[(.*?)\],? ?(PushedFilters|\n)", formatted(df)).group(1)
        assert "event_date" in filters


def test_small_lookups_do_not_shuffle_the_rows(spark, sf_dir):
    labels, history = sliced(spark, sf_dir, specs.THREE_KEY.keys)
    plan = plan_of(family_table(labels, history, specs.THREE_KEY))
    assert plan.count("BroadcastHashJoin") == 16
    # One scan with grouping sets feeds all lookups, and it is stored: no exchange but the broadcasts is left.
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_large_lookups_join_by_shuffle(spark, sf_dir):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    labels, history = sliced(spark, sf_dir, RATES.keys)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(family_table(labels, history, RATES, policy=JoinPolicy(broadcast_bytes=0)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Lookups are stored before they are joined, so that hot keys can be split: no aggregate is left in the plan.
    assert plan.count("SortMergeJoin") == 3 and "Aggregate" not in plan and "BroadcastHashJoin" not in plan


def test_no_python_and_no_cross_join_in_the_features(spark, sf_dir):
    labels, history = sliced(spark, sf_dir, specs.TWO_KEY.keys)
    plan = plan_of(family_table(labels, history, specs.TWO_KEY))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
