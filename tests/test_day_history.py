import datetime as dt

import pytest
from pyspark.sql import functions as F

from check_oracles import normal, spark_rows
from clickloom.operators.features import Conversion, Family, JoinPolicy, Measure, family_table
from clickloom.plans import specs
from clickloom.plans.day_history import day_family_table, day_history
from clickloom.plans.feature_table import feature_table
from clickloom.plans.prepare import prepare_log
from clickloom.plans.slices import TimeSlice, history_rows, label_rows
from clickloom.sources import click_log, stage

SLICES = (TimeSlice(1, dt.date(2024, 1, 23)), TimeSlice(2, dt.date(2024, 1, 24), 5), TimeSlice(3, dt.date(2024, 1, 25), 2))
SHARES = specs.shop_share(distinct=True)
RATES = Family.of_conversions("rates", (
    Conversion((specs.USER,), "user_click_total_times", "user_buy_times", "user_transfer_rate", specs.USER_PRIOR),
    Conversion((specs.GENDER, specs.LAST_CATEGORY), "pair_clicks", "pair_buys", "pair_rate", hits="ones"),
))
FAMILIES = (RATES, specs.DAILY_AVERAGE, SHARES)
# All grains from one scan and all lookups broadcast; none of either; as sizes have it.
POLICIES = {
    "one scan": JoinPolicy(rollup_ratio=1e9, broadcast_bytes=1 << 30, total_broadcast_bytes=1 << 36),
    "own scans": JoinPolicy(rollup_ratio=0.0, broadcast_bytes=0),
    "by size": JoinPolicy(),
}


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return stage(prepare_log(click_log(spark, sf_dir, until=dt.date(2024, 1, 26))), "log")


@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES)
def test_same_rows_as_the_tagged_log(log, policy):
    labels, days = label_rows(log, SLICES), day_history(log, FAMILIES, policy)
    for family in FAMILIES:
        got = day_family_table(labels, days, family, SLICES, keep_counts=True, policy=policy)
        want = family_table(labels, history_rows(log, SLICES), family, keep_counts=True)
        assert normal(spark_rows(got)).equals(normal(spark_rows(want)))


def test_further_slice_reads_no_log(log):
    days = day_history(log, FAMILIES)
    read = set(log.inputFiles())
    further = (TimeSlice(9, dt.date(2024, 1, 20), 3),)
    for table in days.tables.values():
        rows = history_rows(table, further)
        assert rows.inputFiles() and not read & set(rows.inputFiles())
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert {r[0] for r in rows.select("event_date").distinct().collect()} <= {dt.date(2024, 1, d) for d in (17, 18, 19)}


def test_added_days(log):
    cut = F.col("event_date") < dt.date(2024, 1, 22)
    first, last = day_history(log.filter(cut), FAMILIES), day_history(log.filter(~cut), FAMILIES)
    labels, both = label_rows(log, SLICES), first.extended(last)
    for family in (specs.DAILY_AVERAGE, SHARES):
        got = day_family_table(labels, both, family, SLICES, keep_counts=True)
        want = family_table(labels, history_rows(log, SLICES), family, keep_counts=True)
        assert normal(spark_rows(got)).equals(normal(spark_rows(want)))
    with pytest.raises(ValueError, match="both"):
        both.extended(last)
    with pytest.raises(ValueError, match="families"):
        first.extended(day_history(log.filter(~cut), FAMILIES[:1]))


@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES)
def test_null_keys_labels_and_days(spark, policy):
    day = dt.date(2024, 1, 4)
    rows = [(1, 5, 1, day), (1, 6, 0, day), (1, None, None, day - dt.timedelta(days=1)), (None, 5, 1, day), (1, 5, 1, None)]
    log = stage(spark.createDataFrame(rows, "user_id bigint, item_id bigint, is_trade int, event_date date"), "log")
    spec = Family("t", (
        Measure("clicks", ("user_id",)), Measure("buys", ("user_id",), "label_sum"), Measure("items", ("user_id",), "items"),
        Measure("different", ("user_id",), "distinct_items"), Measure("mean", ("user_id",), "ones", daily=True),
    ))
    target = spark.createDataFrame([(1, 1, 1), (1, 2, None), (1, 3, 7)], "slice int, instance_id bigint, user_id bigint")
    slices = (TimeSlice(1, dt.date(2024, 1, 5)),)
    got = day_family_table(target, day_history(log, [spec], policy), spec, slices, keep_counts=True, policy=policy)
    assert {r["instance_id"]: tuple(r[2:]) for r in got.collect()} == {1: (3, 1, 2, 2, 0.5), 2: (None,) * 5, 3: (None,) * 5}
    empty = day_family_table(target, day_history(log.limit(0), [spec], policy), spec, slices, policy=policy)
    assert empty.count() == 3


def test_feature_table_over_days(log):
    slices = SLICES[1:]
    families = (Family("same_day", specs.SAME_DAY.measures[:2], over="label"), RATES)
    got = feature_table(log, slices, families, days=day_history(log, families))
    assert normal(spark_rows(got)).equals(normal(spark_rows(feature_table(log, slices, families))))
